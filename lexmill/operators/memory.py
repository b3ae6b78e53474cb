"""Case memory read as a database: allowed facts for the rules, and entity candidates for calibration.

Memory is Markdown with ``##`` and ``###`` headings over ``- name | key: value`` lines. Rules use what stands before
the document plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .evaluation import first_of_each, keyed

# Patterns of the candidates.
CANDIDATES = (
    ("CASE_REFERENCE", r"\b(?:CPS/\d{4}/\d+|C/\d{4}/\d+)\b"),
    ("CASE_REFERENCE", r"(?i)\bsections? \d+(?: and \d+)? of (?:the )?(?:same Act|[A-Z][A-Za-z ]+ Act \d{4})\b"),
    ("DATE", T.DATE),
    ("AMOUNT", r"[£€$]\s?\d{1,3}(?:,\d{3})*(?:\.\d{2})?"),
    ("VAT", r"\b[A-Z]{2}\d{9,12}\b"),
)
ORG_HINT = r"\b(?:LTD|LIMITED|HOLDINGS|GROUP|SERVICES)\b"
CHARGED = rf"between\s+(\d{{1,2}} (?:{T.MONTHS}) \d{{4}})\s+and\s+(\d{{1,2}} (?:{T.MONTHS}) \d{{4}})"


def seed_memory(memory: Column) -> Column:
    return F.substring_index(memory, "\n## Document Plan\n", 1)


def block_after(memory: Column, heading: str) -> Column:
    """Text behind the first occurrence of a heading with its marks, up to the next ``##`` or ``###`` heading."""
    return F.regexp_extract(F.concat(memory, F.lit("\n## ")), rf"(?s)\Q{heading}\E(.*?)(?=\n##)", 1)


def _matches(text: Column, pattern: str, normal=T.normalize_phrase) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), normal)


def _parts(line: Column) -> Column:
    return F.transform(F.split(line, r"\|"), lambda p: F.trim(p))


def _after(parts: Column, key: str) -> Column:
    """Values of the parts that begin with ``key:`` in any case."""
    return F.transform(F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1))), lambda p: F.startswith(F.lower(p), F.lit(key + ":"))), lambda p: F.regexp_extract(p, r"(?s)^[^:]*:(.*)$", 1))


def _present(values: Column) -> Column:
    return F.array_distinct(F.filter(values, lambda v: (v != "") & (F.lower(v) != "none")))


def _names(block: Column) -> Column:
    return _present(F.transform(T.bullets(block), lambda x: T.normalize_phrase(F.substring_index(x, "|", 1))))


def first_names(memory: Column, heading: str, most: int) -> Column:
    """The first different names of the lines under a heading, ``none`` left out."""
    return F.slice(_names(T.markdown_block(memory, heading)), 1, most)


def facts(memory: DataFrame) -> DataFrame:
    """doc_id with the columns that the rule library reads, from (doc_id, memory_text)."""
    m = memory.select("doc_id", F.col("memory_text").alias("m"), seed_memory(F.col("memory_text")).alias("s"))
    m = m.withColumns({
        "refs": block_after(F.col("s"), "### Case References and Dates"),
        "people_lines": T.bullets(block_after(F.col("s"), "### Allowed Person Surface Forms")),
        "orgs": block_after(F.col("s"), "### Allowed Organisations"),
        "sums": block_after(F.col("s"), "### Allowed Amounts"),
        "counts": block_after(F.col("s"), "## Counts"),
        "count_block": T.markdown_block(F.col("m"), "Counts"),
    })
    base = F.transform("people_lines", lambda x: T.normalize_phrase(F.substring_index(x, "|", 1)))
    forms = F.flatten(F.transform("people_lines", lambda x: F.flatten(F.transform(_after(_parts(x), "allowed forms"), lambda v: F.transform(F.split(v, ";"), T.normalize_phrase)))))
    births = F.flatten(F.transform("people_lines", lambda x: F.transform(_after(_parts(x), "dob"), T.normalize_phrase)))
    org_lines = T.bullets(F.col("orgs"))
    org_names = _present(F.transform(org_lines, lambda x: T.normalize_phrase(F.substring_index(x, "|", 1))))
    org_vats = _present(F.flatten(F.transform(org_lines, lambda x: F.transform(_after(_parts(x), "vat"), T.normalize_phrase))))
    m = m.withColumns({
        "forms": _present(F.concat(base, F.filter(forms, lambda v: v != ""))),
        "births": F.filter(births, lambda v: v != ""),
        "org_names": F.when(F.size(org_names) > 0, org_names).otherwise(F.array_distinct(_matches(F.col("orgs"), T.ORGANISATION))),
        "vats": F.when(F.size(org_vats) > 0, org_vats).otherwise(F.array_distinct(_matches(F.col("orgs"), T.VAT))),
        "period": T.squeeze(F.concat_ws(" and ", F.nullif(F.regexp_extract("count_block", CHARGED, 1), F.lit("")), F.nullif(F.regexp_extract("count_block", CHARGED, 2), F.lit("")))),
    })
    blob = F.array_join("forms", "\n")
    listed = T.markdown_block(F.concat(F.lit("\n"), F.replace(T.markdown_block(F.col("m"), "Allowed References"), F.lit("### "), F.lit("## "))), "Case References and Dates")
    union = lambda *parts: F.array_distinct(F.concat(*parts))
    field = lambda parts, key: F.coalesce(F.get(F.transform(_after(parts, key), lambda v: F.trim(v)), F.lit(0)), F.lit(""))

    def people(line: Column) -> Column:
        p = _parts(line)
        dob = F.get(F.filter("people_lines", lambda x: F.get(_parts(x), F.lit(0)) == F.get(p, F.lit(0))), F.lit(0))
        return F.struct(F.get(p, F.lit(0)).alias("name"), F.coalesce(field(_parts(dob), "dob"), F.lit("")).alias("dob"), *[field(p, k).alias(k) for k in ("nationality", "role", "address")])

    def companies(line: Column) -> Column:
        p = _parts(line)
        return F.struct(F.get(p, F.lit(0)).alias("name"), field(p, "vat").alias("vat"), field(p, "address").alias("address"))

    named = lambda rows: F.filter(rows, lambda r: (r["name"] != "") & (F.lower(r["name"]) != "none"))
    main = F.concat(T.bullets(T.markdown_section(F.col("m"), "Defendants")), T.bullets(T.markdown_section(F.col("m"), "Collateral")))
    return m.select(
        "doc_id",
        union(F.col("forms"), F.col("org_names")).alias("known_entities"),
        union(_matches(F.col("refs"), T.CASE_REFERENCE), _matches(F.col("counts"), T.CASE_REFERENCE)).alias("allowed_case_refs"),
        union(_matches(F.col("refs"), T.DATE), F.col("births"), _matches(F.col("counts"), T.DATE)).alias("allowed_dates"),
        union(_matches(F.col("sums"), T.AMOUNT), _matches(F.col("counts"), T.AMOUNT)).alias("allowed_amounts"),
        F.col("vats").alias("allowed_vats"),
        F.col("org_names").alias("allowed_orgs"),
        F.array_distinct(_matches(blob, T.TITLED_NAME, T.normalize_title_phrase)).alias("allowed_titled"),
        F.array_distinct(_matches(blob, T.INITIALS)).alias("allowed_initials"),
        _names(T.markdown_block(F.col("m"), "Defendants")).alias("defendants"),
        _names(T.markdown_block(F.col("m"), "Organisations")).alias("organisations"),
        F.col("period").alias("charged_period"),
        F.array_distinct(_matches(listed, T.DATE)).alias("key_dates"),
        named(F.transform(main, people)).alias("people"),
        named(F.transform(T.bullets(T.markdown_section(F.col("m"), "Organisations")), companies)).alias("companies"),
    )


def validate(sections: DataFrame, memory: DataFrame, enabled: dict[str, bool] | None = None) -> DataFrame:
    """Issues of sections (doc_id, section, text, word_target) against their document's memory."""
    from ..functions import rules

    return rules.issues(sections.join(facts(memory), "doc_id", "left"), enabled).select(*sections.columns, "issues")


def candidates(memory: DataFrame) -> DataFrame:
    """(doc_id, ord, text, label): entities that the memory names, the first of each key."""
    def flat(i: int, label: str, values: Column) -> DataFrame:
        return memory.select("doc_id", F.posexplode(values).alias("p", "text")).select("doc_id", (F.lit(i * 1_000_000) + F.col("p")).cast("bigint").alias("ord"), F.trim("text").alias("text"), F.lit(label).alias("label"))

    m = F.col("memory_text")
    found = [flat(i, label, F.transform(F.regexp_extract_all(m, F.lit(p), F.lit(0)), lambda v: T.squeeze(v))) for i, (label, p) in enumerate(CANDIDATES)]
    name = lambda x: F.trim(F.substring_index(x, "|", 1))
    for i, heading in ((10, "Defendants"), (11, "Collateral")):
        found.append(flat(i, "PERSON", F.filter(F.transform(T.bullets(T.markdown_block(m, heading)), name), lambda v: F.lower(v) != "none")))
    lines = F.concat(T.bullets(T.markdown_section(m, "Organisations")), T.bullets(block_after(m, "### Allowed Organisations")))
    found.append(flat(20, "ORG", F.filter(F.transform(lines, name), lambda v: F.regexp_like(v, F.lit(ORG_HINT)))))
    addresses = F.filter(F.transform(lines, lambda x: T.field_after(x, "address:")), lambda a: a != "")
    found.append(flat(21, "ADDRESS", F.flatten(F.transform(addresses, lambda a: F.array(a, *T.split_address(a))))))
    every = reduce(DataFrame.unionByName, found).where("text <> ''")
    return first_of_each(keyed(every), ["doc_id", "k", "label"]).drop("k")
