"""Text functions as Column expressions. Nulls give nulls unless a function says otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label aliases, titles and patterns that results depend on.
LABEL_ALIASES = {"Address": "ADDRESS", "Amount": "AMOUNT", "CaseLegalReference": "CASE_REFERENCE", "Date": "DATE", "Organization": "ORG", "Organisation": "ORG", "Person": "PERSON", "VAT": "VAT"}
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof")
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
DATE = rf"\b\d{{1,2}} (?:{MONTHS}) \d{{4}}\b"
AMOUNT = r"(?i)(?:£|€|\b(?:GBP|EUR)\s*)\s?\d[\d,]*(?:\.\d+)?(?:\s?(?:million|m|thousand|k))?"
VAT = r"\b[A-Z]{2}(?=[A-Z0-9]{8,14}\b)(?=[A-Z0-9]*\d)[A-Z0-9]{8,14}\b"
CASE_REFERENCE = r"\b(?:CPS/\d{4}/\d{4}|C/\d{4}/\d{1,4}|T\d{9,10}|\d{7}/\d{3})\b"
INITIALS = r"\b(?:[A-Z]\.){2,4}\b"
TITLED_NAME = r"\b(?:Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Lord)\.? [A-Z][A-Za-z'-]+\b"
COMPANY_SUFFIXES = ("INTERNATIONAL LTD", "CONSULTING LTD", "SOLUTIONS LTD", "HOLDINGS LTD", "SERVICES LTD", "GROUP LTD", "LIMITED", "LTD")
ORGANISATION = rf"\b[A-Z0-9][A-Z0-9&'/-]*(?: [A-Z0-9][A-Z0-9&'/-]*)* (?:{'|'.join(COMPANY_SUFFIXES)})\b"
SENTENCE_END = r"(?<=[.!?])\s+"
PROSE_TOKEN = r"[A-Za-zÀ-ÖØ-öø-ÿ0-9']+"
META_PREFIXES = ("approved:", "rubrics:", "issues:", "revision:", "strict compliance notes:", "required facts & entities:", "required facts and entities:", "entities mentioned:", "logical order:", "fix:", "note:")
META_LABELS = ("history", "persons", "companies", "charges", "facts", "evidence", "assessment", "required facts & entities", "required facts and entities", "entities mentioned", "logical order", "strict compliance notes", "---", "----")


def squeeze(text: Column) -> Column:
    """Runs of white space (any script's) become one space; trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalize_surface(text: Column) -> Column:
    """Squeezed and case-folded; ß folds to ss as case folding has it."""
    return F.replace(F.lower(squeeze(text)), F.lit("ß"), F.lit("ss"))


def normalize_phrase(text: Column) -> Column:
    """Squeezed, then stripped of punctuation at both ends; case is kept."""
    return F.btrim(squeeze(text), F.lit(".,;:()[]{}"))


def normalize_title_phrase(text: Column) -> Column:
    """``normalize_phrase`` with the dot behind a title taken out."""
    return reduce(lambda t, title: F.replace(t, F.lit(f"{title}. "), F.lit(f"{title} ")), TITLES, normalize_phrase(text))


def canonical_label(label: Column) -> Column:
    aliases = F.create_map(*[F.lit(x) for pair in LABEL_ALIASES.items() for x in pair])
    return F.upper(F.coalesce(F.try_element_at(aliases, label), label))


def tokens(text: Column) -> Column:
    """Tokens of the normalised surface, for coverage."""
    return F.regexp_extract_all(normalize_surface(text), F.lit(r"(?U)[\w£€$./-]+"), F.lit(0))


def token_coverage(expected: Column, predicted: Column) -> Column:
    """Share of expected tokens (array) found among the predicted ones; repeated tokens count each time, none is 0."""
    found = F.size(F.filter(expected, lambda t: F.array_contains(predicted, t)))
    return F.coalesce(F.try_divide(found, F.size(expected)), F.lit(0.0))


def words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"(?U)\S+"), F.lit(0)))


def split_address(address: Column) -> tuple[Column, Column]:
    """Street and city with postcode, split at the last comma and space, else at the last comma; (address, '') without."""
    spaced, plain = r"(?s)^(.*), (.*?)$", r"(?s)^(.*),(.*?)$"
    part = lambda k: F.trim(F.when(F.instr(address, ", ") > 0, F.regexp_extract(address, spaced, k)).otherwise(F.regexp_extract(address, plain, k)))
    has = F.instr(address, ",") > 0
    return F.when(has, part(1)).otherwise(F.trim(address)), F.when(has, part(2)).otherwise(F.when(address.isNotNull(), F.lit("")))


def field_after(text: Column, marker: str) -> Column:
    """What follows a marker (any case) up to the next bar; empty without the marker."""
    at = F.instr(F.lower(text), marker.lower())
    rest = F.substring(text, at + F.lit(len(marker)), F.lit(2**31 - 1))
    return F.when(at > 0, F.trim(F.substring_index(rest, "|", 1))).otherwise(F.lit(""))


def make_initials(name: Column) -> Column:
    """First letters of the name's parts, each with a dot; titles are left out."""
    bare = squeeze(F.regexp_replace(name, rf"\b(?:{'|'.join((*TITLES, 'Miss', 'Sir', 'Lord'))})\.?\s", ""))
    letters = F.transform(F.split(bare, " "), lambda w: F.upper(F.left(w, F.lit(1))))
    return F.when(bare == "", F.lit("")).otherwise(F.concat(F.array_join(letters, "."), F.lit(".")))


def clean_person_part(text: Column) -> Column:
    return squeeze(F.regexp_replace(text, r"[^\p{L}\p{M}\s' -]", " "))


def clean_company_token(text: Column) -> Column:
    return F.upper(squeeze(F.regexp_replace(text, r"[^\p{L}\p{M}\p{N}\s& -]", " ")))


def fill_template(template: Column, values: Column) -> Column:
    """``{key}`` replaced from a map of strings; unknown keys stay."""
    return F.aggregate(F.map_entries(values), template, lambda text, e: F.replace(text, F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"]))


def placeholders(template: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(template, F.lit(r"\{([A-Za-z_][A-Za-z0-9_]*)\}"), F.lit(1))))


def duration_text(milliseconds: Column) -> Column:
    """``1h 2m 3s``; seconds are rounded half to even."""
    total = F.bround(milliseconds / 1000).cast("long")
    hours, minutes, seconds = F.floor(total / 3600), F.floor(total / 60) % 60, total % 60
    return F.when(total >= 3600, F.format_string("%dh %dm %ds", hours, minutes, seconds)).when(total >= 60, F.format_string("%dm %ds", minutes, seconds)).when(total.isNotNull(), F.format_string("%ds", seconds))


def latency_band(milliseconds: Column) -> Column:
    return F.when(milliseconds <= 30_000, "very fast").when(milliseconds <= 90_000, "fast").when(milliseconds <= 180_000, "slow").when(milliseconds.isNotNull(), "very slow")


def verdict(score: Column) -> Column:
    return F.when(score >= 85, "good").when(score >= 70, "acceptable").when(score >= 50, "risky").when(score.isNotNull(), "bad")


def lenient_int(text: Column) -> Column:
    """``1,234`` as a number, ``12.6`` rounded half to even; anything else 0."""
    bare = F.replace(F.trim(text), F.lit(","), F.lit(""))
    whole = F.regexp_like(bare, F.lit(r"^[+-]?\d+$"))
    return F.coalesce(F.when(whole, bare.try_cast("bigint")).otherwise(F.bround(bare.try_cast("double")).try_cast("bigint")), F.lit(0).cast("bigint"))


def percent(value: Column) -> Column:
    return F.format_string("%.2f%%", value * 100)


def section_of_task(task: Column) -> Column:
    """Section named in a task id; null if there is none. A name is cut at its first ``_r``."""
    return F.nullif(F.regexp_extract(task, r"^(?:section_planner_|writer_|polish_|critic_)(.*?)(?:_r.*)?$", 1), F.lit(""))


def revision_of_task(task: Column) -> Column:
    return F.nullif(F.regexp_extract(task, r"_r(\d+)", 1), F.lit("")).try_cast("bigint")


def doc_id(doc_type: Column, kind: Column, counter: Column) -> Column:
    return F.format_string("en_%s_%s_%03d", doc_type, kind, counter)


def doc_counter(doc: Column) -> Column:
    """Trailing number of a document id; null if there is none."""
    return F.nullif(F.regexp_extract(doc, r"_(\d+)$", 1), F.lit("")).try_cast("int")


def json_object_in(text: Column) -> Column:
    """From the first brace to the last, without code fences; empty without braces."""
    return F.regexp_extract(F.regexp_replace(text, r"(?m)^```[a-zA-Z]*\s*$", ""), r"(?s)\{.*\}", 0)


def slug(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9-]+", "-"), "-{2,}", "-"), F.lit("-"))


def truncate_middle(text: Column, most: int, mark: str = "\n...\n") -> Column:
    """Head and tail of a text longer than ``most``."""
    half = most // 2
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(half)), F.lit(mark), F.right(text, F.lit(half)))).otherwise(text)


def demote_headings(markdown: Column) -> Column:
    return F.regexp_replace(markdown, r"(?m)^(#{1,5}) ", "#$1 ")


def clean_generated(text: Column) -> Column:
    """Section text without hidden reasoning, code fences, word counts and review lines; blanks squeezed."""
    start = F.regexp_replace(F.btrim(F.replace(text, F.lit("\r"), F.lit("")), F.lit(" \t\n\x0b\x0c")), r"(?is)<think>.*?</think>", "")

    def stays(raw: Column) -> Column:
        line = F.trim(raw)
        low = F.lower(line)
        bare = F.btrim(low, F.lit("* "))
        label = F.rtrim(F.trim(bare), F.lit(":"))
        meta = label.isin(*META_LABELS) | reduce(lambda a, b: a | b, (F.startswith(bare, F.lit(p)) for p in META_PREFIXES))
        return ~(F.startswith(line, F.lit("```")) | F.regexp_like(line, F.lit(r"(?i)^\(?\s*word count\s*:\s*\d+\s*\)?\s*$")) | meta)

    lines = F.transform(F.filter(F.split(start, "\n"), stays), lambda raw: F.when(F.trim(raw) == "", F.lit("")).otherwise(raw))
    joined = F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n")
    joined = F.regexp_replace(F.regexp_replace(joined, r"[ \t]+", " "), r"[ ]+([,.;:])", "$1")
    return F.btrim(F.regexp_replace(joined, r"\n{3,}", "\n\n"), F.lit(" \n\t"))


def sentences(text: Column) -> Column:
    return F.split(squeeze(text), SENTENCE_END)


def _repeats(values: Column) -> Column:
    """Whether an array has a value twice; the array is made once."""
    return F.get(F.transform(F.array(values), lambda v: F.size(v) != F.size(F.array_distinct(v))), F.lit(0))


def repeated_sentences_among(found: Column, least: int = 80) -> Column:
    """Whether one of the sentences of at least ``least`` characters occurs twice, in any case."""
    return _repeats(F.filter(F.transform(F.filter(found, lambda s: F.length(s) >= least), lambda s: F.lower(F.trim(s))), lambda s: F.length(s) >= least))


def repeated_fragments_among(found: Column, tokens_least: int = 8, prefix: int = 10) -> Column:
    """Whether two of the sentences of at least ``tokens_least`` words begin with the same ``prefix`` words."""
    # a word has a letter and all but the last a character behind it: shorter sentences have too few
    heads = F.transform(F.filter(found, lambda s: F.length(s) >= 2 * tokens_least - 1), lambda s: F.regexp_extract_all(F.lower(s), F.lit(PROSE_TOKEN), F.lit(0)))
    return _repeats(F.transform(F.filter(heads, lambda t: F.size(t) >= tokens_least), lambda t: F.array_join(F.slice(t, 1, prefix), " ")))


def has_repeated_sentences(text: Column, least: int = 80) -> Column:
    """Whether a sentence of at least ``least`` characters occurs twice, in any case."""
    return repeated_sentences_among(sentences(text), least)


def has_repeated_fragments(text: Column, tokens_least: int = 8, prefix: int = 10) -> Column:
    """Whether two sentences of at least ``tokens_least`` words begin with the same ``prefix`` words."""
    return repeated_fragments_among(sentences(text), tokens_least, prefix)


def markdown_block(text: Column, heading: str) -> Column:
    """Lines under ``## heading`` up to the next ``## `` heading; empty if there is none."""
    return F.trim(F.regexp_extract(F.concat(F.lit("\n"), text, F.lit("\n## ")), rf"(?s)\n## \Q{heading}\E[ \t]*\n(.*?)(?=\n## )", 1))


def markdown_section(text: Column, heading: str) -> Column:
    """What follows ``## heading`` or else ``### heading`` (wherever it stands) up to the next heading of either level."""
    body = lambda mark: F.regexp_extract(F.concat(text, F.lit("\n## ")), rf"(?s)\Q{mark} {heading}\E(.*?)(?=\n###? )", 1)
    second = F.instr(text, f"## {heading}")
    return F.when(second > 0, body("##")).otherwise(F.when(text.isNotNull(), F.lit("")))


def bullets(block: Column) -> Column:
    """Texts of the ``- `` lines of a block."""
    lines = F.filter(F.transform(F.split(block, "\n"), lambda x: F.trim(x)), lambda x: F.startswith(x, F.lit("- ")))
    return F.transform(lines, lambda x: F.trim(F.substring(x, F.lit(3), F.lit(2**31 - 1))))


def pipe_fields(line: Column) -> Column:
    """``name | key: value`` as a map with the name under ``name``; the last of repeated keys counts."""
    parts = F.transform(F.split(line, r"\|"), lambda p: F.trim(p))
    pairs = F.transform(F.filter(F.slice(parts, F.lit(2), F.size(parts)), lambda p: F.instr(p, ":") > 0), lambda p: F.struct(F.replace(F.lower(F.trim(F.substring_index(p, ":", 1))), F.lit(" "), F.lit("_")).alias("key"), F.trim(F.regexp_extract(p, r"(?s)^[^:]*:(.*)$", 1)).alias("value")))
    everything = F.concat(F.array(F.struct(F.lit("name").alias("key"), F.get(parts, F.lit(0)).alias("value"))), pairs)
    last = F.filter(everything, lambda e, i: ~F.exists(F.slice(everything, i + 2, F.size(everything)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 on a zero divisor."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))
