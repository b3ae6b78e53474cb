"""The rule library: 26 named checks of a section's text, each a Column of issue texts.

A check sees the trimmed text and, where it needs them, the facts of its document: arrays ``known_entities``,
``allowed_<kind>``, ``people`` and ``companies`` (structs), ``defendants``, ``organisations``, ``charged_period`` and
``key_dates``. A missing column counts as empty. ``issues`` runs the enabled checks in the library's order and drops
repeated issues; an empty text gives only its own issue. Word boundaries, white space and case in the patterns are those
of ASCII, as Spark's regular expressions have them by default.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

# Patterns and sections that results depend on.
META_TOKEN = r"(?im)\b(?:APPROVED:|RUBRICS:|ISSUES:|REVISION:|STRICT COMPLIANCE NOTES:|REQUIRED FACTS(?:\s*&\s*ENTITIES)?:|ENTITIES MENTIONED:|LOGICAL ORDER:|FIX:)\b"
MARKDOWN = (r"(?m)^\s*#{1,6}\s+", r"(?m)^\s*[-*]\s+", r"(?m)^\s*\d+\.\s+", r"(?m)^\s*[-*_]{3,}\s*$", r"\*\*")
META_OPENING = r"(?i)\bthis\s+(?:history|charges|facts|evidence|assessment)\s+section\s+is\s+(?:drawn|prepared)\s+strictly\s+from\s+case_memory\b"
DANGLING_BETWEEN = r"(?i)\bbetween(?:\s+[A-Za-z0-9,.-]+){0,5}\s*(?:[.,;:]|$)"
BROKEN_TIMELINE = r"(?i)\b(?:commenced|started|began)\s+on\s+and\s+(?:continued|lasted)\s+until\b"
TRUNCATED_END = r"(?i)\b(?:and|or|to|of|with|through|including|by|for|from|in|on|at|between)\.?$"
VAT_LABEL = r"(?i)\bVAT(?:\s+Registration\s+No\.)?\s*:\s*([A-Z0-9]+)\b"
ENTITY_SECTIONS = ("persons", "companies", "history", "charges", "facts", "findings", "background")

RULES: dict[str, Callable[[Callable[[str], Column]], Column]] = {}


def rule(name: str):
    def add(f):
        RULES[name] = f
        return f

    return add


def _none() -> Column:
    return F.array().cast("array<string>")


def _flag(failed: Column, issue: str) -> Column:
    return F.when(failed, F.array(F.lit(issue))).otherwise(_none())


def _simple(name: str, failed: Callable[[Column], Column], issue: str, needs: str | None = None, source: str = "text") -> None:
    """A rule of the text alone. ``needs`` is a part in lower case without which it can't fail, tested first."""
    if needs is None:
        RULES[name] = lambda c: _flag(failed(c(source)), issue)
    else:
        RULES[name] = lambda c: _flag(F.contains(c("low"), F.lit(needs)) & failed(c(source)), issue)


_simple("empty_section", lambda t: t == "", "Section is empty.")
_simple("placeholder_text", lambda t: t == "[section not generated]", "Section contains placeholder text.")
_simple("hidden_reasoning_markup", lambda t: F.contains(F.lower(t), F.lit("<think>")), "Section still contains hidden reasoning markup.")
_simple("placeholder_markers", lambda t: F.regexp_like(t, F.lit(r"\*{4,}")), "Section contains unresolved placeholder markers (****).")
_simple("review_metadata", lambda t: F.regexp_like(t, F.lit(META_TOKEN)), "Section contains review/instruction metadata instead of prose.", ":")
_simple("meta_summary_style", lambda t: F.regexp_like(t, F.lit(META_OPENING)), "Section contains template/meta summary wording instead of legal prose.", "case_memory")
_simple("markdown_formatting", lambda t: reduce(lambda a, b: a | b, (F.regexp_like(t, F.lit(p)) for p in MARKDOWN)), "Section contains markdown/list formatting; output must be plain prose.")
_simple("incomplete_date_range", lambda t: F.regexp_like(t, F.lit(r"(?i)\bbetween\s+and\b")), "Section contains an incomplete date range ('between ... and ...').", "between")
_simple("dangling_between_phrase", lambda t: F.exists(F.regexp_extract_all(t, F.lit(DANGLING_BETWEEN), F.lit(0)), lambda m: ~(F.regexp_like(m, F.lit(r"(?i)\bbetween\b.+\band\b")) | F.contains(F.lower(m), F.lit("during the charged period")))), "Section contains a dangling 'between' phrase.", "between")
_simple("unresolved_timeline_placeholder", lambda t: F.regexp_like(t, F.lit(BROKEN_TIMELINE)), "Section contains unresolved timeline placeholders.")
_simple("partial_vat_identifier", lambda t: F.exists(F.regexp_extract_all(t, F.lit(VAT_LABEL), F.lit(1)), lambda v: ~F.regexp_like(F.upper(v), F.lit(f"^(?:{T.VAT})$"))), "Section contains a truncated VAT/reference identifier.", "vat")
_simple("repeated_long_sentences", T.repeated_sentences_among, "Section contains repeated long sentences/paragraphs.", source="sentences")
_simple("repeated_sentence_fragments", T.repeated_fragments_among, "Section contains repeated sentence fragments.", source="sentences")
_simple("truncated_sentence", lambda t: (F.length(t) > 120) & F.regexp_like(F.trim(t), F.lit(TRUNCATED_END)), "Section appears truncated or ends mid-sentence.")


def minimum_words(target: Column, completion: float = 0.7) -> Column:
    return F.greatest(F.lit(60), F.floor(target * F.lit(completion)).cast("int"))


@rule("minimum_length")
def _(c):
    return _flag(T.words(c("text")) < minimum_words(c("word_target")), "Section is significantly shorter than the requested target.")


def _missing_fields(c, table: str, kind: str, fields: tuple[str, ...]) -> Column:
    def of(row: Column) -> Column:
        return F.array(*[F.when((row[f] != "") & ~F.contains(c("text"), row[f]), F.concat(F.lit(f"Section is missing required {kind} {f} '"), row[f], F.lit("'."))) for f in fields])

    return F.array_compact(F.flatten(F.transform(c(table), of)))


@rule("required_person_facts")
def _(c):
    return F.when(c("section") == "persons", _missing_fields(c, "people", "person", ("name", "dob", "nationality", "role", "address"))).otherwise(_none())


@rule("required_company_facts")
def _(c):
    return F.when(c("section") == "companies", _missing_fields(c, "companies", "company", ("name", "vat", "address"))).otherwise(_none())


@rule("known_entity_presence")
def _(c):
    known = F.filter(c("known_entities"), lambda e: F.length(e) >= 4)
    failed = c("section").isin(*ENTITY_SECTIONS) & (F.size(known) > 0) & ~F.exists(known, lambda e: F.contains(c("text"), e))
    return _flag(failed, "Section does not mention any known case entity.")


def extracted(text: Column, pattern: str, normal: Callable[[Column], Column] = T.normalize_phrase) -> Column:
    """Distinct normalised matches in order of their text."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), normal)))


def _unknown(name: str, kind: str, pattern: str, issue: str, normal=T.normalize_phrase, known=None, needs: tuple[str, ...] = ()) -> None:
    known = known or (lambda allowed, m: F.array_contains(allowed, m))

    def check(c):
        found = extracted(c("text"), pattern, normal)
        if needs:  # without one of these nothing matches, and the pattern isn't tried
            found = F.when(reduce(lambda a, b: a | b, (F.contains(c("low"), F.lit(n)) for n in needs)), found).otherwise(_none())
        strange = F.filter(found, lambda m: ~known(c(f"allowed_{kind}"), m))
        return F.transform(strange, lambda m: F.concat(F.lit(f"Section mentions unknown {issue} '"), m, F.lit("'.")))

    RULES[name] = check


_unknown("unknown_case_references", "case_refs", T.CASE_REFERENCE, "case reference")
_unknown("unknown_dates", "dates", T.DATE, "date")
_unknown("unknown_amounts", "amounts", T.AMOUNT, "amount", needs=("£", "€", "gbp", "eur"))
_unknown("unknown_vat_numbers", "vats", T.VAT, "VAT/reference number")
_unknown("unknown_organisations", "orgs", T.ORGANISATION, "organisation", known=lambda allowed, m: F.exists(allowed, lambda a: (a == m) | F.contains(F.lower(a), F.lower(m))), needs=("ltd", "limited"))
_unknown("unknown_titled_people", "titled", T.TITLED_NAME, "titled person", T.normalize_title_phrase)
_unknown("unknown_initials", "initials", T.INITIALS, "initials")


@rule("facts_contract")
def _(c):
    mentioned = lambda names: F.size(F.filter(names, lambda n: F.contains(c("text"), n)))
    defendants, orgs = F.slice(c("defendants"), 1, 3), F.slice(c("organisations"), 1, 5)
    period, dates = F.split(c("charged_period"), " and "), F.slice(c("key_dates"), 1, 2)
    ends = F.size(F.filter(F.slice(period, 1, 2), lambda d: (d != "") & ~F.contains(c("text"), d))) > 0
    has_period = c("charged_period") != ""
    parts = F.concat(
        _flag((F.size(defendants) > 0) & (mentioned(defendants) < F.least(F.lit(2), F.size(defendants))), "Facts section omits key defendants listed in CASE_MEMORY."),
        _flag((F.size(orgs) > 0) & (mentioned(orgs) < F.least(F.lit(3), F.size(orgs))), "Facts section omits key organisations listed in CASE_MEMORY."),
        F.when(has_period & (F.size(period) == 2), _flag(ends, "Facts section omits one or both charged-period dates from CASE_MEMORY.")).when(~has_period, _flag((F.size(dates) > 0) & (mentioned(dates) == 0), "Facts section omits key case dates from CASE_MEMORY.")).otherwise(_none()),
        _flag(F.regexp_like(c("text"), F.lit(META_OPENING)), "Facts section uses template wording instead of factual narrative."),
    )
    return F.when(F.lower(c("section")) == "facts", parts).otherwise(_none())


#: Columns a check may ask for, with the value of a missing one.
_EMPTY_STRINGS = ("known_entities", "allowed_case_refs", "allowed_dates", "allowed_amounts", "allowed_vats", "allowed_orgs", "allowed_titled", "allowed_initials", "defendants", "organisations", "key_dates")
_DEFAULTS = {
    **dict.fromkeys(_EMPTY_STRINGS, "array<string>"),
    "people": "array<struct<name:string,dob:string,nationality:string,role:string,address:string>>",
    "companies": "array<struct<name:string,vat:string,address:string>>",
}


def issues(sections: DataFrame, enabled: dict[str, bool] | None = None, text_column: str = "text") -> DataFrame:
    """``sections`` with the column issues. All checks run unless ``enabled`` turns one off; unknown names are ignored."""
    wanted = [n for n in RULES if (enabled or {}).get(n, True)]
    present = set(sections.columns)
    trimmed = F.btrim(F.coalesce(F.col(text_column), F.lit("")), F.lit(" \t\n\r\x0b\x0c"))

    def column(name: str) -> Column:
        if name in ("text", "low", "sentences"):
            return F.col(f"_{name}")
        if name in _DEFAULTS:
            empty = F.array().cast(_DEFAULTS[name])
            return F.coalesce(F.col(name), empty) if name in present else empty
        if name == "word_target":
            return F.coalesce(F.col(name), F.lit(0)) if name in present else F.lit(0)
        return F.coalesce(F.col(name), F.lit("")) if name in present else F.lit("")

    # made once, as several rules ask for them
    frame = sections.withColumn("_text", trimmed).withColumns({"_low": F.lower("_text"), "_sentences": T.sentences(F.col("_text"))})
    first = RULES["empty_section"](column) if "empty_section" in wanted else _none()
    others = [RULES[n](column) for n in wanted if n != "empty_section"]
    rest = F.array_distinct(F.concat(*others)) if others else _none()
    return frame.withColumn("issues", F.when(F.col("_text") == "", first).otherwise(rest)).drop("_text", "_low", "_sentences")
