"""Ground-truth rows from case tables: ten typed projections, joined in a fixed order of labels.

Inputs: persons (doc_id, ord, name, initials, title_surname, dob, address, is_defendant), orgs (doc_id, ord, grp, name,
address, vat), metadata (doc_id, case_number, cross_ref, filing_date, offence_start, offence_end), counts (doc_id, ord,
particulars), amounts (doc_id, ord, value), controls (doc_id, ord, value, notes). Rows carry label_ord and ord.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .evaluation import first_of_each

LABELS = ("PERSON", "ORG", "CASE_REFERENCE", "DATE", "AMOUNT", "INITIAL", "TITLE", "ADDRESS", "VAT", "NEGATIVE_CONTROL")
# Fixed value: amounts in the particulars of a count.
COUNT_AMOUNT = r"(?:£|€|EUR |GBP )\d[\d,]*(?:\.\d+)?"


def _rows(frame: DataFrame, value: Column, label: str, notes: Column, order: Column | None = None, propose: str = "yes") -> DataFrame:
    out = frame.select("doc_id", value.alias("entity_text"), F.lit(label).alias("label"), F.lit(propose).alias("should_propose"), notes.alias("notes"), F.lit(LABELS.index(label)).alias("label_ord"), (F.col("ord") if order is None else order).cast("bigint").alias("ord"))
    return out.where(F.col("entity_text").isNotNull() & (F.col("entity_text") != ""))


def _several(frame: DataFrame, label: str, parts: list[tuple[Column, str]], start: Column | None = None) -> DataFrame:
    """A row for each of several values of a row."""
    base = F.lit(0) if start is None else start * len(parts)
    values = F.array(*[F.struct((base + i).cast("bigint").alias("ord"), v.alias("v"), F.lit(n).alias("n")) for i, (v, n) in enumerate(parts)])
    flat = frame.select("doc_id", F.explode(values).alias("p")).select("doc_id", "p.*")
    return _rows(flat, F.col("v"), label, F.col("n"))


def build(persons: DataFrame, orgs: DataFrame, metadata: DataFrame, counts: DataFrame, amounts: DataFrame, controls: DataFrame | None = None, address_forms: int = 3) -> DataFrame:
    """All ground-truth rows of all documents; order them by doc_id, label_ord, ord where an order is needed."""
    side = F.when(F.col("is_defendant"), "defendant").otherwise("collateral")
    group = F.when(F.col("grp") == "charged", "charged").otherwise("associated")
    dates = _several(metadata, "DATE", [(F.col("filing_date"), "filing date"), (F.col("offence_start"), "offence period start"), (F.col("offence_end"), "offence period end")])
    births = _rows(persons, F.col("dob"), "DATE", F.lit("date of birth"), F.col("ord") + 1000)
    particulars = counts.select("doc_id", F.col("ord"), F.posexplode(F.regexp_extract_all("particulars", F.lit(COUNT_AMOUNT), F.lit(0))).alias("i", "v"))
    sums = _rows(particulars, F.col("v"), "AMOUNT", F.lit("count amount"), F.col("ord") * 1000 + F.col("i")).unionByName(_rows(amounts, F.col("value"), "AMOUNT", F.lit("amount"), F.col("ord") + 1_000_000))
    initials = F.coalesce(F.nullif(F.col("initials"), F.lit("")), T.make_initials(F.col("name")))
    last = F.element_at(F.split(T.squeeze(F.col("name")), " "), -1)
    titles = persons.where(F.col("title_surname").isNotNull() & (F.col("title_surname") != last))
    places = persons.where("is_defendant").select("doc_id", F.col("ord").cast("bigint").alias("ord"), "address").unionByName(orgs.select("doc_id", (F.col("ord") + 1000).cast("bigint").alias("ord"), "address"))
    street, city = T.split_address(F.col("address"))
    forms = [(F.col("address"), "full address"), (street, "street"), (city, "city and postcode")][:address_forms]
    parts = [
        _rows(persons, F.col("name"), "PERSON", side),
        _rows(orgs, F.col("name"), "ORG", group),
        _several(metadata, "CASE_REFERENCE", [(F.col("case_number"), "case number"), (F.col("cross_ref"), "cross reference")]),
        dates.unionByName(births),
        first_of_each(sums, ["doc_id", "entity_text"]),
        _rows(persons, initials, "INITIAL", F.lit("initials")),
        _rows(titles, F.col("title_surname"), "TITLE", F.lit("title and surname")),
        _several(places, "ADDRESS", forms, F.col("ord")),
        _rows(orgs, F.col("vat"), "VAT", F.lit("vat")),
    ]
    if controls is not None:
        parts.append(_rows(controls, F.col("value"), "NEGATIVE_CONTROL", F.col("notes"), propose="no"))
    return reduce(DataFrame.unionByName, parts)


def rendered_only(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows whose normalised surface is part of their document's normalised text."""
    texts = documents.select("doc_id", T.normalize_surface(F.col("text")).alias("_t"))
    return rows.join(texts, "doc_id").where(F.contains("_t", T.normalize_surface(F.col("entity_text")))).drop("_t")


def allowed_facts(persons: DataFrame, orgs: DataFrame, metadata: DataFrame, amounts: DataFrame) -> DataFrame:
    """(doc_id, kind, value): the values a document may mention, each once."""
    pick = lambda frame, kind, *values: frame.select("doc_id", F.lit(kind).alias("kind"), F.explode(F.array(*values)).alias("value"))
    parts = [
        pick(persons, "person_form", T.normalize_phrase(F.col("name"))),
        pick(persons, "titled", T.normalize_title_phrase(F.col("title_surname"))),
        pick(persons, "initials", T.normalize_phrase(F.coalesce(F.nullif(F.col("initials"), F.lit("")), T.make_initials(F.col("name"))))),
        pick(persons, "date", F.col("dob")),
        pick(orgs, "org", T.normalize_phrase(F.col("name"))),
        pick(orgs, "vat", F.col("vat")),
        pick(metadata, "case_ref", F.col("case_number"), F.col("cross_ref")),
        pick(metadata, "date", F.col("filing_date"), F.col("offence_start"), F.col("offence_end")),
        pick(amounts, "amount", F.col("value")),
    ]
    return reduce(DataFrame.unionByName, parts).where("value is not null and value <> ''").distinct()


def unknown_values(documents: DataFrame, facts: DataFrame, kind: str, pattern: str) -> DataFrame:
    """Values of one kind that a document mentions and its facts don't have."""
    found = documents.select("doc_id", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), T.normalize_phrase))).alias("value"))
    return found.join(facts.where(F.col("kind") == kind).select("doc_id", "value"), ["doc_id", "value"], "left_anti")
