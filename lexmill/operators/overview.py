"""Overview of a generated document: totals, sections beside their rubrics, evidence, readiness and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import quality


def sections_with_rubrics(scored: DataFrame, rubrics: DataFrame) -> DataFrame:
    """Scored sections (doc_id, section, score, revision) beside their rubric (doc_id, section, overall, revision, url)."""
    r = rubrics.select("doc_id", "section", F.col("overall").alias("rubric"), F.col("revision").alias("_r"), F.col("url").alias("rubric_url"))
    joined = scored.join(r, ["doc_id", "section"], "left")
    return joined.withColumn("revision", F.coalesce("_r", "revision")).drop("_r")


def with_links(sections: DataFrame, texts: DataFrame, critics: DataFrame) -> DataFrame:
    """Sections with the first link there is: to the text's call, the review's call, or the rubric."""
    out = sections.join(texts.select("doc_id", "section", F.col("url").alias("_t")), ["doc_id", "section"], "left").join(critics.select("doc_id", "section", F.col("url").alias("_c")), ["doc_id", "section"], "left")
    return out.withColumn("link", F.coalesce("_t", "_c", "rubric_url")).drop("_t", "_c")


def totals(scored: DataFrame) -> DataFrame:
    """Revisions, words, missing sections and sections with issues by document; lists are in order of their section."""
    names = lambda when: F.array_sort(F.collect_list(F.when(when, F.col("section"))))
    return scored.groupBy("doc_id").agg(F.sum(F.coalesce("revision", F.lit(0))).alias("revisions"), F.sum(F.coalesce("word_count", F.lit(0))).alias("words"), names(F.col("text").isNull()).alias("missing"), names(F.col("text").isNotNull() & (F.col("issue_count") > 0)).alias("with_issues"))


def overview(scored: DataFrame, calls: DataFrame, finals: DataFrame, rubrics: DataFrame) -> DataFrame:
    """One row a document: score, verdict, totals, truncated calls, rubric, readiness and diagnosis.

    calls: doc_id, truncated; finals: doc_id of documents with a final text; rubrics: doc_id, overall.
    """
    out = quality.document_scores(scored).join(totals(scored), "doc_id").join(calls.groupBy("doc_id").agg(F.sum("truncated").alias("truncated")), "doc_id", "left")
    out = out.join(finals.select("doc_id").distinct().withColumn("final_exists", F.lit(True)), "doc_id", "left").join(rubrics.select("doc_id", F.col("overall").alias("rubric")), "doc_id", "left")
    out = out.na.fill({"truncated": 0, "final_exists": False})
    ready = quality.readiness(F.col("final_exists"), F.col("missing_sections"), F.col("overall_score"), F.col("revisions"), F.col("truncated"), F.col("rubric"))
    out = out.withColumn("readiness", ready)
    return out.withColumn("diagnosis", quality.diagnosis(F.col("readiness"), F.col("missing_sections"), F.size("with_issues"), F.col("revisions"), F.col("truncated")))


def evidence(documents: DataFrame, kinds: list[tuple[str, str]], files: DataFrame) -> DataFrame:
    """(doc_id, evidence, status): whether each expected file of a document is there. Kinds are (name, path with {doc_id})."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("evidence"), F.replace(F.lit(p), F.lit("{doc_id}"), F.col("doc_id")).alias("path")) for n, p in kinds])).alias("e")
    wanted = documents.select("doc_id", each).select("doc_id", "e.*")
    found = files.select("path").distinct().withColumn("_f", F.lit(True))
    return wanted.join(found, "path", "left").select("doc_id", "evidence", F.when(F.col("_f"), "available").otherwise("missing").alias("status"))


def candidates(roots: dict[str, DataFrame]) -> DataFrame:
    """Distinct documents of several artifact roots with a flag ``has_<root>`` each, by counter, highest first."""
    flat = None
    for name, frame in roots.items():
        part = frame.select("doc_id").distinct().withColumn("root", F.lit(name))
        flat = part if flat is None else flat.unionByName(part)
    out = flat.groupBy("doc_id").agg(*[F.max(F.col("root") == n).alias(f"has_{n}") for n in roots])
    return out.orderBy(F.coalesce(T.doc_counter(F.col("doc_id")), F.lit(-1)).desc(), "doc_id")


def review_rows(groups: DataFrame) -> DataFrame:
    """(doc_id, grp, number, name) of documents with arrays of names by group, numbered from 1."""
    return groups.select("doc_id", F.explode("groups").alias("grp", "names")).select("doc_id", "grp", F.posexplode("names").alias("p", "name")).select("doc_id", "grp", (F.col("p") + 1).alias("number"), "name")


def key_values(frame: DataFrame, column: str) -> DataFrame:
    """Entries of a map column as rows; null values are empty."""
    return frame.select("doc_id", F.explode(F.map_entries(column)).alias("e")).select("doc_id", "e.key", F.coalesce(F.col("e.value").cast("string"), F.lit("")).alias("value"))


def health_line(ready: Column, score: Column, rubric: Column, milliseconds: Column) -> Column:
    """One line of an overview: readiness, score, rubric and duration, ``n/a`` where there is none."""
    number = lambda c, form: F.coalesce(F.format_string(form, c.cast("double")), F.lit("n/a"))
    some = lambda c, form: F.when(c.isNotNull(), number(c, form)).otherwise(F.lit("n/a"))
    return F.concat(F.lit("| "), F.concat_ws(" | ", ready, some(score, "%.2f"), some(rubric, "%.2f"), F.coalesce(T.duration_text(milliseconds), F.lit("n/a"))), F.lit(" |"))


def count_rows(cases: DataFrame, column: str = "counts") -> DataFrame:
    """A row for each count of a case (an array of structs): its index from 1 and each field as text, JSON if nested."""
    fields = cases.schema[column].dataType.elementType.fields
    flat = cases.select("doc_id", F.posexplode(column).alias("i", "c"))
    shown = lambda f: F.col(f"c.{f.name}") if f.dataType.simpleString() == "string" else F.to_json(F.col(f"c.{f.name}")) if f.dataType.typeName() in ("struct", "array", "map") else F.col(f"c.{f.name}").cast("string")
    return flat.select("doc_id", (F.col("i") + 1).alias("index"), *[F.coalesce(shown(f), F.lit("")).alias(f.name) for f in fields])


def split_people(people: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Defendants and collateral persons without their group; a group that isn't ``collateral`` is a defendant's."""
    collateral = F.coalesce(F.col("grp") == "collateral", F.lit(False))
    return people.where(~collateral).drop("grp"), people.where(collateral).drop("grp")
