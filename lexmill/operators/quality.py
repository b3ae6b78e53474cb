"""Section and document quality: latest revisions, penalties, verdicts, failures and readiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Default scoring weights.
WEIGHTS = {"validator_issue_penalty": 12, "validator_issue_penalty_cap": 60, "revision_penalty": 6, "revision_penalty_cap": 18, "short_section_penalty": 15, "short_section_word_threshold": 80}


def checked_weights(weights: dict[str, int] | None) -> dict[str, int]:
    """The default weights with those given; unknown names and negative or non-integer values raise."""
    out = WEIGHTS | (weights or {})
    wrong = [k for k, v in out.items() if k not in WEIGHTS or isinstance(v, bool) or not isinstance(v, int) or v < 0]
    if wrong:
        raise ValueError(f"scoring weights must be known non-negative integers: {wrong}")
    return out


def latest_revision(artifacts: DataFrame, by: tuple[str, ...] = ("doc_id", "section"), order: str = "revision") -> DataFrame:
    """The row of the highest revision of each key."""
    return artifacts.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(F.col(order).desc()))).where("_n = 1").drop("_n")


def latest_revision_set(rows: DataFrame, by: tuple[str, ...] = ("section",), order: str = "revision") -> DataFrame:
    """All rows of the highest revision of each key; of a key without revisions all rows."""
    top = F.max(order).over(Window.partitionBy(*by))
    return rows.withColumn("_m", top).where(F.col("_m").isNull() | (F.col(order) == F.col("_m"))).drop("_m")


def section_scores(sections: DataFrame, weights: dict[str, int] | None = None) -> DataFrame:
    """``sections`` (text, revision, issue_count, word_count) with penalties, score and verdict.

    A section without text has score 0 and an issue penalty of 100, beyond the cap.
    """
    w = checked_weights(weights)
    gone = F.col("text").isNull()
    issue = F.least(F.lit(w["validator_issue_penalty_cap"]), F.col("issue_count") * w["validator_issue_penalty"])
    revision = F.least(F.lit(w["revision_penalty_cap"]), F.col("revision") * w["revision_penalty"])
    short = F.when(F.col("word_count") < w["short_section_word_threshold"], w["short_section_penalty"]).otherwise(0)
    out = sections.withColumns({"issue_penalty": F.when(gone, 100).otherwise(issue), "revision_penalty": F.when(gone, 0).otherwise(revision), "short_section_penalty": F.when(gone, 0).otherwise(short)})
    score = F.greatest(F.lit(0), 100 - F.col("issue_penalty") - F.col("revision_penalty") - F.col("short_section_penalty"))
    out = out.withColumn("score", F.when(gone, 0).otherwise(score).cast("bigint"))
    return out.withColumn("verdict", F.when(gone, "missing").otherwise(T.verdict(F.col("score"))))


def document_scores(scored: DataFrame) -> DataFrame:
    """Mean section score to two places, verdict, sections and missing sections by document."""
    out = scored.groupBy("doc_id").agg(F.round(F.avg("score"), 2).alias("overall_score"), F.count("*").alias("sections"), F.count_if(F.col("text").isNull()).alias("missing_sections"))
    return out.withColumn("verdict", T.verdict(F.col("overall_score")))


def expected_sections(targets: list[tuple[str, int]], artifacts: DataFrame, documents: DataFrame) -> DataFrame:
    """Every document's expected sections (name, word target) with their latest artifact, if any."""
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("section"), F.lit(words).alias("word_target")) for name, words in targets])).alias("t")
    wanted = documents.select("doc_id").distinct().select("doc_id", each).select("doc_id", "t.section", "t.word_target")
    return wanted.join(latest_revision(artifacts), ["doc_id", "section"], "left")


def top_failures(sections: DataFrame, most: int = 8) -> DataFrame:
    """The most frequent issues; ties by text. A top-k report: only ``most`` rows leave the executors' partial tops."""
    return sections.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "issue").limit(most)


def readiness(final_exists: Column, missing: Column, score: Column, revisions: Column, truncated: Column, rubric: Column) -> Column:
    not_ready = ~final_exists | (missing > 0) | (score < 50)
    review = (score < 85) | (revisions > 0) | (truncated > 0) | F.coalesce(rubric < 3.5, F.lit(False))
    return F.when(not_ready, "Not Ready").when(review, "Needs Review").otherwise("Ready")


def diagnosis(ready: Column, missing: Column, with_issues: Column, revisions: Column, truncated: Column) -> Column:
    """Sentences that explain a readiness."""
    said = lambda when, *parts: F.when(when, F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]))
    return F.concat_ws(
        " ",
        F.concat(F.lit("Document is "), F.lower(ready), F.lit(".")),
        said(missing > 0, missing.cast("string"), " sections are missing."),
        said(with_issues > 0, with_issues.cast("string"), " sections have issues."),
        said(revisions > 0, revisions.cast("string"), " revisions were needed."),
        said(truncated > 0, truncated.cast("string"), " calls were truncated."),
    )
