"""Roll-ups of recorded calls, node runs and rubric scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .quality import latest_revision_set

# Rubric metrics that no summary counts.
IGNORED_METRICS = ("overall", "legal_style")


def _sum(name: str) -> Column:
    return F.coalesce(F.sum(F.coalesce(F.col(name), F.lit(0))), F.lit(0))


def call_totals(calls: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Totals of recorded calls: counts, latency, tokens, empty, truncated and failed ones, revised sections."""
    return calls.groupBy(*by).agg(
        F.count("*").alias("calls"),
        _sum("latency_ms").alias("total_ms"),
        _sum("tokens_prompt").alias("tokens_prompt"),
        _sum("tokens_response").alias("tokens_response"),
        F.count_if(F.coalesce(F.col("response_empty"), F.lit(False))).alias("empty"),
        F.count_if(F.col("done_reason") == "length").alias("truncated"),
        F.count_if(F.coalesce(F.col("error"), F.lit(False))).alias("errors"),
        F.countDistinct(F.when(F.col("revision_round") > 0, F.col("section_name"))).alias("revised_sections"),
    )


def stage_rollup(calls: DataFrame) -> DataFrame:
    """Totals by stage (``unknown`` for none) with the mean latency rounded half to even."""
    out = call_totals(calls.withColumn("stage", F.coalesce("stage", F.lit("unknown"))), ("stage",))
    return out.withColumn("avg_ms", F.bround(T.ratio(F.col("total_ms"), F.col("calls"))).cast("bigint"))


def largest_call(calls: DataFrame, field: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The call with the largest value of a field, the first on a tie."""
    return calls.where(F.col(field).isNotNull()).groupBy(*by).agg(F.max_by(F.struct("task_id", "stage", F.col(field)), F.struct(F.col(field), (-F.col("ord")).alias("o"))).alias("c")).select(*by, "c.*")


def slowest_stage(stages: DataFrame) -> DataFrame:
    """The stage of the largest total; on a tie the first by ``ord`` where there is one, else the last by name."""
    tie = -F.col("ord") if "ord" in stages.columns else F.col("stage")
    return stages.groupBy().agg(F.max_by(F.struct("stage", "total_ms"), F.struct(F.col("total_ms"), tie.alias("o"))).alias("s")).select("s.*")


def node_rollup(runs: DataFrame) -> DataFrame:
    """Executions, mean and largest latency, errors and next nodes by node, with the place of its first run."""
    return runs.groupBy("node_name").agg(
        F.count("*").alias("executions"),
        F.bround(F.avg("latency_ms")).cast("bigint").alias("avg_ms"),
        F.max("latency_ms").alias("max_ms"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.array_join(F.sort_array(F.collect_set("next_node")), ",").alias("next_nodes"),
        F.min("ord").alias("first_ord"),
    )


def rubric_scores(scores: DataFrame) -> DataFrame:
    """Numeric ``rubric.<metric>`` scores with their metric, without the ignored ones."""
    named = scores.where(F.startswith("name", F.lit("rubric.")) & F.col("value").isNotNull() & ~F.isnan("value"))
    return named.withColumn("metric", F.substring("name", F.lit(8), F.lit(1000))).where(~F.col("metric").isin(*IGNORED_METRICS))


def with_observation(scores: DataFrame, observations: DataFrame) -> DataFrame:
    """Scores with the section and revision of their observation; the score's own values count where it has them."""
    seen = observations.select("observation_id", F.col("section_name").alias("_s"), F.col("revision_round").alias("_r"))
    own = lambda c: F.col(c) if c in scores.columns else F.lit(None)
    joined = scores.join(seen, "observation_id", "left")
    return joined.withColumns({"section_name": F.coalesce(own("section_name"), "_s"), "revision_round": F.coalesce(own("revision_round"), "_r")}).drop("_s", "_r")


def rubric_summary(rubrics: DataFrame) -> DataFrame:
    """Mean of each metric over all revisions."""
    return rubrics.groupBy("metric").agg(F.avg("value").alias("average"), F.count("*").alias("n"), F.min("ord").alias("first_ord"))


def rubric_overall(rubrics: DataFrame) -> DataFrame:
    """Mean of all raw scores, and the metric of the lowest mean (the first on a tie)."""
    means = rubric_summary(rubrics)
    lowest = means.groupBy().agg(F.min_by("metric", F.struct("average", "first_ord")).alias("lowest_metric"), (F.sum(F.col("average") * F.col("n")) / F.sum("n")).alias("overall"))
    return lowest


def section_rubrics(rubrics: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Latest revision of each section: rounded metric means, their mean, the revision and the number of scores.

    ``by`` names what sections belong to, such as a document or a trace; without it all of the table's are one.
    """
    latest = latest_revision_set(rubrics, (*by, "section_name"), "revision_round")
    means = latest.groupBy(*by, "section_name", "metric").agg(F.round(F.avg("value"), 2).alias("average"), F.max("revision_round").alias("revision"), F.count("*").alias("n"))
    return means.groupBy(*by, "section_name").agg(F.round(F.avg("average"), 2).alias("overall"), F.max("revision").alias("revision"), F.sum("n").alias("scores"))


def latest_observations(observations: DataFrame, stages: tuple[str, ...] = ("polisher", "writer"), ties: tuple[str, ...] = (), by: tuple[str, ...] = ()) -> DataFrame:
    """Latest revision of each section and stage, in chunk order; of the stages only the first that a section has.

    Rows of one chunk stand in the order of their task and then of the columns ``ties``. ``by`` names what sections
    belong to, such as a trace; at scale it keeps a section's rows of all traces from meeting in one task.
    """
    rank = F.coalesce(*[F.when(F.col("stage") == s, F.lit(i)) for i, s in enumerate(stages)])
    kept = latest_revision_set(observations.where(F.col("stage").isin(*stages)), (*by, "section_name", "stage"), "revision_round").withColumn("_rank", rank)
    best = F.min("_rank").over(Window.partitionBy(*by, "section_name"))
    kept = kept.withColumn("_best", best).where("_rank = _best")
    chunk = F.coalesce(F.nullif(F.regexp_extract("task_id", r"_chunk_(\d+)$", 1), F.lit("")).cast("int"), F.lit(0))
    order = Window.partitionBy(*by, "section_name").orderBy(chunk, "task_id", *ties)
    return kept.withColumn("ord", F.row_number().over(order)).drop("_rank", "_best")


def cumulative_words(chunks: DataFrame) -> DataFrame:
    """Words written up to each chunk of a section."""
    order = Window.partitionBy("doc_id", "section").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    return chunks.withColumn("words_so_far", F.sum("words").over(order))
