"""Evaluation of predicted entities against ground truth.

``expected`` has doc_id, ord, text, label; ``predictions`` has doc_id, ord, text, label. An entity's key is its
normalised text with its canonical label. Every operator is keyed by doc_id, so documents are spread over the cluster,
and nothing is ordered globally.
"""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Least coverage of a soft match by label.
SOFT_THRESHOLDS = {"ADDRESS": 0.70, "AMOUNT": 1.00, "CASE_REFERENCE": 0.90, "DATE": 0.90, "ORG": 0.80, "PERSON": 0.80, "VAT": 1.00}
SOFT_DEFAULT = 0.80
POSTERIOR_SEED, POSTERIOR_DRAWS = 20260619, 20_000


def keyed(entities: DataFrame) -> DataFrame:
    """``entities`` with the key column k and the label made canonical."""
    return entities.withColumn("label", T.canonical_label(F.col("label"))).withColumn("k", T.normalize_surface(F.col("text")))


def first_of_each(rows: DataFrame, by: list[str], order: str = "ord") -> DataFrame:
    """The first row of each key: a defined one, unlike dropDuplicates."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(order))).where("_n = 1").drop("_n")


def confusion(expected: DataFrame, predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn over distinct keys, by document or by other columns of the key. One shuffle on the key for both sides."""
    side = lambda rows, e, p: keyed(rows).select("doc_id", "k", "label", F.lit(e).alias("e"), F.lit(p).alias("p"))
    both = side(expected, 1, 0).unionByName(side(predictions, 0, 1))
    keys = both.groupBy("doc_id", "k", "label").agg(F.max("e").alias("e"), F.max("p").alias("p"))
    count = lambda c: F.count_if(F.expr(c))
    return keys.groupBy(*(by or ["doc_id"])).agg(count("e = 1 and p = 1").alias("tp"), count("e = 0").alias("fp"), count("p = 0").alias("fn"))


def with_rates(counts: DataFrame) -> DataFrame:
    """precision, recall and f1 from tp, fp, fn; 0 on a zero divisor."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    out = counts.withColumns({"precision": T.ratio(tp, tp + fp), "recall": T.ratio(tp, tp + fn)})
    return out.withColumn("f1", T.ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def strict_matches(expected: DataFrame, predictions: DataFrame) -> DataFrame:
    """Expected rows whose key was predicted (one for each row, so repeated ground truth repeats)."""
    return keyed(expected).join(keyed(predictions).select("doc_id", "k", "label"), ["doc_id", "k", "label"], "left_semi")


def strict_misses(expected: DataFrame, predictions: DataFrame) -> DataFrame:
    """Distinct keys that were expected and not predicted; swap the sides for false positives."""
    return keyed(expected).join(keyed(predictions).select("doc_id", "k", "label"), ["doc_id", "k", "label"], "left_anti").select("doc_id", "k", "label").distinct()


def threshold_of(label: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in SOFT_THRESHOLDS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, label), F.lit(SOFT_DEFAULT))


def soft_candidates(expected: DataFrame, predictions: DataFrame) -> DataFrame:
    """Pairs of one document and label whose token coverage reaches the label's threshold."""
    e = keyed(expected).select("doc_id", "label", F.col("ord").alias("e_ord"), F.col("text").alias("e_text"), T.tokens(F.col("text")).alias("et"))
    p = keyed(predictions).select("doc_id", "label", F.col("ord").alias("p_ord"), F.col("text").alias("p_text"), T.tokens(F.col("text")).alias("pt"))
    pairs = e.join(p, ["doc_id", "label"]).withColumn("coverage", T.token_coverage(F.col("et"), F.col("pt")))
    return pairs.where(F.col("coverage") >= threshold_of(F.col("label"))).drop("et", "pt")


def soft_matches(expected: DataFrame, predictions: DataFrame) -> DataFrame:
    """Greedy one-to-one assignment: each expected row in order takes its best unused prediction (ties: the first).

    A fold over one document's rows of one label, whose size a document bounds; no UDF.
    """
    def side(rows: DataFrame, name: str) -> DataFrame:
        one = F.struct(F.col("ord"), F.col("text"), T.tokens(F.col("text")).alias("t"))
        return keyed(rows).groupBy("doc_id", "label").agg(F.array_sort(F.collect_list(one)).alias(name))

    both = side(expected, "e").join(side(predictions, "p"), ["doc_id", "label"]).withColumn("least", threshold_of(F.col("label")))
    start = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast("array<struct<e_ord:bigint,p_ord:bigint,coverage:double>>").alias("found"))

    def step(state: Column, e: Column) -> Column:
        options = F.transform("p", lambda p, i: F.struct(T.token_coverage(e["t"], p["t"]).alias("c"), (-i).alias("i"), p["ord"].alias("o")))
        open_ = F.filter(options, lambda o: (o["c"] >= F.col("least")) & ~F.array_contains(state["used"], -o["i"]))
        best = F.array_max(open_)
        # a one-element transform binds the best option to a name
        return F.get(F.transform(F.array(best), lambda b: F.when(b.isNull(), state).otherwise(F.struct(F.concat(state["used"], F.array(-b["i"])).alias("used"), F.concat(state["found"], F.array(F.struct(e["ord"].cast("bigint").alias("e_ord"), b["o"].cast("bigint").alias("p_ord"), b["c"].alias("coverage")))).alias("found")))), F.lit(0))

    folded = both.select("doc_id", "label", F.aggregate("e", start, step, lambda s: s["found"]).alias("found"))
    return folded.select("doc_id", "label", F.explode("found").alias("f")).select("doc_id", "label", "f.*")


def soft_confusion(expected: DataFrame, predictions: DataFrame) -> DataFrame:
    """tp, fp, fn by document and label, over the labels of both sides; their sums are the soft metrics of the whole."""
    count = lambda rows, name: keyed(rows).groupBy("doc_id", "label").agg(F.count("*").alias(name))
    found = soft_matches(expected, predictions).groupBy("doc_id", "label").agg(F.count("*").alias("tp"))
    sides = count(expected, "e").join(count(predictions, "p"), ["doc_id", "label"], "full").join(found, ["doc_id", "label"], "left").na.fill(0, ["e", "p", "tp"])
    return sides.select("doc_id", "label", "tp", (F.col("p") - F.col("tp")).alias("fp"), (F.col("e") - F.col("tp")).alias("fn"))


def is_positive() -> Column:
    return (F.lower("should_propose") == "yes") & (F.col("label") != "NEGATIVE_CONTROL")


def negative_control_hits(groundtruth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions whose text (any label) is a negative control of their document."""
    controls = keyed(groundtruth).where(~F.coalesce(is_positive(), F.lit(False))).select("doc_id", "k")
    return keyed(predictions).join(controls, ["doc_id", "k"], "left_semi")


def _pattern(surface: Column) -> Column:
    """Every white-space token quoted, joined by white space of any kind; no word boundaries."""
    quoted = F.transform(F.split(T.squeeze(surface), " "), lambda t: F.concat(F.lit(r"\Q"), F.replace(t, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")))
    return F.concat(F.lit("(?iuU)"), F.array_join(quoted, r"\s+"))


def surface_in_text(surface: Column, text: Column) -> Column:
    return F.regexp_like(text, _pattern(surface))


def exact_surface(surface: Column, text: Column) -> Column:
    """The surface as the text has it, or unchanged if it doesn't."""
    return F.coalesce(F.nullif(F.call_function("regexp_extract", text, _pattern(surface), F.lit(0)), F.lit("")), surface)


def calibrate(groundtruth: DataFrame, documents: DataFrame, memory: DataFrame | None = None, mode: str = "apply_safe") -> DataFrame:
    """Calibrated positive rows: doc_id, ord, text, label, source. ``off`` and ``diagnose`` leave them as they are.

    Otherwise rows absent from their document go and the rest take its spelling; ``apply_with_memory`` adds the
    rendered ``memory`` candidates whose key isn't there yet, the first of each.
    """
    if mode not in ("off", "diagnose", "apply_safe", "apply_with_memory"):
        raise ValueError(f"unknown calibration mode {mode!r}")
    rows = groundtruth.withColumn("label", T.canonical_label(F.col("label"))).where(is_positive()).select("doc_id", "ord", "text", "label")
    if mode in ("off", "diagnose"):
        return rows.withColumn("source", F.lit("groundtruth"))
    texts = documents.select("doc_id", F.col("text").alias("_document"))

    def rendered(r: DataFrame, source: str) -> DataFrame:
        here = r.join(texts, "doc_id").where(surface_in_text(F.col("text"), F.col("_document")))
        return here.select("doc_id", "ord", exact_surface(F.col("text"), F.col("_document")).alias("text"), "label", F.lit(source).alias("source"))

    kept = rendered(rows, "groundtruth")
    if mode == "apply_safe" or memory is None:
        return kept
    candidates = first_of_each(keyed(rendered(memory.select("doc_id", "ord", "text", "label"), "memory")), ["doc_id", "k", "label"])
    return kept.unionByName(candidates.join(keyed(rows).select("doc_id", "k", "label").union(keyed(kept).select("doc_id", "k", "label")), ["doc_id", "k", "label"], "left_anti").select(kept.columns))


def calibration_counters(groundtruth: DataFrame, documents: DataFrame, memory: DataFrame | None = None) -> DataFrame:
    """Counters of a calibration by document, in one pass over ground truth and candidates."""
    texts = documents.select("doc_id", F.col("text").alias("_document"))
    rows = keyed(groundtruth).join(texts, "doc_id", "left").withColumn("pos", F.coalesce(is_positive(), F.lit(False)))
    rows = rows.withColumn("here", F.coalesce(surface_in_text(F.col("text"), F.col("_document")), F.lit(False)))
    out = rows.groupBy("doc_id").agg(
        F.count("*").alias("raw_rows"),
        F.count_if("pos").alias("raw_positive_rows"),
        F.count_if(~F.col("pos")).alias("negative_control_rows"),
        F.count_if(F.col("pos") & ~F.col("here")).alias("absent_positive_rows"),
        F.count_if(F.col("pos") & F.col("here") & (exact_surface(F.col("text"), F.col("_document")) != F.col("text"))).alias("surface_normalizations"),
    )
    if memory is None:
        return out
    known = keyed(groundtruth).where(is_positive()).select("doc_id", "k", "label").distinct().withColumn("known", F.lit(True))
    m = keyed(memory).join(texts, "doc_id", "left").join(known, ["doc_id", "k", "label"], "left")
    missing = F.coalesce(surface_in_text(F.col("text"), F.col("_document")), F.lit(False)) & F.col("known").isNull()
    more = m.groupBy("doc_id").agg(F.count("*").alias("memory_candidates"), F.count_if(missing).alias("missing_memory_candidates"))
    return out.join(more, "doc_id", "left").na.fill(0)


def beta_mode(successes: Column, failures: Column) -> Column:
    """Mode of Beta(1 + successes, 1 + failures)."""
    return F.when((successes > 0) & (failures > 0), successes / (successes + failures)).when((successes == 0) & (failures > 0), 0.0).when((failures == 0) & (successes > 0), 1.0).otherwise(0.5)


def rate_posterior(counts: DataFrame, successes: str = "tp", failures: str = "fp") -> DataFrame:
    """Closed-form posterior of a rate under a flat prior: mle, map and mean."""
    s, f = F.col(successes), F.col(failures)
    return counts.withColumns({"mle": T.ratio(s, s + f), "map": beta_mode(s, f), "mean": (1 + s) / (2 + s + f)})


def _nearest(values: list[float], p: float) -> float:
    return values[min(round(p * (len(values) - 1)), len(values) - 1)] if values else 0.0


def _draws(tp: int, fp: int, fn: int) -> dict:
    """Quantiles of seeded Beta draws; the generator and seeds are part of the result, so they are Python's."""
    def rate(s: int, n: int) -> tuple[float, float]:
        rng = random.Random(POSTERIOR_SEED + s * 131 + n * 29)
        x = sorted(rng.betavariate(1 + s, 1 + max(n - s, 0)) for _ in range(POSTERIOR_DRAWS))
        return _nearest(x, 0.025), _nearest(x, 0.975)

    rng = random.Random(POSTERIOR_SEED + tp * 101 + fp * 17 + fn)
    both = []
    for _ in range(POSTERIOR_DRAWS):
        p, r = rng.betavariate(1 + tp, 1 + fp), rng.betavariate(1 + tp, 1 + fn)
        both.append(2 * p * r / (p + r) if p + r else 0.0)
    both.sort()
    low, high = rate(tp, tp + fp), rate(tp, tp + fn)
    return {"precision_low": low[0], "precision_high": low[1], "recall_low": high[0], "recall_high": high[1], "f1_median": _nearest(both, 0.5), "f1_mean": sum(both) / len(both), "f1_low": _nearest(both, 0.025), "f1_high": _nearest(both, 0.975)}


_DRAWN = ["precision_low", "precision_high", "recall_low", "recall_high", "f1_median", "f1_mean", "f1_low", "f1_high"]


def posterior_intervals(counts: DataFrame) -> DataFrame:
    """``counts`` (tp, fp, fn) with 95 % intervals. Draws are made once for each distinct triple, spread over tasks."""
    def run(batches):
        for batch in batches:
            rows = [_draws(*t) for t in zip(*(batch.column(c).to_pylist() for c in range(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([r[n] for r in rows], pa.float64()) for n in _DRAWN)], names=["tp", "fp", "fn", *_DRAWN])

    triples = counts.select(*(F.col(c).cast("bigint") for c in ("tp", "fp", "fn"))).distinct()
    drawn = triples.mapInArrow(run, "tp bigint, fp bigint, fn bigint, " + ", ".join(f"{n} double" for n in _DRAWN))
    return counts.join(drawn, ["tp", "fp", "fn"])
