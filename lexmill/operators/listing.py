"""Listings of artifacts, candidates, identifiers and file audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def union_of_ids(*roots: DataFrame) -> DataFrame:
    """Distinct document ids of several listings, with a flag for each."""
    flagged = [r.select("doc_id").distinct().withColumn("root", F.lit(i)) for i, r in enumerate(roots)]
    flags = [F.max(F.col("root") == i).alias(f"in_{i}") for i in range(len(roots))]
    return reduce(DataFrame.unionByName, flagged).groupBy("doc_id").agg(*flags)


def ordered_candidates(ids: DataFrame) -> DataFrame:
    """Ids with their counter, highest first; ids without one last; ties by id."""
    return ids.withColumn("counter", F.coalesce(T.doc_counter(F.col("doc_id")), F.lit(-1))).orderBy(F.col("counter").desc(), "doc_id")


def next_counter(ids: DataFrame, prefix: str) -> DataFrame:
    """One row: the number after the largest of ids with a prefix, 1 without any."""
    return ids.where(F.startswith("doc_id", F.lit(prefix))).agg((F.coalesce(F.max(T.doc_counter(F.col("doc_id"))), F.lit(0)) + 1).alias("next_counter"))


def evaluation_candidates(texts: DataFrame, groundtruth: DataFrame) -> DataFrame:
    """Documents with a text and ground truth, newest first; folders that begin with an underscore don't count."""
    ready = texts.join(groundtruth.select("doc_id").distinct(), "doc_id").where(~F.startswith("doc_id", F.lit("_")))
    return ready.groupBy("doc_id").agg(F.max("modified_at").alias("modified_at")).orderBy(F.col("modified_at").desc(), "doc_id")


def inputs_record(expected: DataFrame, files: DataFrame) -> DataFrame:
    """Expected roles (role, required, path) with what exists of them."""
    return expected.join(files, "path", "left").withColumn("exists", F.col("sha256").isNotNull())


def longest_values(values, most: int):
    """The ``most`` longest of an array's values, normalised; of one length in the order of their text."""
    known = F.array_distinct(F.filter(F.transform(values, T.normalize_phrase), lambda v: v != ""))
    return F.slice(F.transform(F.array_sort(F.transform(known, lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v")))), lambda x: x["v"]), 1, most)


def section_counts(artifacts: DataFrame) -> DataFrame:
    """Number of different sections that a document has artifacts of."""
    return artifacts.groupBy("doc_id").agg(F.count_distinct("section").alias("sections"))


def group_counts(organisations: DataFrame) -> DataFrame:
    """Charged and associated organisations of each document; a group that isn't ``associated`` counts as charged."""
    associated = F.coalesce(F.lower(F.trim("grp")) == "associated", F.lit(False))
    return organisations.groupBy("doc_id").agg(F.count_if(~associated).alias("charged"), F.count_if(associated).alias("associated"))


def size_label(targets):
    """Label of a map of section word targets."""
    return F.concat(F.aggregate(F.map_values(targets), F.lit(0).cast("bigint"), lambda a, x: a + x).cast("string"), F.lit("w prose"))
