"""Readers with explicit schemas; nothing is inferred, and paths are only opened by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

GROUNDTRUTH = "doc_id string, entity_text string, label string, should_propose string, notes string"
PREDICTION = "entities array<struct<entity_name:string,label:string,entity_label:string,reason:string,abs_start_pos:bigint>>"
SCHEMA = "doc_id string, nodes array<struct<id:string,name:string,type:string>>, edges array<struct<`from`:string,`to`:string,type:string,label:string>>"


def groundtruth(spark: SparkSession, path: str) -> DataFrame:
    """Ground-truth TSV with a header: fields may be quoted and hold tabs or line ends; labels become canonical."""
    raw = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True, schema=GROUNDTRUTH, enforceSchema=False)
    blank = lambda c, default: F.coalesce(F.col(c), F.lit(default))
    return raw.select(blank("doc_id", "").alias("doc_id"), blank("entity_text", "").alias("entity_text"), T.canonical_label(blank("label", "")).alias("label"), blank("should_propose", "yes").alias("should_propose"), blank("notes", "").alias("notes"))


def predictions(spark: SparkSession, path: str, doc_id: str | None = None) -> DataFrame:
    """Predicted entities, one row each, from JSON lines; a malformed line raises, blank names are dropped.

    doc_id is the name of the folder that holds the file unless given; ord follows the file's own order.
    """
    raw = spark.read.schema(PREDICTION).option("mode", "FAILFAST").json(path)
    doc = F.lit(doc_id) if doc_id else F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1)
    rows = raw.select(doc.alias("doc_id"), F.explode("entities").alias("e")).withColumn("ord", F.monotonically_increasing_id())
    flat = rows.where(F.trim(F.col("e.entity_name")) != "")
    label = T.canonical_label(F.coalesce(F.nullif(F.col("e.label"), F.lit("")), F.col("e.entity_label"), F.lit("")))
    return flat.select("doc_id", "ord", F.trim("e.entity_name").alias("text"), label.alias("label"), F.coalesce("e.reason", F.lit("")).alias("reason"), F.col("e.abs_start_pos").alias("abs_start_pos"))


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text, n_words): one row a file, named after it."""
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True).withColumn("path", F.col("_metadata.file_path"))
    return raw.select(F.regexp_extract("path", r"([^/]+?)(?:\.[A-Za-z0-9]+)?$", 1).alias("doc_id"), F.col("value").alias("text"), T.words(F.col("value")).cast("bigint").alias("n_words"))


def case_schema(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("multiLine", True).json(path)


def section_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, section, revision, text, path) of ``.../{doc}/sections/{section}/r{N}/combined.txt``."""
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="combined.txt").withColumn("path", F.col("_metadata.file_path"))
    part = lambda k: F.regexp_extract("path", r"([^/]+)/sections/([^/]+)/r(\d+)/combined\.txt$", k)
    return raw.select(part(1).alias("doc_id"), part(2).alias("section"), part(3).try_cast("bigint").alias("revision"), F.col("value").alias("text"), "path").where("revision is not null")


def report_fields(reports: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Values of ``- Key: value`` lines of Markdown reports (doc_id, text): the first of each; ``n/a`` is null."""
    value = lambda key: F.nullif(F.nullif(F.trim(F.regexp_extract("text", rf"(?m)^- \Q{key}\E:[ \t]*(.*)$", 1)), F.lit("")), F.lit("n/a"))
    return reports.select("doc_id", *[value(key).alias(name) for name, key in keys.items()])


def stage_table(reports: DataFrame) -> DataFrame:
    """Rows of the stage table in Markdown reports, up to the first line that isn't a row of it."""
    names = ("calls", "total_ms", "avg_ms", "prompt_tokens", "response_tokens", "empty", "truncated", "errors")
    lines = F.split(F.regexp_extract("text", r"(?s)(?:^|\n)\| Stage \|[^\n]*\n(.*)$", 1), "\n")
    cells = F.transform(F.slice(lines, F.lit(2), F.size(lines)), lambda x: F.transform(F.split(F.btrim(F.trim(x), F.lit("|")), r"\|"), lambda c: F.trim(c)))
    bad = F.filter(F.transform(cells, lambda c, i: F.when(F.size(c) != 9, i)), lambda i: i.isNotNull())
    rows = F.slice(cells, F.lit(1), F.coalesce(F.get(bad, F.lit(0)), F.size(cells)))
    flat = reports.select("doc_id", F.posexplode(rows).alias("ord", "c"))
    return flat.select("doc_id", "ord", F.get("c", F.lit(0)).alias("stage"), *[T.lenient_int(F.get("c", F.lit(i + 1))).alias(n) for i, n in enumerate(names)])


def files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, size_bytes, sha256, modified_at) of the files under a path, each hashed where it is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    raw = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    return raw.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("modified_at"))


def first_existing(spark: SparkSession, candidates: list[str]) -> str:
    """The first of several paths that exists, asked of its own file system."""
    for path in candidates:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            return path
    raise FileNotFoundError(f"none of {candidates} exists")
