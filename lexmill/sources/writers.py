"""Writers of case artifacts, and Markdown reports of small results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def groundtruth(rows: DataFrame, path: str, mode: str = "errorifexists", folders: int | None = 64) -> None:
    """Ground-truth TSV with CRLF line ends; existing output is refused by default.

    Documents share ``folders`` folders by a hash of their id; with None each has its own, for an export of few.
    """
    folder = F.pmod(F.xxhash64("doc_id"), F.lit(folders)).alias("_folder") if folders else F.col("doc_id").alias("_folder")
    kept = rows.select("doc_id", folder, "entity_text", "label", "should_propose", "notes")
    (kept.repartition("_folder") if folders else kept).write.partitionBy("_folder").csv(path, sep="\t", header=True, quote='"', escape='"', lineSep="\r\n", mode=mode)


def metrics(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Metrics as JSON lines with their fields in alphabetical order."""
    rows.select(F.to_json(F.struct(*sorted(rows.columns))).alias("value")).write.mode(mode).text(path)


def documents(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Document texts, partitioned by document."""
    rows.select("doc_id", F.col("text").alias("value")).write.partitionBy("doc_id").mode(mode).text(path)


def sections(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Section texts by document, section and revision."""
    rows.write.partitionBy("doc_id", "section", "revision").mode(mode).parquet(path)


def case_schemas(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).json(path)


def append_history(rows: DataFrame, path: str) -> None:
    """Run history: rows are only ever appended."""
    rows.write.mode("append").parquet(path)


def rubric_scores(reviews: DataFrame) -> DataFrame:
    """Long rows ``rubric.<metric>`` and ``rubric.overall`` from (observation_id, rubrics, overall)."""
    each = reviews.select("observation_id", F.explode("rubrics").alias("m", "v")).select("observation_id", F.concat(F.lit("rubric."), "m").alias("name"), F.col("v").cast("double").alias("value"))
    return each.unionByName(reviews.select("observation_id", F.lit("rubric.overall").alias("name"), F.col("overall").cast("double").alias("value")))


def artifact(rows: DataFrame, most: int = 24_000) -> DataFrame:
    """Texts shortened for display."""
    return rows.withColumn("text", F.substring("text", F.lit(1), F.lit(most)))


def audit(files: DataFrame, path: str) -> None:
    files.orderBy("path").write.mode("overwrite").json(path)


def markdown_table(rows: DataFrame, columns: list[str], most: int = 1000) -> str:
    """A Markdown table of a small report: its first ``most`` rows, and a last line that tells if there were more."""
    cell = lambda c: F.coalesce(F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|")), F.lit("n/a"))
    lines = rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, columns)), F.lit(" |")).alias("line")).limit(most + 1).collect()
    lines = [r.line for r in lines]
    if len(lines) > most:
        lines[most:] = [f"| first {most} rows only |" + " |" * (len(columns) - 1)]
    head = ["| " + " | ".join(columns) + " |", "| " + " | ".join("---" for _ in columns) + " |"]
    return "\n".join(head + lines)


def evaluation_report(doc_id: str, metrics_of_doc: DataFrame, by_label: DataFrame) -> str:
    """Markdown report of one document's evaluation."""
    row = metrics_of_doc.where(F.col("doc_id") == doc_id).select("tp", "fp", "fn", *[T.percent(F.col(c)).alias(c) for c in ("precision", "recall", "f1")]).first()
    lines = [f"# Entity evaluation: {doc_id}", ""]
    lines += [f"- {name}: {row[name]}" for name in row.__fields__] if row else ["- no rows"]
    return "\n".join([*lines, "", "## By label", "", markdown_table(by_label.where(F.col("doc_id") == doc_id).orderBy("label"), ["label", "tp", "fp", "fn"])])


def combined_report(*reports: str) -> str:
    """Several reports one after the other, each with its headings one level lower."""
    lower = lambda line: "#" + line if line.startswith("#") and len(line) - len(line.lstrip("#")) < 6 else line
    return "\n\n".join("\n".join(lower(x) for x in r.split("\n")) for r in reports)
