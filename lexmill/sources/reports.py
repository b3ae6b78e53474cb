"""Markdown reports of single documents. Each collects the few rows of one document, never a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .writers import markdown_table


def _of(frame: DataFrame, doc_id: str) -> DataFrame:
    return frame.where(F.col("doc_id") == doc_id)


def quality_report(doc_id: str, scored: DataFrame) -> str:
    """Sections of one document with score, verdict, revision and issues."""
    rows = _of(scored, doc_id).withColumn("issues", F.array_join("issues", "; ")).orderBy("section")
    columns = ["section", "score", "verdict", "revision", "word_count", "issues"] + ["link"] * ("link" in scored.columns)
    return f"# Quality: {doc_id}\n\n{markdown_table(rows, columns)}"


def overview_report(doc_id: str, overview: DataFrame, evidence: DataFrame) -> str:
    row = _of(overview, doc_id).first()
    lines = [f"# Overview: {doc_id}", ""]
    if row is None:
        return "\n".join([*lines, "- no data"])
    for name in ("readiness", "overall_score", "verdict", "rubric", "revisions", "truncated", "diagnosis"):
        lines.append(f"- {name.replace('_', ' ').capitalize()}: {'n/a' if row[name] is None else row[name]}")
    return "\n".join([*lines, "", "## Evidence", "", markdown_table(_of(evidence, doc_id).orderBy("evidence"), ["evidence", "status"])])


def generation_report(doc_id: str, fields: dict[str, object], stages: DataFrame, nodes: DataFrame) -> str:
    """Header fields, stage table and node table; ``readers.report_fields`` and ``readers.stage_table`` read them back."""
    lines = [f"# Generation: {doc_id}", ""] + [f"- {k}: {'n/a' if v is None else v}" for k, v in fields.items()]
    table = stages.select(F.col("stage").alias("Stage"), F.col("calls").alias("Calls"), F.col("total_ms").alias("Total ms"), F.col("avg_ms").alias("Avg ms"), F.col("tokens_prompt").alias("Prompt Tokens"), F.col("tokens_response").alias("Response Tokens"), F.col("empty").alias("Empty"), F.col("truncated").alias("Truncated"), F.col("errors").alias("Errors")).orderBy("Stage")
    runs = nodes.orderBy("first_ord")
    return "\n".join([*lines, "", markdown_table(table, table.columns), "", "## Nodes", "", markdown_table(runs, ["node_name", "executions", "avg_ms", "max_ms", "errors", "next_nodes"])])


def calibration_report(doc_id: str, counters: DataFrame) -> str:
    row = _of(counters, doc_id).first()
    names = [n for n in counters.columns if n != "doc_id"]
    return "\n".join([f"# Calibration: {doc_id}", "", *(f"- {n.replace('_', ' ')}: {row[n]}" for n in names if row is not None)])
