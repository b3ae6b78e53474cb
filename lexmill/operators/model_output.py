"""Parsing of recorded model output: JSON packets, rubrics, edits and review decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

REVIEW = "blocking string, edits array<struct<target:string,action:string,reason:string,replacement:string>>, risk_level string, rubrics map<string,string>"
# Metrics whose low score is critical, and the sentences of decisions.
CRITICAL = ("grounding", "completeness")
KEEP = "keep as is"
NO_EDITS = "Critic marked the section as blocking without specific edits."
RESOLVE = "Revise the section to resolve the blocking critic finding."
IMPROVE = "Revise the section to improve grounded fact coverage and completeness. Use only SECTION_CONTEXT and SECTION_CONTRACT."
NO_ISSUES = "Critic rejected the section without specific issues."
CONSISTENT = "Revise the section to resolve consistency issues and remove any invented facts."
FLAGGED = "Fix the inconsistencies flagged by the critic."
EDIT = "Critic requested a specific edit."


def parse_packet(raw: Column) -> Column:
    """struct(content, summary) of a writer's packet; without readable JSON the cleaned raw text is the content."""
    packet = F.from_json(T.json_object_in(raw), "content string, summary string", {"mode": "PERMISSIVE"})
    return F.struct(F.coalesce(F.nullif(packet["content"], F.lit("")), T.clean_generated(raw)).alias("content"), F.coalesce(packet["summary"], F.lit("")).alias("summary"))


def _last_of_each(pairs: Column) -> Column:
    """A map of (key, value) structs in the order of the keys' first, with the value of their last."""
    first = F.filter(pairs, lambda p, i: (i == 0) | ~F.exists(F.slice(pairs, F.lit(1), F.greatest(i, F.lit(1))), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(F.transform(first, lambda p: F.struct(p["key"].alias("key"), F.element_at(F.filter(pairs, lambda q: q["key"] == p["key"]), -1)["value"].alias("value"))))


def _metric(name: Column) -> Column:
    return F.translate(F.lower(F.trim(name)), " -", "__")


def rubrics_from_map(rubrics: Column) -> Column:
    """Whole scores from 1 to 5 under normalised names, of a map of strings or numbers."""
    entries = F.transform(F.map_entries(rubrics), lambda e: F.struct(_metric(e["key"]).alias("key"), e["value"].cast("string").alias("value")))
    kept = F.filter(entries, lambda e: (e["key"] != "") & F.coalesce(F.regexp_like(e["value"], F.lit("^[1-5]$")), F.lit(False)))
    return _last_of_each(F.transform(kept, lambda e: F.struct(e["key"].alias("key"), e["value"].cast("int").alias("value"))))


def rubrics_from_text(text: Column) -> Column:
    """Scores of lines like ``- metric: 4/5``; the last of a repeated metric counts."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"^\s*-\s*[a-zA-Z][a-zA-Z0-9_ -]{1,40}\s*:\s*[1-5](?:\s*/\s*5)?\s*$")))
    return _last_of_each(F.transform(lines, lambda x: F.struct(_metric(F.regexp_extract(x, r"^\s*-\s*([a-zA-Z][a-zA-Z0-9_ -]{1,40}?)\s*:", 1)).alias("key"), F.regexp_extract(x, r":\s*([1-5])", 1).cast("int").alias("value"))))


def overall(rubrics: Column) -> Column:
    """The explicit overall score, else the mean, else 0."""
    values = F.map_values(rubrics)
    mean = F.try_divide(F.aggregate(values, F.lit(0), lambda a, x: a + x), F.size(values))
    return F.coalesce(F.try_element_at(rubrics, F.lit("overall")).cast("double"), mean, F.lit(0.0))


def critical_issues(rubrics: Column) -> Column:
    low = F.filter(F.map_entries(rubrics), lambda e: e["key"].isin(*CRITICAL) & (e["value"] <= 2))
    return F.transform(low, lambda e: F.concat(F.lit("Critic rubric '"), e["key"], F.lit("' is blocking with score "), e["value"].cast("string"), F.lit("/5.")))


def _between(text: Column, mark: str, stop: Column) -> Column:
    """What stands between a mark and the place ``stop``; empty without the mark."""
    at = F.instr(text, mark)
    return F.when(at > 0, F.substring(text, at + F.lit(len(mark)), F.greatest(stop - at - F.lit(len(mark)), F.lit(0)))).otherwise(F.lit(""))


def _legacy_parts(text: Column) -> tuple[Column, Column, Column]:
    """Rubric block, issues and revision of a review in plain text with the marks RUBRICS, ISSUES and REVISION."""
    at = lambda mark: F.nullif(F.instr(text, mark), F.lit(0))
    end = F.length(text) + 1
    rubrics = _between(text, "RUBRICS:", F.coalesce(at("ISSUES:"), at("REVISION:"), end))
    lines = F.filter(F.split(_between(text, "ISSUES:", F.coalesce(at("REVISION:"), end)), "\n"), lambda x: F.startswith(F.trim(x), F.lit("-")))
    said = F.transform(lines, lambda x: F.trim(F.when(F.startswith(x, F.lit("-")), F.substring(x, F.lit(2), F.length(x))).otherwise(x)))
    white = F.lit(" \t\n")
    return rubrics, F.filter(said, lambda x: F.lower(x) != "none"), F.when(at("REVISION:").isNotNull(), F.btrim(_between(text, "REVISION:", end), white)).otherwise(F.lit(KEEP))


def decide(reviews: DataFrame, raw_column: str = "raw_text", accept: float = 3.5) -> DataFrame:
    """``reviews`` with approved, blocking, issues, revision_instruction, rubrics, overall, edits, risk_level and legacy.

    A readable JSON object is taken as the review: edits block, a critical rubric blocks whatever else, else an overall
    score of ``accept`` approves and clears the issues. Any other text is read by its marks (legacy), null as empty.
    """
    none, text = F.array().cast("array<string>"), F.col("_text")
    out = reviews.withColumn("_text", F.replace(F.coalesce(F.col(raw_column), F.lit("")), F.lit("\r"), F.lit("")))
    out = out.withColumn("_r", F.from_json(F.nullif(T.json_object_in(text), F.lit("")), REVIEW)).withColumn("legacy", F.get_json_object(T.json_object_in(text), "$").isNull())
    block, said, revision = _legacy_parts(text)
    or_else = lambda value, default: F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(default))
    edit = lambda e: F.struct(or_else(e["target"], "section").alias("target"), or_else(e["action"], "revise").alias("action"), or_else(e["reason"], EDIT).alias("reason"), or_else(e["replacement"], "").alias("replacement"))
    edits = F.coalesce(F.transform(F.filter(F.col("_r.edits"), lambda e: e.isNotNull()), edit), F.from_json(F.lit("[]"), "array<struct<target:string,action:string,reason:string,replacement:string>>"))
    rubrics = F.when(F.col("legacy"), rubrics_from_text(block)).otherwise(F.coalesce(rubrics_from_map(F.col("_r.rubrics")), F.create_map().cast("map<string,int>")))
    out = out.withColumns({"rubrics": rubrics, "_edits": edits})
    out = out.withColumns({"overall": overall(F.col("rubrics")), "_critical": critical_issues(F.col("rubrics"))})
    critical, good, any_edit = F.size("_critical") > 0, F.col("overall") >= accept, F.size("_edits") > 0
    own = F.when(F.col("legacy"), said).otherwise(F.transform("_edits", lambda e: F.concat(e["action"], F.lit(" '"), e["target"], F.lit("': "), e["reason"])))
    issues = F.concat(own, F.filter("_critical", lambda c: ~F.array_contains(own, c)))
    out = out.withColumns({"_issues": issues, "_blocks": ~F.lower(F.coalesce("_r.blocking", F.lit(""))).isin("", "false", "0", "0.0", "[]", "{}") | any_edit, "_yes": F.contains(F.lower(text), F.lit("approved: yes"))})
    asked = F.concat(F.lit("Apply these specific critic edits:\n"), F.array_join(F.transform("_edits", lambda e, i: F.concat((i + 1).cast("string"), F.lit(". Target: "), e["target"], F.lit("; action: "), e["action"], F.lit("; reason: "), e["reason"], F.when(e["replacement"] != "", F.concat(F.lit("\n   Replacement: "), e["replacement"])).otherwise(""))), "\n"))
    stuck = F.col("_blocks") & ~any_edit
    json_issues = F.when(critical, F.col("_issues")).when(good, none).when(stuck, F.array(F.lit(NO_EDITS))).otherwise(F.col("_issues"))
    json_says = F.when(critical, IMPROVE).when(good, KEEP).when(stuck, RESOLVE).when(any_edit, asked).otherwise(KEEP)
    json_blocks = F.when(critical, True).when(good, False).otherwise(F.col("_blocks"))
    yes, clear = F.col("_yes"), good & ~critical
    old_issues = F.when(clear, none).when(~yes & (F.size("_issues") == 0), F.array(F.lit(NO_ISSUES))).otherwise(F.col("_issues"))
    told = F.when(revision == "", FLAGGED).otherwise(revision)
    old_says = F.when(clear, KEEP).when(~yes & (F.lower(told) == KEEP), CONSISTENT).otherwise(told)
    legacy = F.col("legacy")
    out = out.withColumns({"issues": F.when(legacy, old_issues).otherwise(json_issues), "revision_instruction": F.when(legacy, old_says).otherwise(json_says)})
    blocking = F.when(legacy, ~(yes | clear) | (F.size("issues") > 0)).otherwise(json_blocks)
    risk = F.when(legacy, F.when(F.size("issues") > 0, "medium").otherwise("low")).when(F.col("_r.risk_level").isin("low", "medium", "high"), F.col("_r.risk_level")).when(F.col("_blocks"), "medium").otherwise("low")
    revise = F.transform("issues", lambda x: F.struct(F.lit("section").alias("target"), F.lit("revise").alias("action"), x.alias("reason"), F.lit("").alias("replacement")))
    out = out.withColumns({"blocking": blocking, "approved": ~blocking, "risk_level": risk, "edits": F.when(legacy, revise).otherwise(F.col("_edits"))})
    return out.drop("_text", "_r", "_edits", "_critical", "_issues", "_blocks", "_yes")


def shortened_error(message: Column, service: str, most: int = 240) -> Column:
    """One line for a failed read: a page limit, a status with its body, or the message cut to ``most``."""
    status, body = F.regexp_extract(message, r"status_code:\s*(\d+)", 1), F.regexp_extract(message, r"body:\s*(\{.*\})", 1)
    cut = F.when(F.length(message) > most, F.concat(F.rtrim(F.left(message, F.lit(most - 3))), F.lit("..."))).otherwise(message)
    lead = f"{service} read failed: "
    return F.when(F.contains(message, F.lit("limit")) & F.contains(message, F.lit("100")), F.lit(lead + "API pagination limit exceeded")).when((status != "") & (body != ""), F.concat(F.lit(lead + "HTTP "), status, F.lit(" "), body)).otherwise(F.concat(F.lit(lead), cut))
