from pyspark.sql import functions as F

from lexmill.operators import overview, quality, telemetry
from lexmill.sources import readers, reports


def scored(spark):
    rows = [("d", "facts", "text", 1, 2, 100, ["x", "y"]), ("d", "history", "text", 0, 0, 100, []), ("e", "facts", None, None, 0, 0, [])]
    frame = spark.createDataFrame(rows, "doc_id string, section string, text string, revision long, issue_count long, word_count long, issues array<string>")
    return quality.section_scores(frame)


def test_overview(spark):
    calls = spark.createDataFrame([("d", 1), ("d", 0)], "doc_id string, truncated long")
    rubrics = spark.createDataFrame([("d", 4.5)], "doc_id string, overall double")
    got = {r.doc_id: r for r in overview.overview(scored(spark), calls, spark.createDataFrame([("d",)], "doc_id string"), rubrics).collect()}
    d, e = got["d"], got["e"]
    assert (d.overall_score, d.verdict, d.revisions, d.truncated, d.with_issues, d.missing, d.readiness) == (85.0, "good", 1, 1, ["facts"], [], "Needs Review")
    assert d.diagnosis == "Document is needs review. 1 sections have issues. 1 revisions were needed. 1 calls were truncated."
    assert (e.readiness, e.missing, e.rubric) == ("Not Ready", ["facts"], None)


def test_sections_links_and_evidence(spark):
    rubrics = spark.createDataFrame([("d", "facts", 3.0, 2, "r")], "doc_id string, section string, overall double, revision long, url string")
    joined = overview.sections_with_rubrics(scored(spark), rubrics)
    assert {(r.doc_id, r.section): (r.rubric, r.revision) for r in joined.collect()} == {("d", "facts"): (3.0, 2), ("d", "history"): (None, 0), ("e", "facts"): (None, None)}
    urls = lambda *rows: spark.createDataFrame(list(rows), "doc_id string, section string, url string")
    linked = overview.with_links(joined, urls(("d", "history", "t")), urls(("d", "history", "c"), ("d", "facts", None)))
    assert {(r.doc_id, r.section): r.link for r in linked.collect()} == {("d", "facts"): "r", ("d", "history"): "t", ("e", "facts"): None}
    docs, files = spark.createDataFrame([("d",), ("e",)], "doc_id string"), spark.createDataFrame([("out/d.txt",)], "path string")
    evidence = overview.evidence(docs, [("Final", "out/{doc_id}.txt"), ("Schema", "s/{doc_id}.json")], files)
    assert sorted(map(tuple, evidence.collect())) == [("d", "Final", "available"), ("d", "Schema", "missing"), ("e", "Final", "missing"), ("e", "Schema", "missing")]
    assert [tuple(r) for r in overview.candidates({"a": spark.createDataFrame([("x_002",), ("x_010",)], "doc_id string"), "b": spark.createDataFrame([("x_002",), ("y",)], "doc_id string")}).collect()] == [("x_010", True, False), ("x_002", True, True), ("y", False, True)]
    assert "| d | " not in reports.overview_report("none", overview.totals(scored(spark)), evidence)


def test_rows_of_reviews(spark):
    groups = spark.createDataFrame([("d", {"p": ["a", "b"]})], "doc_id string, groups map<string,array<string>>")
    assert [tuple(r) for r in overview.review_rows(groups).collect()] == [("d", "p", 1, "a"), ("d", "p", 2, "b")]
    values = spark.createDataFrame([("d", {"k": None, "l": 3})], "doc_id string, m map<string,int>")
    assert sorted(map(tuple, overview.key_values(values, "m").collect())) == [("d", "k", ""), ("d", "l", "3")]
    line = spark.range(1).select(overview.health_line(F.lit("Ready"), F.lit(90.0), F.lit(None).cast("double"), F.lit(61_000)).alias("x")).first().x
    assert line == "| Ready | 90.00 | n/a | 1m 1s |"


def test_generation_report_reads_back(spark):
    calls = spark.createDataFrame([(0, "t", "writer", "s", 0, 1500, 1, 2, False, "length", False), (1, "u", "critic", "s", 0, 500, 1, 2, True, "stop", True)], "ord long, task_id string, stage string, section_name string, revision_round long, latency_ms long, tokens_prompt long, tokens_response long, response_empty boolean, done_reason string, error boolean")
    runs = spark.createDataFrame([(0, "plan", "ok", 5, "write"), (1, "write", "error", 7, None)], "ord long, node_name string, status string, latency_ms long, next_node string")
    text = reports.generation_report("d", {"Total calls": 2, "Model": None}, telemetry.stage_rollup(calls), telemetry.node_rollup(runs))
    frame = spark.createDataFrame([("d", text)], "doc_id string, text string")
    assert tuple(readers.report_fields(frame, {"calls": "Total calls", "model": "Model"}).first()) == ("d", "2", None)
    assert [(r.stage, r.total_ms, r.truncated, r.errors) for r in readers.stage_table(frame).orderBy("ord").collect()] == [("critic", 500, 0, 1), ("writer", 1500, 1, 0)]
    assert "| facts | 70 | acceptable | 1 | 100 | x; y |" in reports.quality_report("d", scored(spark))
    counters = spark.createDataFrame([("d", 3)], "doc_id string, raw_rows long")
    assert reports.calibration_report("d", counters) == "# Calibration: d\n\n- raw rows: 3"
