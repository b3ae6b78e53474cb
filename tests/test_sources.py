import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from lexmill.sources import paged, readers, writers
from lexmill.streaming import rollups


def test_groundtruth_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("d1", 'a "quoted"\tname\nover lines', "Person", "yes", ""), ("d2", "x", "ORG", "no", "n")], readers.GROUNDTRUTH)
    writers.groundtruth(rows, str(tmp_path / "gt"))
    back = readers.groundtruth(spark, str(tmp_path / "gt" / "*"))
    assert sorted(map(tuple, back.collect())) == [("d1", 'a "quoted"\tname\nover lines', "PERSON", "yes", ""), ("d2", "x", "ORG", "no", "n")]
    with pytest.raises(Exception, match="exists"):
        writers.groundtruth(rows, str(tmp_path / "gt"))


def test_predictions(spark, tmp_path):
    folder = tmp_path / "doc-1"
    folder.mkdir()
    lines = [{"entities": [{"entity_name": " Ann ", "label": "Person"}, {"entity_name": "  "}, {"entity_name": "A", "label": "", "entity_label": "Organisation", "abs_start_pos": 3}]}, {"entities": []}, {"entities": [{"entity_name": "Z"}]}]
    (folder / "predictions.jsonl").write_text("\n\n".join(map(json.dumps, lines)) + "\n")
    got = readers.predictions(spark, str(folder / "predictions.jsonl")).orderBy("ord").collect()
    assert [(r.doc_id, r.text, r.label, r.abs_start_pos) for r in got] == [("doc-1", "Ann", "PERSON", None), ("doc-1", "A", "ORG", 3), ("doc-1", "Z", "", None)]
    (folder / "bad.jsonl").write_text('{"entities": [}')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|corrupt"):
        readers.predictions(spark, str(folder / "bad.jsonl")).collect()


def test_texts_sections_and_files(spark, tmp_path):
    (tmp_path / "d1.txt").write_text("one two\nthree")
    text = readers.whole_texts(spark, str(tmp_path / "d1.txt")).first()
    assert tuple(text) == ("d1", "one two\nthree", 3)
    for revision in ("r0", "r10", "r2", "x"):
        folder = tmp_path / "_partial" / "doc" / "sections" / "facts" / revision
        folder.mkdir(parents=True)
        (folder / "combined.txt").write_text(revision)
        (folder / "chunk.txt").write_text("no")
    got = readers.section_artifacts(spark, str(tmp_path / "_partial")).collect()
    assert sorted((r.doc_id, r.section, r.revision, r.text) for r in got) == [("doc", "facts", 0, "r0"), ("doc", "facts", 2, "r2"), ("doc", "facts", 10, "r10")]
    import hashlib

    files = {r.path.rpartition("/")[2]: r for r in readers.files(spark, str(tmp_path), "d1.txt").collect()}
    assert files["d1.txt"].sha256 == hashlib.sha256(b"one two\nthree").hexdigest() and files["d1.txt"].size_bytes == 13
    assert readers.first_existing(spark, [str(tmp_path / "none"), str(tmp_path / "d1.txt")]).endswith("d1.txt")
    with pytest.raises(FileNotFoundError):
        readers.first_existing(spark, [str(tmp_path / "none")])


def test_report_scans(spark):
    report = "# R\n- Total calls: 1,204\n- Model: n/a\n- Total calls: 9\n\n| Stage | Calls | Total ms | Avg ms | Prompt Tokens | Response Tokens | Empty | Truncated | Errors |\n|---|---|---|---|---|---|---|---|---|\n| writer | 3 | 1,200 | 400 | 10 | 20 | 0 | 1 | 0 |\n| critic | 1 | x | 5 | 1 | 2 | 0 | 0 | 0 |\n\n| late | 1 | 1 | 1 | 1 | 1 | 1 | 1 | 1 |"
    reports = spark.createDataFrame([("d", report), ("e", "nothing")], "doc_id string, text string")
    got = {r.doc_id: (r.calls, r.model) for r in readers.report_fields(reports, {"calls": "Total calls", "model": "Model"}).collect()}
    assert got == {"d": ("1,204", None), "e": (None, None)}
    assert [(r.doc_id, r.stage, r.calls, r.total_ms) for r in readers.stage_table(reports).orderBy("ord").collect()] == [("d", "writer", 3, 1200), ("d", "critic", 1, 0)]


class Server(BaseHTTPRequestHandler):
    def do_GET(self):
        asked = parse_qs(urlparse(self.path).query)
        if "page" in asked:
            page = int(asked["page"][0])
            body = {"data": [{"id": f"p{page}-{i}", "name": "rubric.x", "value": i} for i in range(2)], "meta": {"total_pages": 3}}
        else:
            at = asked.get("cursor", [""])[0]
            body = {"data": [{"id": f"c{at}", "value": "bad"}], "meta": {"next_cursor": {"": "1", "1": "2"}.get(at)}}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *_):
        pass


def test_paged_source(spark):
    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/scores"
    spark.dataSource.register(paged.PagedSource)
    pages = spark.read.format("paged_rest").option("url", url + "?page={page}&limit={limit}").load()
    assert pages.rdd.getNumPartitions() == 3
    assert sorted((r.id, r.value) for r in pages.collect()) == [(f"p{p}-{i}", float(i)) for p in (1, 2, 3) for i in (0, 1)]
    cursor = spark.read.format("paged_rest").option("url", url + "?cursor={cursor}").option("mode", "cursor").load()
    assert sorted((r.id, r.value) for r in cursor.collect()) == [("c", None), ("c1", None), ("c2", None)]
    server.shutdown()


def test_writers(spark, tmp_path):
    writers.metrics(spark.createDataFrame([(1, 2.5)], "z int, a double"), str(tmp_path / "m"))
    assert spark.read.text(str(tmp_path / "m")).first().value == '{"a":2.5,"z":1}'
    writers.documents(spark.createDataFrame([("d", "text")], "doc_id string, text string"), str(tmp_path / "docs"))
    assert spark.read.text(str(tmp_path / "docs")).first().value == "text"
    sections = spark.createDataFrame([("d", "s", 1, "t")], "doc_id string, section string, revision int, text string")
    for _ in range(2):
        writers.sections(sections, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2
    assert writers.markdown_table(spark.createDataFrame([("a|b", None)], "x string, y string"), ["x", "y"]) == "| x | y |\n| --- | --- |\n| a\\|b | n/a |"
    metrics = spark.createDataFrame([("d", 1, 1, 0, 0.5, 1.0, 2 / 3)], "doc_id string, tp int, fp int, fn int, precision double, recall double, f1 double")
    report = writers.evaluation_report("d", metrics, spark.createDataFrame([("d", "ORG", 1, 1, 0)], "doc_id string, label string, tp int, fp int, fn int"))
    assert "- precision: 50.00%" in report and "| ORG | 1 | 1 | 0 |" in report
    assert writers.combined_report("# a\ntext", "###### b") == "## a\ntext\n\n###### b"
    long = writers.rubric_scores(spark.createDataFrame([("o", {"style": 4}, 4.0)], "observation_id string, rubrics map<string,int>, overall double"))
    assert sorted((r.name, r.value) for r in long.collect()) == [("rubric.overall", 4.0), ("rubric.style", 4.0)]


def test_streams_equal_tables(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rollups.EVENT).parquet(str(tmp_path / "in"))
    q = rollups.windowed_stages(stream, late="400 days").writeStream.format("memory").queryName("daily").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda f: sorted((r.window_start, r.stage, r.calls, r.largest) for r in f.collect())
    assert key(spark.table("daily")) == key(rollups.windowed_stages(events))
    for _ in range(2):  # a restart adds nothing twice
        rollups.append_history(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()
    revisions = spark.createDataFrame([("d", "s", 1, "a"), ("d", "s", 2, "b")], "doc_id string, section string, revision long, text string")
    assert [tuple(r) for r in rollups.latest_revisions(revisions).collect()] == [("d", "s", 2, "b")]
