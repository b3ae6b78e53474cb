import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexmill.operators import evaluation, generate, graph, groundtruth, listing, model_output, quality, telemetry

ENTITY = "doc_id string, ord long, text string, label string"


def entities(spark, *rows):
    return spark.createDataFrame(list(rows), ENTITY)


def test_strict_metrics(spark):
    e = entities(spark, ("d", 0, "Ann  Lee", "PERSON"), ("d", 1, "ann lee", "Person"), ("d", 2, "ACME LTD", "ORG"), ("x", 0, "Z", "ORG"))
    p = entities(spark, ("d", 0, "ANN LEE", "Person"), ("d", 1, "acme ltd", "Person"))
    got = {r.doc_id: r for r in evaluation.with_rates(evaluation.confusion(e, p)).collect()}
    assert (got["d"].tp, got["d"].fp, got["d"].fn, got["d"].precision, got["d"].recall, got["d"].f1) == (1, 1, 1, 0.5, 0.5, 0.5)
    assert (got["x"].tp, got["x"].precision, got["x"].f1) == (0, 0.0, 0.0)
    assert evaluation.strict_matches(e, p).count() == 2  # repeated ground truth repeats
    assert evaluation.confusion(e.limit(0), p.limit(0)).collect() == []


def greedy(expected, predicted):
    used, out = set(), 0
    for e in expected:
        best = None
        for i, p in enumerate(predicted):
            if i in used:
                continue
            et, pt = e.split(), set(p.split())
            c = sum(t in pt for t in et) / len(et)
            if c >= 0.8 and (best is None or c > best[0]):
                best = (c, i)
        if best:
            used.add(best[1])
            out += 1
    return out


def test_soft_matches_equal_a_plain_loop(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefg")
    sides = {d: [[" ".join(word() for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 7))] for _ in range(2)] for d in "pqrstu"}
    frames = [entities(spark, *[(d, i, t, "PERSON") for d, s in sides.items() for i, t in enumerate(s[k])]) for k in (0, 1)]
    got = {r.doc_id: (r.tp, r.fp, r.fn) for r in evaluation.soft_confusion(*frames).collect()}
    for d, (e, p) in sides.items():
        tp = greedy(e, p)
        assert got.get(d, (0, 0, 0)) == (tp, len(p) - tp, len(e) - tp)


def test_address_form_counts_once(spark):
    full = "12 High Street, London SW1A 1AA"
    e = entities(spark, ("d", 0, full, "ADDRESS"), ("d", 1, "12 High Street", "ADDRESS"), ("d", 2, "London SW1A 1AA", "ADDRESS"))
    row = evaluation.soft_confusion(e, entities(spark, ("d", 0, full, "Address"))).first()
    assert (row.tp, row.fp, row.fn) == (1, 0, 2)


def test_calibration(spark):
    gt = spark.createDataFrame([("d", 0, "ann lee", "Person", "yes", ""), ("d", 1, "2 March 2025", "Date", "yes", ""), ("d", 2, "Fraud Office", "NEGATIVE_CONTROL", "no", "")], ENTITY + ", should_propose string, notes string")
    docs = spark.createDataFrame([("d", "Then ANN\n LEE met ACME (UK) LTD at the Fraud Office.")], "doc_id string, text string")
    memory = entities(spark, ("d", 10, "acme (uk) ltd", "ORG"), ("d", 11, "Absent LTD", "ORG"), ("d", 12, "ANN LEE", "PERSON"))
    rows = lambda mode: sorted((r.text, r.label) for r in evaluation.calibrate(gt, docs, memory, mode).collect())
    assert rows("off") == rows("diagnose") == [("2 March 2025", "DATE"), ("ann lee", "PERSON")]
    assert rows("apply_safe") == [("ANN\n LEE", "PERSON")]
    assert rows("apply_with_memory") == [("ACME (UK) LTD", "ORG"), ("ANN\n LEE", "PERSON")]
    with pytest.raises(ValueError, match="mode"):
        evaluation.calibrate(gt, docs, memory, "other")
    c = evaluation.calibration_counters(gt, docs, memory).first()
    assert (c.raw_rows, c.raw_positive_rows, c.negative_control_rows, c.absent_positive_rows, c.surface_normalizations, c.memory_candidates, c.missing_memory_candidates) == (3, 2, 1, 1, 1, 3, 1)
    assert evaluation.negative_control_hits(gt, entities(spark, ("d", 0, "fraud  OFFICE", "ORG"))).count() == 1


def test_posteriors(spark):
    counts = spark.createDataFrame([(3, 1, 2), (0, 0, 0), (3, 1, 2)], "tp long, fp long, fn long")
    rows = evaluation.posterior_intervals(counts).collect()
    assert len(rows) == 3
    r = next(x for x in rows if x.tp == 3)
    rng = random.Random(20260619 + 3 * 131 + 4 * 29)
    draws = sorted(rng.betavariate(4, 2) for _ in range(20_000))
    assert (r.precision_low, r.precision_high) == (draws[round(0.025 * 19_999)], draws[round(0.975 * 19_999)])
    assert r.f1_low < r.f1_median < r.f1_high
    closed = [tuple(x)[3:] for x in evaluation.rate_posterior(counts).collect()]
    assert closed == [(0.75, 0.75, 4 / 6), (0.0, 0.5, 0.5), (0.75, 0.75, 4 / 6)]


def test_section_scores(spark):
    rows = spark.createDataFrame([("a", "x", 0, 0, 100), ("b", "x", 9, 9, 10), ("c", None, 0, 0, 0), ("d", "x", 1, 1, 79)], "section string, text string, revision long, issue_count long, word_count long")
    got = {r.section: (r.score, r.verdict, r.issue_penalty) for r in quality.section_scores(rows).collect()}
    assert got == {"a": (100, "good", 0), "b": (7, "bad", 60), "c": (0, "missing", 100), "d": (67, "risky", 12)}
    doc = quality.document_scores(quality.section_scores(rows).withColumn("doc_id", F.lit("d"))).first()
    assert (doc.overall_score, doc.verdict, doc.missing_sections) == (43.5, "bad", 1)
    with pytest.raises(ValueError, match="weights"):
        quality.checked_weights({"revision_penalty": -1})


def test_revisions_and_failures(spark):
    rows = spark.createDataFrame([("d", "s", 1, "a"), ("d", "s", 3, "b"), ("d", "s", 3, "c"), ("d", "t", None, "e"), ("d", "t", None, "f")], "doc_id string, section string, revision long, text string")
    assert sorted(r.text for r in quality.latest_revision_set(rows).collect()) == ["b", "c", "e", "f"]
    assert quality.latest_revision(rows.where("section = 's'")).first().revision == 3
    issues = spark.createDataFrame([(["x", "y"],), (["y"],), ([],)], "issues array<string>")
    assert [tuple(r) for r in quality.top_failures(issues, 1).collect()] == [("y", 2)]
    decide = lambda *v: spark.range(1).select(quality.readiness(*map(F.lit, v))).first()[0]
    assert [decide(True, 0, 90, 0, 0, 4.0), decide(True, 0, 90, 0, 0, 3.0), decide(True, 1, 90, 0, 0, 4.0), decide(False, 0, 90, 0, 0, 4.0), decide(True, 0, 84, 0, 0, 4.0)] == ["Ready", "Needs Review", "Not Ready", "Not Ready", "Needs Review"]


def test_telemetry(spark):
    calls = spark.createDataFrame([(0, "t0", "a", "s", 1, 5, None, 2, False, "length", False), (1, "t1", None, "s", 0, 4, 3, 2, True, "stop", True), (2, "t2", "a", "u", 2, 10, 3, None, None, None, None)], "ord long, task_id string, stage string, section_name string, revision_round long, latency_ms long, tokens_prompt long, tokens_response long, response_empty boolean, done_reason string, error boolean")
    got = {r.stage: r for r in telemetry.stage_rollup(calls).collect()}
    assert (got["a"].calls, got["a"].total_ms, got["a"].avg_ms, got["a"].truncated, got["a"].revised_sections) == (2, 15, 8, 1, 2)
    assert (got["unknown"].errors, got["unknown"].empty, got["unknown"].tokens_prompt) == (1, 1, 3)
    assert telemetry.largest_call(calls, "tokens_prompt").first().task_id == "t1"  # the first on a tie
    scores = spark.createDataFrame([(0, "rubric.style", 4.0, "o1"), (1, "rubric.style", 2.0, "o2"), (2, "rubric.overall", 1.0, "o1"), (3, "x", 1.0, "o1"), (4, "rubric.tone", None, "o1")], "ord long, name string, value double, observation_id string")
    obs = spark.createDataFrame([("o1", "s", 1), ("o2", "s", 0)], "observation_id string, section_name string, revision_round long")
    rub = telemetry.with_observation(telemetry.rubric_scores(scores), obs)
    assert [(r.metric, r.average) for r in telemetry.rubric_summary(rub).collect()] == [("style", 3.0)]
    assert [tuple(r) for r in telemetry.section_rubrics(rub).collect()] == [("s", 4.0, 1, 1)]
    seen = spark.createDataFrame([("s", 1, "writer", "w_chunk_10"), ("s", 1, "writer", "w_chunk_9"), ("u", 0, "writer", "w"), ("u", 0, "polisher", "p")], "section_name string, revision_round long, stage string, task_id string")
    assert sorted((r.section_name, r.ord, r.task_id) for r in telemetry.latest_observations(seen).collect()) == [("s", 1, "w_chunk_9"), ("s", 2, "w_chunk_10"), ("u", 1, "p")]


def test_groundtruth_rows(spark):
    persons, orgs = generate.persons(spark, 3), generate.organisations(spark, 3)
    meta = persons.select("doc_id").distinct().selectExpr("doc_id", "'CPS/2024/0001' case_number", "'C/2024/1' cross_ref", "'3 March 2026' filing_date", "cast(null as string) offence_start", "'' offence_end")
    counts = spark.createDataFrame([("en_indictment_fraud_001", 0, "EUR 10,000 and £5")], "doc_id string, ord long, particulars string")
    amounts = spark.createDataFrame([("en_indictment_fraud_001", 0, "EUR 10,000"), ("en_indictment_fraud_001", 1, "£7")], "doc_id string, ord long, value string")
    controls = spark.createDataFrame([("en_indictment_fraud_001", 0, "Fraud Office", "prosecution")], "doc_id string, ord long, value string, notes string")
    rows = groundtruth.build(persons, orgs, meta, counts, amounts, controls)
    first = Counter(r.label for r in rows.where("doc_id = 'en_indictment_fraud_001'").collect())
    assert first == {"PERSON": 3, "ORG": 2, "CASE_REFERENCE": 2, "DATE": 4, "AMOUNT": 3, "INITIAL": 3, "TITLE": 3, "ADDRESS": 9, "VAT": 2, "NEGATIVE_CONTROL": 1}
    texts = rows.where("label = 'AMOUNT' or label = 'ORG'").groupBy("doc_id").agg(F.array_join(F.collect_list(F.upper("entity_text")), " ; ").alias("text"))
    assert groundtruth.rendered_only(rows, texts).where("label = 'AMOUNT'").count() == 3
    assert generate.persons(spark, 3).exceptAll(persons).count() == 0  # seeded
    facts = groundtruth.allowed_facts(persons, orgs, meta, amounts)
    docs = spark.createDataFrame([("en_indictment_fraud_001", "On 3 March 2026 and 4 March 2026.")], "doc_id string, text string")
    assert [r.value for r in groundtruth.unknown_values(docs, facts, "date", r"\d+ March \d{4}").collect()] == ["4 March 2026"]


def test_graph(spark):
    side = lambda *rows: spark.createDataFrame([("d", i, n) for i, n in enumerate(rows)], "doc_id string, ord long, name string")
    got = {(r.src, r.dst, r.type) for r in graph.edges(side("a", "b", "c"), side("x", "y"), side("O", "P"), side("Q")).collect()}
    assert got == {("a", "O", "controlled"), ("b", "P", "controlled"), ("c", "O", "controlled"), ("a", "x", "instructed"), ("a", "y", "instructed"), ("a", "b", "conspired_with"), ("b", "c", "conspired_with"), ("O", "Q", "received_funds_from"), ("P", "Q", "received_funds_from")}
    assert graph.edges(side("a"), side(), side(), side()).collect() == []
    assert {(r.from_org, r.to_org, r.amount) for r in graph.transfers(side("O", "P"), side("Q")).collect()} == {("O", "Q", 25000), ("P", "Q", 50000)}
    assert sorted(r.id for r in graph.nodes(side("a", "b"), side("O")).collect()) == ["o1", "p1", "p2"]
    blocks = spark.createDataFrame([("d", 1, "B", 0, None), ("d", 0, "A", 1, "y"), ("d", 0, "A", 0, "x")], "doc_id string, block_ord int, heading string, ord long, line string")
    assert graph.memory_text(blocks).first().memory_text == "## A\n- x\n- y\n\n## B\n- none"


def test_listing(spark):
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "doc_id string")
    both = listing.union_of_ids(ids("a_001", "b"), ids("b", "c_010"))
    assert [(r.doc_id, r.in_0, r.in_1) for r in listing.ordered_candidates(both).collect()] == [("c_010", False, True), ("a_001", True, False), ("b", True, True)]
    assert listing.next_counter(ids("a_001", "a_007", "b_100"), "a_").first()[0] == 8
    assert listing.next_counter(ids("b_1"), "a_").first()[0] == 1


def test_model_output(spark):
    raw = [json.dumps({"rubrics": {"Grounding": 2, "style": 5}, "issues": ["x"]}), json.dumps({"rubrics": {"overall": 4, "style": 9}, "blocking": True}), json.dumps({"blocking": True}), json.dumps({"edits": [{"target": "t", "action": "replace"}, {"reason": " r ", "replacement": "z"}], "risk_level": "high"}), "no json", None, "{}"]
    got = [(r.approved, r.issues, r.risk_level) for r in model_output.decide(spark.createDataFrame([(x,) for x in raw], "raw_text string")).collect()]
    rejected = (False, [model_output.NO_ISSUES], "medium")
    assert got == [(False, ["Critic rubric 'grounding' is blocking with score 2/5."], "low"), (True, [], "medium"), (False, [model_output.NO_EDITS], "medium"), (False, ["replace 't': Critic requested a specific edit.", "revise 'section': r"], "high"), rejected, rejected, (True, [], "low")]
    legacy = ["Approved: YES\r\nRUBRICS:\n- tone: 2\nISSUES:\n- none\nREVISION: keep as is", "ISSUES:\n- a\n - b\nno\nREVISION:\n", "approved: yes\nRUBRICS:\n- grounding: 1\n- tone: 5/5", "RUBRICS:\n- a b-c: 4\n- tone: 3", "ISSUES: x\n{\"broken\": "]
    got = [(r.approved, r.issues, r.revision_instruction, r.rubrics) for r in model_output.decide(spark.createDataFrame([(x,) for x in legacy], "raw_text string")).collect()]
    assert got == [(True, [], "keep as is", {"tone": 2}), (False, ["a", "- b"], model_output.FLAGGED, {}), (False, ["Critic rubric 'grounding' is blocking with score 1/5."], "keep as is", {"grounding": 1, "tone": 5}), (True, [], "keep as is", {"a_b_c": 4, "tone": 3}), (False, [model_output.NO_ISSUES], model_output.CONSISTENT, {})]
    asked = model_output.decide(spark.createDataFrame([(raw[3],)], "raw_text string")).first().revision_instruction
    assert asked == "Apply these specific critic edits:\n1. Target: t; action: replace; reason: Critic requested a specific edit.\n2. Target: section; action: revise; reason: r\n   Replacement: z"
    frame = spark.createDataFrame([("- Legal tone: 4/5\n- grounding: 3\n- grounding: 5\n* style: 2\nx: 9",)], "t string")
    assert frame.select(model_output.rubrics_from_text(F.col("t"))).first()[0] == {"legal_tone": 4, "grounding": 5}
    packets = spark.createDataFrame([('{"content": "a", "summary": "b"}',), ("plain <think>x</think>text",)], "t string")
    assert [tuple(r[0]) for r in packets.select(model_output.parse_packet(F.col("t"))).collect()] == [("a", "b"), ("plain text", "")]


def test_generators(spark):
    statutes = spark.createDataFrame([("fraud", 0, "o", "s", "took {amount} from {victim}")], "fraud_type string, ord long, offence string, statute string, particulars string")
    cases = spark.createDataFrame([("d", "indictment", "fraud", {"amount": "£5"}), ("e", "judgment", "fraud", {})], "doc_id string, doc_type string, fraud_type string, context map<string,string>")
    assert [tuple(r) for r in generate.counts(statutes, cases).collect()] == [("d", 0, "o", "s", "took £5 from {victim}")]
    assert generate.section_groups(["history", "facts", "charges", "evidence", "assessment"]) == [["history", "charges"], ["facts"], ["evidence", "assessment"]]
    names = spark.createDataFrame([("Alexander", "Smith")], "f string, l string").select(generate.name_variants(F.col("f"), F.col("l"))).first()[0]
    assert names == ["Alex Smith", "Alexa Smith", "Ale Smith", "Alexander Smitth"]
    explicit = spark.createDataFrame([("a", 1)], "doc_id string, x int")
    assert sorted(map(tuple, generate.resolve(explicit, spark.createDataFrame([("a", 2), ("b", 3)], "doc_id string, x int")).collect())) == [("a", 1), ("b", 3)]
