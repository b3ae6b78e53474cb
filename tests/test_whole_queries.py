"""Queries over whole tables, against plain Python versions and their SQL."""

import json
import re
from collections import Counter

import pytest

from lexmill.plans import catalogue

DATA = "/root/testdata/sf0.001"


#: The four most usual rules of the text.
FOUR_RULES = r"""WITH t AS (SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS x FROM documents), m AS (
  SELECT doc_id, 'Section contains markdown/list formatting; output must be plain prose.' AS issue FROM t WHERE regexp_matches(x, '(?m)^\s*#{1,6}\s+') OR regexp_matches(x, '(?m)^\s*[-*]\s+') OR regexp_matches(x, '(?m)^\s*\d+\.\s+') OR regexp_matches(x, '(?m)^\s*[-*_]{3,}\s*$') OR regexp_matches(x, '\*\*')
  UNION ALL SELECT doc_id, 'Section contains unresolved placeholder markers (****).' FROM t WHERE regexp_matches(x, '\*{4,}')
  UNION ALL SELECT doc_id, 'Section appears truncated or ends mid-sentence.' FROM t WHERE length(x) > 120 AND regexp_matches(x, '(?i)(?:^|[^\p{L}\p{N}_])(?:and|or|to|of|with|through|including|by|for|from|in|on|at|between)\.?$')
  UNION ALL SELECT doc_id, 'Section is significantly shorter than the requested target.' FROM t WHERE len(regexp_extract_all(x, '\S+')) < 84)
SELECT issue, count(*) AS n FROM m GROUP BY issue ORDER BY n DESC, issue LIMIT 8"""


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def sql_rows(name):
    import duckdb

    db = duckdb.connect()
    for table in ("events", "customer", "orders", "supplier", "documents", "conversations", "labels", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return sorted(db.execute(catalogue.ORACLES.get(name, name)).fetchall(), key=repr)


def test_latest_observations_of_every_call_in_chunk_order(spark):
    found = {}
    for e in spark.read.parquet(f"{DATA}/events.parquet").collect():
        k = json.loads(e.props)["k"]
        stage = "writer" if e.user_id % 2 == 0 else "polisher"
        found.setdefault((e.event_id // 50, f"s{e.user_id % 7}"), {}).setdefault(stage, []).append((k % 3, k % 5, f"writer_s{e.user_id % 7}_r{k % 3}_chunk_{k % 5}", e.event_id))
    want = []
    for section, stages in found.items():
        stage = "polisher" if "polisher" in stages else "writer"
        latest = max(r[0] for r in stages[stage])
        rows = sorted(r[1:] for r in stages[stage] if r[0] == latest)
        want += [(*section, stage, task, call, i) for i, (_, task, call) in enumerate(rows, 1)]
    got = rows_of(catalogue.latest_observations(spark, DATA))
    assert got == sorted(want, key=repr) == sql_rows("latest_observations")
    assert any(r[4] % 5 for r in got) and len({r[0] for r in got}) == 20


def test_top_failures_of_all_rules(spark):
    said = Counter(dict(sql_rows(FOUR_RULES)))
    for _, sentences, fragments in sql_rows("repeated_content"):
        said["Section contains repeated long sentences/paragraphs."] += sentences
        said["Section contains repeated sentence fragments."] += fragments
    texts = [r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    said["Section still contains hidden reasoning markup."] += sum("<think>" in t.lower() for t in texts)
    said["Section is empty."] += sum(not t.strip() for t in texts)
    said["Section contains an incomplete date range ('between ... and ...')."] += sum(bool(re.search(r"(?i)\bbetween\s+and\b", t)) for t in texts)
    want = sorted(((i, n) for i, n in said.items() if n), key=lambda x: (-x[1], x[0]))[:8]
    got = [tuple(r) for r in catalogue.top_failures(spark, DATA).collect()]
    assert got == want
    assert {"Section contains repeated long sentences/paragraphs.", "Section contains repeated sentence fragments."} & {i for i, _ in got}


def plain_variants(name):
    if len(name) <= 4:
        return []
    found = [name[:k] for k in (4, 5, 3) if len(name) > k]
    if len(name) > 5 and re.search("(?:as|os|us)$", name):
        found.append(name[:-2])
    if len(name) > 6 and name.endswith("olas"):
        found.append(name[:-4])
    return list(dict.fromkeys(found))


def test_name_variants_has_every_prefix_and_ending(spark, tmp_path):
    rows = [(r.c_custkey, "|".join(plain_variants(r.c_mktsegment))) for r in spark.read.parquet(f"{DATA}/customer.parquet").collect()]
    assert rows_of(catalogue.name_variants(spark, DATA)) == sorted(rows, key=repr) == sql_rows("name_variants")
    assert any(len(nick.split("|")) == 3 for _, nick in rows)
    odd = ["Nikolas", "Nicholas", "Markos", "Petrus", "Titus", "Anna", "", "Lucas", "olas", "Tholas"]
    spark.createDataFrame(list(enumerate(odd)), "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    want = sorted(((i, "|".join(plain_variants(x))) for i, x in enumerate(odd)), key=repr)
    import duckdb

    db = duckdb.connect()
    db.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert rows_of(catalogue.name_variants(spark, tmp_path)) == want == sorted(db.execute(catalogue.ORACLES["name_variants"]).fetchall(), key=repr)


@pytest.mark.parametrize("name", ["groundtruth_union", "allowed_facts", "candidate_listing"])
def test_query_equals_its_sql(spark, name):
    assert name in catalogue.ORACLES
    assert rows_of(catalogue.QUERIES[name](spark, DATA)) == sql_rows(name)


def test_listing_and_amounts_leave_out_no_case(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet").collect()
    cases = {f"en_case_{r.o_orderkey // 20:05d}" for r in orders}
    listed = catalogue.candidate_listing(spark, DATA).collect()
    assert {r.doc_id for r in listed} == {r.doc_id for r in listed if r.in_1} == cases
    amounts = {(f"en_case_{r.o_orderkey // 20:05d}", f"£{int(r.o_totalprice // 1):,}") for r in orders} | {(c, "EUR 10,000") for c in cases}
    got = [(r.doc_id, r.entity_text) for r in catalogue.groundtruth_union(spark, DATA).where("label = 'AMOUNT'").collect()]
    assert sorted(got) == sorted(amounts)


NEW = "text_rule_issues fact_rule_issues value_rule_issues required_fact_issues review_decisions soft_greedy_prf memory_validation memory_heads country_vat_numbers generated_identifiers case_size_counts count_review_rows people_by_group normalised_schemas shortened_errors groundtruth_round_trip metrics_round_trip history_round_trip report_scan"


@pytest.mark.parametrize("name", NEW.split())
def test_query_equals_its_sql(spark, name):
    import duckdb

    frame = catalogue.QUERIES[name](spark, DATA)
    db = duckdb.connect()
    for table in ("events", "customer", "orders", "supplier", "documents", "conversations", "labels"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    sql = db.sql(catalogue.ORACLES[name])
    same = lambda v: round(v, 9) if isinstance(v, float) else v
    columns = sorted(frame.columns)
    assert columns == sorted(sql.columns)
    want = sorted((tuple(same(dict(zip(sql.columns, r))[c]) for c in columns) for r in sql.fetchall()), key=repr)
    assert sorted((tuple(same(r[c]) for c in columns) for r in frame.collect()), key=repr) == want
    assert want


def test_every_rule_of_the_text_is_met(spark):
    from lexmill.functions import rules

    said = {r.issue.split(" '")[0] for r in catalogue.text_rule_issues(spark, "/root/testdata/sf0.01").select("issue").distinct().collect()}
    said |= {r.issue.split(" '")[0] for q in (catalogue.fact_rule_issues, catalogue.value_rule_issues, catalogue.required_fact_issues) for r in q(spark, DATA).select("issue").distinct().collect()}
    assert len(said) >= 24 and len(rules.RULES) == 26
