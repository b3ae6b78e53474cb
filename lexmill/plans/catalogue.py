"""Registered queries over the test tables, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names, rules
from ..functions import text as T
from ..operators import evaluation, generate, graph, groundtruth, listing, memory, model_output, overview, quality, telemetry
from ..sources import readers, writers
from ..streaming import rollups
from . import derived
from .derived import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# -- evaluation --------------------------------------------------------------------------------------------------------

_STRICT = f"""WITH {derived.PREDICTIONS},
keys AS (
  SELECT doc_id, k, label, max(e) AS e, max(p) AS p FROM (
    SELECT doc_id, k, label, 1 AS e, 0 AS p FROM gtk UNION ALL SELECT doc_id, k, label, 0, 1 FROM predk) GROUP BY ALL)"""
_COUNTS = "count(*) FILTER (WHERE e = 1 AND p = 1) AS tp, count(*) FILTER (WHERE e = 0) AS fp, count(*) FILTER (WHERE p = 0) AS fn"
_RATES = """SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall FROM c)"""


@query(f"{_STRICT} SELECT doc_id, {_COUNTS} FROM keys GROUP BY doc_id")
def strict_confusion(spark, sf_dir):
    return evaluation.confusion(derived.groundtruth(spark, sf_dir), derived.predictions(spark, sf_dir))


@query(f"{_STRICT}, c AS (SELECT doc_id, {_COUNTS} FROM keys GROUP BY doc_id) {_RATES}")
def strict_prf(spark, sf_dir):
    return evaluation.with_rates(strict_confusion(spark, sf_dir))


@query(f"{_STRICT}, c AS (SELECT label, {_COUNTS} FROM keys GROUP BY label) {_RATES}")
def strict_by_label(spark, sf_dir):
    return evaluation.with_rates(evaluation.confusion(derived.groundtruth(spark, sf_dir), derived.predictions(spark, sf_dir), ["label"]))


@query(f"WITH {derived.PREDICTIONS} SELECT doc_id, label, k, count(*) AS n FROM gtk WHERE EXISTS (SELECT 1 FROM predk p WHERE p.doc_id = gtk.doc_id AND p.k = gtk.k AND p.label = gtk.label) GROUP BY ALL")
def strict_matches(spark, sf_dir):
    return evaluation.strict_matches(derived.groundtruth(spark, sf_dir), derived.predictions(spark, sf_dir)).groupBy("doc_id", "label", "k").agg(F.count("*").alias("n"))


@query(f"WITH {derived.PREDICTIONS} SELECT doc_id, k, label FROM predk EXCEPT SELECT doc_id, k, label FROM gtk")
def false_positives(spark, sf_dir):
    return evaluation.strict_misses(derived.predictions(spark, sf_dir), derived.groundtruth(spark, sf_dir))


@query(f"WITH {derived.PREDICTIONS} SELECT doc_id, k, label FROM gtk EXCEPT SELECT doc_id, k, label FROM predk")
def false_negatives(spark, sf_dir):
    return evaluation.strict_misses(derived.groundtruth(spark, sf_dir), derived.predictions(spark, sf_dir))


@query(f"WITH {derived.PREDICTIONS} SELECT doc_id, label, k, arg_min(text, ord) AS text, min(ord) AS ord FROM predk GROUP BY doc_id, label, k")
def prediction_first_wins(spark, sf_dir):
    return evaluation.first_of_each(evaluation.keyed(derived.predictions(spark, sf_dir)), ["doc_id", "k", "label"]).select("doc_id", "label", "k", "text", "ord")


_TOKENS = r"regexp_extract_all({}, '[\p{{L}}\p{{N}}_£€$./-]+')"
_SOFT = f"""WITH {derived.PREDICTIONS},
pairs AS (
  SELECT e.doc_id, e.label, e.ord AS e_ord, p.ord AS p_ord, e.text AS e_text, p.text AS p_text, {_TOKENS.format("e.k")} AS et, {_TOKENS.format("p.k")} AS pt
  FROM gtk e JOIN predk p ON e.doc_id = p.doc_id AND e.label = p.label),
scored AS (SELECT * EXCLUDE (et, pt), len(list_filter(et, lambda t: list_contains(pt, t))) / len(et) AS coverage FROM pairs),
candidates AS (
  SELECT * FROM scored
  WHERE coverage >= CASE label WHEN 'ADDRESS' THEN 0.7 WHEN 'AMOUNT' THEN 1.0 WHEN 'CASE_REFERENCE' THEN 0.9 WHEN 'DATE' THEN 0.9 WHEN 'VAT' THEN 1.0 ELSE 0.8 END)"""


@query(f"{_SOFT} SELECT * FROM candidates")
def soft_candidates(spark, sf_dir):
    return evaluation.soft_candidates(derived.groundtruth(spark, sf_dir), derived.predictions(spark, sf_dir))


@query(f"""WITH RECURSIVE {_SOFT.removeprefix("WITH ")},
es AS (SELECT doc_id, label, ord, text, row_number() OVER (PARTITION BY doc_id, label ORDER BY ord, text) AS i FROM gtk),
ps AS (SELECT doc_id, label, ord, text, row_number() OVER (PARTITION BY doc_id, label ORDER BY ord, text) AS i FROM predk),
o AS (SELECT es.doc_id, es.label, es.i, list(ps.i ORDER BY coverage DESC, ps.i) FILTER (WHERE ps.i IS NOT NULL) AS open FROM es
  LEFT JOIN candidates c ON c.doc_id = es.doc_id AND c.label = es.label AND c.e_ord = es.ord AND c.e_text = es.text
  LEFT JOIN ps ON ps.doc_id = c.doc_id AND ps.label = c.label AND ps.ord = c.p_ord AND ps.text = c.p_text GROUP BY ALL),
walk AS (
  SELECT doc_id, label, 0::BIGINT AS i, []::BIGINT[] AS used FROM o WHERE i = 1
  UNION ALL
  SELECT w.doc_id, w.label, o.i, list_concat(w.used, list_filter(o.open, lambda x: NOT list_contains(w.used, x))[1:1]) FROM walk w JOIN o ON o.doc_id = w.doc_id AND o.label = w.label AND o.i = w.i + 1),
tps AS (SELECT doc_id, label, len(arg_max(used, i)) AS tp FROM walk GROUP BY doc_id, label),
c AS (SELECT doc_id, label, coalesce(tp, 0) AS tp, coalesce(p, 0) - coalesce(tp, 0) AS fp, coalesce(e, 0) - coalesce(tp, 0) AS fn
  FROM (SELECT doc_id, label, count(*) AS e FROM gtk GROUP BY ALL) FULL JOIN (SELECT doc_id, label, count(*) AS p FROM predk GROUP BY ALL) USING (doc_id, label) LEFT JOIN tps USING (doc_id, label))
{_RATES}""")
def soft_greedy_prf(spark, sf_dir):
    return evaluation.with_rates(evaluation.soft_confusion(derived.groundtruth(spark, sf_dir), derived.predictions(spark, sf_dir)))


@query(f"""{_STRICT}, c AS (SELECT doc_id, {_COUNTS} FROM keys GROUP BY doc_id)
SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS mle,
  CASE WHEN tp > 0 AND fp > 0 THEN tp / (tp + fp) WHEN tp = 0 AND fp > 0 THEN 0.0 WHEN fp = 0 AND tp > 0 THEN 1.0 ELSE 0.5 END AS map, (1 + tp) / (2 + tp + fp) AS mean FROM c""")
def rate_posterior_closed_form(spark, sf_dir):
    return evaluation.rate_posterior(strict_confusion(spark, sf_dir))


@query()
def posterior_intervals(spark, sf_dir):
    return evaluation.posterior_intervals(evaluation.confusion(derived.groundtruth(spark, sf_dir), derived.predictions(spark, sf_dir), ["label"]))


@query(f"WITH {derived.PREDICTIONS} SELECT doc_id, ord, text, label, k FROM predk WHERE EXISTS (SELECT 1 FROM gtk WHERE gtk.doc_id = predk.doc_id AND gtk.k = predk.k AND should_propose = 'no')")
def negative_control_hits(spark, sf_dir):
    return evaluation.negative_control_hits(derived.groundtruth(spark, sf_dir), derived.predictions(spark, sf_dir)).select("doc_id", "ord", "text", "label", "k")


_NORMAL = r"lower(trim(regexp_replace({}, '\s+', ' ', 'g')))"
_HERE = f"contains({_NORMAL.format('d.text')}, gtk.k)"


@query(f"WITH {derived.DOCUMENTS} SELECT gtk.doc_id, ord, label, gtk.text, {_HERE} AS present FROM gtk JOIN docs d USING (doc_id)")
def surface_presence(spark, sf_dir):
    gt = derived.groundtruth(spark, sf_dir).join(derived.documents(spark, sf_dir).withColumnRenamed("text", "d"), "doc_id")
    return gt.select("doc_id", "ord", "label", "text", evaluation.surface_in_text(F.col("text"), F.col("d")).alias("present"))


@query(f"WITH {derived.DOCUMENTS} SELECT gtk.doc_id, ord, label, gtk.text AS entity_text FROM gtk JOIN docs d USING (doc_id) WHERE {_HERE}")
def rendered_filter(spark, sf_dir):
    rows = derived.groundtruth(spark, sf_dir).select("doc_id", "ord", "label", F.col("text").alias("entity_text"))
    return groundtruth.rendered_only(rows, derived.documents(spark, sf_dir))


@query(rf"""WITH {derived.DOCUMENTS}, r AS (
  SELECT gtk.doc_id, should_propose = 'yes' AS pos, coalesce({_HERE}, false) AS here, regexp_extract(coalesce(d.text, ''), '(?i)' || replace(regexp_escape(gtk.text), '\ ', '\s+')) = gtk.text AS same FROM gtk LEFT JOIN docs d USING (doc_id))
SELECT doc_id, count(*) AS raw_rows, count(*) FILTER (WHERE pos) AS raw_positive_rows, count(*) FILTER (WHERE NOT pos) AS negative_control_rows,
  count(*) FILTER (WHERE pos AND NOT here) AS absent_positive_rows, count(*) FILTER (WHERE pos AND here AND NOT same) AS surface_normalizations FROM r GROUP BY doc_id""")
def calibration_counters(spark, sf_dir):
    return evaluation.calibration_counters(derived.groundtruth(spark, sf_dir), derived.documents(spark, sf_dir))


@query(f"WITH {derived.DOCUMENTS} SELECT gtk.doc_id, ord, label, gtk.k AS k FROM gtk JOIN docs d USING (doc_id) WHERE should_propose = 'yes' AND {_HERE}")
def calibrated_groundtruth(spark, sf_dir):
    out = evaluation.calibrate(derived.groundtruth(spark, sf_dir), derived.documents(spark, sf_dir))
    return out.select("doc_id", "ord", "label", T.normalize_surface(F.col("text")).alias("k"))


# -- ground truth and facts --------------------------------------------------------------------------------------------

_CASE = r"""
persons AS (SELECT printf('en_case_%05d', c_custkey // 20) AS doc_id, c_custkey % 20 AS ord, replace(c_name, '#', ' Nr ') AS name, 'Dr ' || c_mktsegment AS title_surname, strftime(DATE '1950-01-01' + (c_custkey % 9000)::INTEGER, '%-d %B %Y') AS dob,
    c_custkey || ' High Street, ' || c_mktsegment AS address, c_custkey % 2 = 0 AS is_defendant FROM customer),
orgs AS (SELECT printf('en_case_%05d', s_suppkey // 20) AS doc_id, s_suppkey % 20 AS ord, CASE WHEN s_suppkey % 3 = 0 THEN 'charged' ELSE 'associated' END AS grp, upper(replace(s_name, '#', ' ')) || ' LTD' AS name, s_suppkey || ' Market Square, Leeds' AS address, 'GB' || lpad((s_suppkey * 7919 % 1000000000)::VARCHAR, 9, '0') AS vat FROM supplier),
meta AS (SELECT printf('en_case_%05d', o_orderkey // 20) AS doc_id, 'CPS/2024/' || lpad((o_orderkey % 10000)::VARCHAR, 4, '0') AS case_number, 'C/2024/' || (o_orderkey % 977) AS cross_ref, strftime(o_orderdate, '%-d %B %Y') AS filing_date,
    CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%-d %B %Y') END AS offence_start FROM orders WHERE o_orderkey % 20 = 0)"""


def _case_tables(spark, sf_dir):
    """Persons, organisations, metadata, counts and amounts of cases."""
    doc = lambda key: F.format_string("en_case_%05d", F.floor(F.col(key) / 20))
    c, s, o = (table(spark, sf_dir, n) for n in ("customer", "supplier", "orders"))
    day = lambda d: F.date_format(d, "d MMMM yyyy")
    persons = c.select(doc("c_custkey").alias("doc_id"), (F.col("c_custkey") % 20).alias("ord"), F.replace(F.col("c_name"), F.lit("#"), F.lit(" Nr ")).alias("name"), F.lit(None).cast("string").alias("initials"), F.concat(F.lit("Dr "), "c_mktsegment").alias("title_surname"), day(F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 9000).cast("int"))).alias("dob"), F.concat(F.col("c_custkey").cast("string"), F.lit(" High Street, "), "c_mktsegment").alias("address"), (F.col("c_custkey") % 2 == 0).alias("is_defendant"))
    orgs = s.select(doc("s_suppkey").alias("doc_id"), (F.col("s_suppkey") % 20).alias("ord"), F.when(F.col("s_suppkey") % 3 == 0, "charged").otherwise("associated").alias("grp"), F.concat(F.upper(F.replace(F.col("s_name"), F.lit("#"), F.lit(" "))), F.lit(" LTD")).alias("name"), F.concat(F.col("s_suppkey").cast("string"), F.lit(" Market Square, Leeds")).alias("address"), generate.vat_number(F.lit("GB"), F.col("s_suppkey") * 7919).alias("vat"))
    key = F.col("o_orderkey")
    meta = o.where(key % 20 == 0).select(doc("o_orderkey").alias("doc_id"), F.concat(F.lit("CPS/2024/"), F.lpad((key % 10000).cast("string"), 4, "0")).alias("case_number"), F.concat(F.lit("C/2024/"), (key % 977).cast("string")).alias("cross_ref"), day(F.col("o_orderdate")).alias("filing_date"), F.when(key % 3 == 0, day(F.col("o_orderdate"))).alias("offence_start"), F.lit(None).cast("string").alias("offence_end"))
    counts = o.select(doc("o_orderkey").alias("doc_id"), (key % 20).alias("ord"), F.concat(F.lit("took £"), F.format_number(F.floor("o_totalprice"), 0), F.lit(" and EUR 10,000 at "), "o_orderpriority").alias("particulars"))
    amounts = o.select(doc("o_orderkey").alias("doc_id"), (key % 20).alias("ord"), F.lit("EUR 10,000").alias("value"))
    return persons, orgs, meta, counts, amounts


@query(f"""WITH {_CASE},
cnt AS (SELECT printf('en_case_%05d', o_orderkey // 20) AS doc_id, o_orderkey % 20 AS ord, '£' || format('{{:,}}', floor(o_totalprice)::BIGINT) AS v0, 'EUR 10,000' AS v1 FROM orders),
amt AS (
  SELECT doc_id, ord * 1000 AS o, v0 AS v, 'count amount' AS notes FROM cnt UNION ALL SELECT doc_id, ord * 1000 + 1, v1, 'count amount' FROM cnt
  UNION ALL SELECT printf('en_case_%05d', o_orderkey // 20), o_orderkey % 20 + 1000000, 'EUR 10,000', 'amount' FROM orders),
places AS (SELECT doc_id, address FROM persons WHERE is_defendant UNION ALL SELECT doc_id, address FROM orgs),
rows_ AS (
  SELECT doc_id, name AS entity_text, 'PERSON' AS label, CASE WHEN is_defendant THEN 'defendant' ELSE 'collateral' END AS notes FROM persons
  UNION ALL SELECT doc_id, name, 'ORG', grp FROM orgs
  UNION ALL SELECT doc_id, case_number, 'CASE_REFERENCE', 'case number' FROM meta UNION ALL SELECT doc_id, cross_ref, 'CASE_REFERENCE', 'cross reference' FROM meta
  UNION ALL SELECT doc_id, filing_date, 'DATE', 'filing date' FROM meta UNION ALL SELECT doc_id, offence_start, 'DATE', 'offence period start' FROM meta WHERE offence_start IS NOT NULL
  UNION ALL SELECT doc_id, dob, 'DATE', 'date of birth' FROM persons
  UNION ALL SELECT doc_id, v, 'AMOUNT', arg_min(notes, o) FROM amt GROUP BY doc_id, v
  UNION ALL SELECT doc_id, array_to_string(list_transform(string_split(name, ' '), lambda w: upper(left(w, 1))), '.') || '.', 'INITIAL', 'initials' FROM persons
  UNION ALL SELECT doc_id, title_surname, 'TITLE', 'title and surname' FROM persons
  UNION ALL SELECT doc_id, address, 'ADDRESS', 'full address' FROM places UNION ALL SELECT doc_id, split_part(address, ', ', 1), 'ADDRESS', 'street' FROM places UNION ALL SELECT doc_id, split_part(address, ', ', 2), 'ADDRESS', 'city and postcode' FROM places
  UNION ALL SELECT doc_id, vat, 'VAT', 'vat' FROM orgs)
SELECT *, 'yes' AS should_propose FROM rows_""")
def groundtruth_union(spark, sf_dir):
    return groundtruth.build(*_case_tables(spark, sf_dir)).select("doc_id", "entity_text", "label", "notes", "should_propose")


@query(f"""WITH {_CASE}, f AS (
  SELECT doc_id, 'person_form' AS kind, name AS value FROM persons UNION SELECT doc_id, 'titled', title_surname FROM persons
  UNION SELECT doc_id, 'initials', rtrim(array_to_string(list_transform(string_split(name, ' '), lambda w: upper(left(w, 1))), '.'), '.') FROM persons
  UNION SELECT doc_id, 'date', dob FROM persons UNION SELECT doc_id, 'org', name FROM orgs UNION SELECT doc_id, 'vat', vat FROM orgs
  UNION SELECT doc_id, 'case_ref', case_number FROM meta UNION SELECT doc_id, 'case_ref', cross_ref FROM meta UNION SELECT doc_id, 'date', filing_date FROM meta UNION SELECT doc_id, 'date', offence_start FROM meta WHERE offence_start IS NOT NULL
  UNION SELECT printf('en_case_%05d', o_orderkey // 20), 'amount', 'EUR 10,000' FROM orders)
SELECT kind, count(*) AS n, count(DISTINCT value) AS distinct_values FROM f GROUP BY kind""")
def allowed_facts(spark, sf_dir):
    persons, orgs, meta, _, amounts = _case_tables(spark, sf_dir)
    return groundtruth.allowed_facts(persons, orgs, meta, amounts).groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("value").alias("distinct_values"))


@query(f"""WITH {derived.DOCUMENTS},
found AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '\\b\\d{{1,2}} (?:January|February|March|April|May|June|July|August|September|October|November|December) \\d{{4}}\\b')) AS value FROM docs)
SELECT doc_id, value FROM found EXCEPT SELECT doc_id, text FROM surf WHERE label = 'DATE' AND okey % 3 = 0""")
def unknown_dates(spark, sf_dir):
    facts = derived.surfaces(spark, sf_dir).where("label = 'DATE' and okey % 3 = 0").select("doc_id", F.lit("date").alias("kind"), F.col("text").alias("value"))
    return groundtruth.unknown_values(derived.documents(spark, sf_dir), facts, "date", T.DATE)


@query(f"WITH {derived.GROUNDTRUTH} SELECT doc_id, label, should_propose, count(*) AS n FROM gt GROUP BY ALL")
def label_counts(spark, sf_dir):
    return derived.groundtruth(spark, sf_dir).groupBy("doc_id", "label", "should_propose").agg(F.count("*").alias("n"))


# -- graphs and memory -------------------------------------------------------------------------------------------------

_WHEEL = "SELECT l.doc_id, l.name AS src, r.name AS dst, '{0}' AS type, {1} AS label FROM {2} l JOIN (SELECT doc_id, count(*) AS n FROM {3} GROUP BY doc_id) m USING (doc_id) JOIN {3} r ON r.doc_id = l.doc_id AND r.ord = l.ord % m.n"


@query(f"""WITH {derived.PARTIES}
{_WHEEL.format("controlled", "l.name || ' controlled ' || r.name", "defendants", "charged")}
UNION ALL SELECT d.doc_id, d.name, c.name, 'instructed', d.name || ' instructed ' || c.name FROM defendants d JOIN collateral c ON d.doc_id = c.doc_id AND d.ord = 0
UNION ALL SELECT a.doc_id, a.name, b.name, 'conspired_with', a.name || ' conspired with ' || b.name FROM defendants a JOIN defendants b ON a.doc_id = b.doc_id AND b.ord = a.ord + 1
UNION ALL {_WHEEL.format("received_funds_from", "r.name || ' received funds from ' || l.name", "charged", "associated")}""")
def graph_edges(spark, sf_dir):
    return graph.edges(**derived.parties(spark, sf_dir))


@query(f"WITH {derived.PARTIES} SELECT l.doc_id, l.name AS from_org, r.name AS to_org, (l.ord + 1) * 25000 AS amount FROM charged l JOIN (SELECT doc_id, count(*) AS n FROM associated GROUP BY doc_id) m USING (doc_id) JOIN associated r ON r.doc_id = l.doc_id AND r.ord = l.ord % m.n")
def graph_transfers(spark, sf_dir):
    p = derived.parties(spark, sf_dir)
    return graph.transfers(p["charged"], p["associated"])


@query(f"""WITH {derived.PARTIES}
SELECT doc_id, 'p' || row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS id, name, 'person' AS type FROM defendants
UNION ALL SELECT doc_id, 'o' || row_number() OVER (PARTITION BY doc_id ORDER BY ord), name, 'organisation' FROM charged""")
def graph_nodes(spark, sf_dir):
    p = derived.parties(spark, sf_dir)
    return graph.nodes(p["defendants"], p["charged"])


@query(f"""WITH {derived.SURFACES},
b AS (SELECT doc_id, label, string_agg('- ' || text, chr(10) ORDER BY ord) AS body FROM surf WHERE label IN ('PERSON', 'ORG') GROUP BY doc_id, label)
SELECT doc_id, string_agg('## ' || label || chr(10) || body, chr(10) || chr(10) ORDER BY CASE label WHEN 'PERSON' THEN 0 ELSE 1 END) || chr(10) || chr(10) || '## Strict Rules' || chr(10) || '- none' AS memory_text FROM b GROUP BY doc_id""")
def memory_text(spark, sf_dir):
    s = derived.surfaces(spark, sf_dir).where("label in ('PERSON', 'ORG')")
    blocks = s.select("doc_id", F.when(F.col("label") == "PERSON", 0).otherwise(1).alias("block_ord"), F.col("label").alias("heading"), "ord", F.col("text").alias("line"))
    empty = s.select("doc_id").distinct().select("doc_id", F.lit(2).alias("block_ord"), F.lit("Strict Rules").alias("heading"), F.lit(0).cast("bigint").alias("ord"), F.lit(None).cast("string").alias("line"))
    return graph.memory_text(blocks.unionByName(empty))


@query("SELECT conv_id::VARCHAR AS doc_id, string_agg(CASE role WHEN 'user' THEN 'Question' ELSE role END || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def rendered_documents(spark, sf_dir):
    return graph.render_document(derived.sections(spark, sf_dir).withColumnRenamed("revision", "ord"), {"user": "Question"})


# -- text and rules ----------------------------------------------------------------------------------------------------

_WORDS = r"len(regexp_extract_all({}, '\S+'))"


@query(f"SELECT doc_id, {_WORDS.format('text')} AS n_words, floor({_WORDS.format('text')} * 10 / 400.0) / 10 AS pages, {_WORDS.format('text')} < greatest(60, floor(100 * 0.7)) AS short FROM documents")
def doc_word_stats(spark, sf_dir):
    n = T.words(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", n.cast("bigint").alias("n_words"), (F.floor(n * 10 / 400.0) / 10).alias("pages"), (n < rules.minimum_words(F.lit(100))).alias("short"))


@query(r"""WITH t AS (SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS x FROM documents)
SELECT doc_id,
  regexp_matches(x, '(?m)^\s*#{1,6}\s+') OR regexp_matches(x, '(?m)^\s*[-*]\s+') OR regexp_matches(x, '(?m)^\s*\d+\.\s+') OR regexp_matches(x, '(?m)^\s*[-*_]{3,}\s*$') OR regexp_matches(x, '\*\*') AS markdown,
  regexp_matches(x, '\*{4,}') AS stars, contains(lower(x), '<think>') AS thinking,
  length(x) > 120 AND regexp_matches(x, '(?i)(?:^|[^\p{L}\p{N}_])(?:and|or|to|of|with|through|including|by|for|from|in|on|at|between)\.?$') AS truncated
FROM t""")
def rule_flags(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = {"markdown": "markdown_formatting", "stars": "placeholder_markers", "thinking": "hidden_reasoning_markup", "truncated": "truncated_sentence"}
    trimmed = F.btrim("text", F.lit(" \t\n\r"))
    column = lambda name: F.col("_t")
    return docs.withColumn("_t", trimmed).select("doc_id", *[(F.size(rules.RULES[r](column)) > 0).alias(n) for n, r in names.items()])


_SENTENCES = r"string_split(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"


@query(f"""WITH s AS (SELECT doc_id, list_filter(list_transform({_SENTENCES}, lambda x: lower(trim(x))), lambda x: length(x) >= 80) AS long, {_SENTENCES} AS all_ FROM documents),
f AS (SELECT doc_id, long, list_transform(list_filter(list_transform(all_, lambda x: regexp_extract_all(lower(x), '[A-Za-zÀ-ÖØ-öø-ÿ0-9'']+')), lambda t: len(t) >= 8), lambda t: array_to_string(t[1:10], ' ')) AS heads FROM s)
SELECT doc_id, len(long) <> len(list_distinct(long)) AS sentences, len(heads) <> len(list_distinct(heads)) AS fragments FROM f""")
def repeated_content(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.has_repeated_sentences(F.col("text")).alias("sentences"), T.has_repeated_fragments(F.col("text")).alias("fragments"))


@query(r"""WITH l AS (SELECT conv_id, turn, unnest(string_split(trim(replace(text, chr(13), ''), ' ' || chr(9) || chr(10)), chr(10))) AS line, generate_subscripts(string_split(trim(replace(text, chr(13), ''), ' ' || chr(9) || chr(10)), chr(10)), 1) AS i FROM conversations),
j AS (SELECT conv_id, turn, string_agg(CASE WHEN trim(line) = '' THEN '' ELSE line END, chr(10) ORDER BY i) AS t FROM l
  WHERE NOT starts_with(trim(line), '```') AND NOT regexp_matches(lower(trim(line)), '^[* ]*(approved|rubrics|issues|revision|strict compliance notes|required facts & entities|required facts and entities|entities mentioned|logical order|fix|note):')
    AND NOT regexp_matches(lower(trim(line)), '^[* ]*(history|persons|companies|charges|facts|evidence|assessment)[* ]*:?$') GROUP BY conv_id, turn)
SELECT conv_id, turn, md5(trim(regexp_replace(regexp_replace(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]+', ' ', 'g'), '[ ]+([,.;:])', '\1', 'g'), ' ' || chr(10) || chr(9))) AS cleaned FROM j""")
def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(T.clean_generated(F.col("text")).cast("binary")).alias("cleaned"))


@query(r"""WITH t AS (SELECT conv_id, turn, regexp_extract_all(replace(lower(trim(regexp_replace(text, '\s+', ' ', 'g'))), 'ß', 'ss'), '[\p{L}\p{N}\p{M}_£€$./-]+') AS w FROM conversations)
SELECT a.conv_id, a.turn, CASE WHEN len(a.w) = 0 THEN 0 ELSE len(list_filter(a.w, lambda x: list_contains(b.w, x))) / len(a.w) END AS coverage FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn - 1""")
def token_coverage(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", T.tokens(F.col("text")).alias("w"))
    before = t.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("w").alias("b"))
    return t.join(before, ["conv_id", "turn"]).select("conv_id", "turn", T.token_coverage(F.col("w"), F.col("b")).alias("coverage"))


def _issues(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.lit("facts").alias("section"), F.lit(120).alias("word_target"))
    return rules.issues(docs)


@query()
def top_failures(spark, sf_dir):
    """The most frequent issues of all rules; SQL has those of text_rule_issues one by one."""
    return quality.top_failures(_issues(spark, sf_dir))


def _q(text: str) -> str:
    """A SQL string."""
    return "'" + text.replace("'", "''") + "'"


#: What makes one rule of the text fail, by document: every rule is met, and the rest of the text stays.
_PHRASES = ("", " <think> so", " **** here", "\nAPPROVED:yes it is", " this facts section is drawn strictly from case_memory", "\n# Heading", "\n- item", " it happened between and nothing", " paid between March, then",
            " it commenced on and continued until", " VAT: GB12 was given", " VAT Registration No.: GB123456789 too", " we went there and", "\n1. one", "\n---\nend", " between March and May.")
_PHRASED = f"""x AS (SELECT doc_id, trim(coalesce(text, '') || list_extract([{", ".join(map(_q, _PHRASES))}], (doc_id % {len(_PHRASES)})::INTEGER + 1), ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) AS t FROM documents)"""
_VAT_SQL = "(regexp_full_match({0}, '[A-Z]{{2}}[A-Z0-9]{{8,14}}') AND regexp_matches(substr({0}, 3), '[0-9]'))"


@query(rf"""WITH {_PHRASED.replace("x AS", "y AS")}, x AS (SELECT doc_id, t, t AS text FROM y WHERE t <> ''),
s AS (SELECT doc_id, {_SENTENCES} AS all_ FROM x),
r AS (SELECT doc_id, list_filter(list_transform(all_, lambda v: lower(trim(v))), lambda v: length(v) >= 80) AS long,
  list_transform(list_filter(list_transform(all_, lambda v: regexp_extract_all(lower(v), '[A-Za-zÀ-ÖØ-öø-ÿ0-9'']+')), lambda v: len(v) >= 8), lambda v: array_to_string(v[1:10], ' ')) AS heads FROM s),
f AS (
  SELECT doc_id, 'Section is empty.' AS issue FROM y WHERE t = ''
  UNION ALL SELECT doc_id, 'Section still contains hidden reasoning markup.' FROM x WHERE contains(lower(t), '<think>')
  UNION ALL SELECT doc_id, 'Section contains unresolved placeholder markers (****).' FROM x WHERE regexp_matches(t, '\*{{4,}}')
  UNION ALL SELECT doc_id, 'Section contains review/instruction metadata instead of prose.' FROM x WHERE regexp_matches(t, {_q(rules.META_TOKEN)})
  UNION ALL SELECT doc_id, 'Section contains template/meta summary wording instead of legal prose.' FROM x WHERE regexp_matches(t, {_q(rules.META_OPENING)})
  UNION ALL SELECT doc_id, 'Section contains markdown/list formatting; output must be plain prose.' FROM x WHERE {" OR ".join(f"regexp_matches(t, {_q(m)})" for m in rules.MARKDOWN)}
  UNION ALL SELECT doc_id, 'Section contains an incomplete date range (''between ... and ...'').' FROM x WHERE regexp_matches(t, '(?i)\bbetween\s+and\b')
  UNION ALL SELECT doc_id, 'Section contains a dangling ''between'' phrase.' FROM x WHERE len(list_filter(regexp_extract_all(t, {_q(rules.DANGLING_BETWEEN)}), lambda m: NOT (regexp_matches(m, '(?i)\bbetween\b.+\band\b') OR contains(lower(m), 'during the charged period')))) > 0
  UNION ALL SELECT doc_id, 'Section contains unresolved timeline placeholders.' FROM x WHERE regexp_matches(t, {_q(rules.BROKEN_TIMELINE)})
  UNION ALL SELECT doc_id, 'Section contains a truncated VAT/reference identifier.' FROM x WHERE len(list_filter(regexp_extract_all(t, {_q(rules.VAT_LABEL)}, 1), lambda v: NOT {_VAT_SQL.format("upper(v)")})) > 0
  UNION ALL SELECT doc_id, 'Section contains repeated long sentences/paragraphs.' FROM r WHERE len(long) <> len(list_distinct(long))
  UNION ALL SELECT doc_id, 'Section contains repeated sentence fragments.' FROM r WHERE len(heads) <> len(list_distinct(heads))
  UNION ALL SELECT doc_id, 'Section appears truncated or ends mid-sentence.' FROM x WHERE length(t) > 120 AND regexp_matches(t, {_q(rules.TRUNCATED_END)})
  UNION ALL SELECT doc_id, 'Section is significantly shorter than the requested target.' FROM x WHERE len(regexp_extract_all(t, '\S+')) < 84
  UNION ALL SELECT doc_id, 'Section mentions unknown VAT/reference number ''' || v || '''.' FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(t, '\b[A-Z]{{2}}[A-Z0-9]{{8,14}}\b')) AS v FROM x) WHERE regexp_matches(substr(v, 3), '[0-9]'))
SELECT doc_id, issue FROM f""")
def text_rule_issues(spark, sf_dir):
    """A row for each rule of the text that a document fails, each document with a phrase that one of them forbids."""
    docs = table(spark, sf_dir, "documents")
    phrase = F.get(F.array(*map(F.lit, _PHRASES)), (F.col("doc_id") % len(_PHRASES)).cast("int"))
    docs = docs.select("doc_id", F.concat(F.coalesce("text", F.lit("")), phrase).alias("text"), F.lit("summary").alias("section"), F.lit(120).alias("word_target"))
    return rules.issues(docs).select("doc_id", F.explode("issues").alias("issue"))


_KNOWN = "okey % 3 = 0"


def _facts_of(surfaces):
    """Facts of each case: what every third order has is known."""
    known = F.expr(_KNOWN)
    texts = lambda label, only=True: F.transform(F.array_sort(F.collect_list(F.when((F.col("label") == label) & (known if only else F.lit(True)), F.struct("ord", "text")))), lambda v: v["text"])
    return surfaces.groupBy("doc_id").agg(texts("DATE").alias("allowed_dates"), texts("AMOUNT").alias("allowed_amounts"), texts("ORG").alias("allowed_orgs"), texts("PERSON").alias("known_entities"), texts("PERSON", False).alias("defendants"), texts("ORG", False).alias("organisations"), texts("DATE", False).alias("key_dates"))


def _strange(kind: str, pattern: str, label: str, test: str) -> str:
    return f"""SELECT doc_id, 'Section mentions unknown {kind} ''' || m || '''.' AS issue FROM (SELECT DISTINCT doc_id, trim(trim(regexp_replace(unnest(regexp_extract_all(text, {_q(pattern)})), '\\s+', ' ', 'g')), '.,;:()[]{{}}') AS m FROM docs) v
  WHERE NOT EXISTS (SELECT 1 FROM surf s WHERE s.doc_id = v.doc_id AND s.label = '{label}' AND {_KNOWN} AND {test})"""


@query(f"""WITH {derived.DOCUMENTS},
said AS (SELECT surf.doc_id, label, ord, okey, surf.text, contains(docs.text, surf.text) AS here, row_number() OVER (PARTITION BY surf.doc_id, label ORDER BY ord) AS i FROM surf JOIN docs USING (doc_id)),
k AS (SELECT doc_id, count(*) FILTER (WHERE label = 'PERSON' AND {_KNOWN} AND length(text) >= 4) AS n, count(*) FILTER (WHERE label = 'PERSON' AND {_KNOWN} AND length(text) >= 4 AND here) AS m,
  count(*) FILTER (WHERE label = 'PERSON' AND i <= 3) AS pn, count(*) FILTER (WHERE label = 'PERSON' AND i <= 3 AND here) AS pm,
  count(*) FILTER (WHERE label = 'ORG' AND i <= 5) AS orgn, count(*) FILTER (WHERE label = 'ORG' AND i <= 5 AND here) AS orgm,
  count(*) FILTER (WHERE label = 'DATE' AND i <= 2) AS dn, count(*) FILTER (WHERE label = 'DATE' AND i <= 2 AND here) AS dm FROM said GROUP BY doc_id),
f AS (
  SELECT doc_id, 'Section is significantly shorter than the requested target.' AS issue FROM docs WHERE {_WORDS.format("text")} < 84
  UNION ALL SELECT doc_id, 'Section does not mention any known case entity.' FROM k WHERE n > 0 AND m = 0
  UNION ALL {_strange("date", T.DATE, "DATE", "s.text = m")}
  UNION ALL {_strange("amount", T.AMOUNT, "AMOUNT", "s.text = m")}
  UNION ALL {_strange("organisation", T.ORGANISATION, "ORG", "(s.text = m OR contains(lower(s.text), lower(m)))")}
  UNION ALL SELECT doc_id, 'Facts section omits key defendants listed in CASE_MEMORY.' FROM k WHERE pn > 0 AND pm < least(2, pn)
  UNION ALL SELECT doc_id, 'Facts section omits key organisations listed in CASE_MEMORY.' FROM k WHERE orgn > 0 AND orgm < least(3, orgn)
  UNION ALL SELECT doc_id, 'Facts section omits key case dates from CASE_MEMORY.' FROM k WHERE dn > 0 AND dm = 0)
SELECT doc_id, issue FROM f""")
def fact_rule_issues(spark, sf_dir):
    """Case documents as facts sections, against the facts of every third order."""
    facts = _facts_of(derived.surfaces(spark, sf_dir))
    docs = derived.documents(spark, sf_dir).join(facts, "doc_id").withColumns({"section": F.lit("facts"), "word_target": F.lit(120)})
    return rules.issues(docs).select("doc_id", F.explode("issues").alias("issue"))


_VALUES = f"""WITH {_CASE},
v AS (
  SELECT doc_id, 'case_refs' AS kind, case_number AS value FROM meta UNION SELECT doc_id, 'case_refs', cross_ref FROM meta UNION SELECT doc_id, 'vats', vat FROM orgs UNION SELECT doc_id, 'titled', title_surname FROM persons
  UNION SELECT doc_id, 'initials', array_to_string(list_transform(string_split(name, ' '), lambda w: upper(left(w, 1))), '.') || '.' FROM persons),
t AS (SELECT doc_id, string_agg(value, ', ' ORDER BY kind, value) || ', Mr. Stranger and T123456789' AS text FROM v GROUP BY doc_id)"""


def _unknown_value(kind: str, issue: str, pattern: str, extra: str = "true", clean: str = "{}") -> str:
    m = clean.format(f"trim(unnest(regexp_extract_all(text, {_q(pattern)})), '.,;:()[]{{}}')")
    return f"""SELECT doc_id, 'Section mentions unknown {issue} ''' || m || '''.' AS issue FROM (SELECT DISTINCT doc_id, m FROM (SELECT doc_id, {m} AS m FROM t)) x
  WHERE {extra} AND NOT EXISTS (SELECT 1 FROM v WHERE v.doc_id = x.doc_id AND kind = '{kind}' AND value = m AND hash_of % 2 = 0)"""


@query(_VALUES.replace("\nt AS", "\nw AS (SELECT *, length(value) AS hash_of FROM v),\nt AS") + f""",
f AS (
  {_unknown_value("case_refs", "case reference", T.CASE_REFERENCE)}
  UNION ALL {_unknown_value("vats", "VAT/reference number", r"\b[A-Z]{2}[A-Z0-9]{8,14}\b", "regexp_matches(substr(m, 3), '[0-9]')")}
  UNION ALL {_unknown_value("titled", "titled person", T.TITLED_NAME, clean="replace({}, 'Mr. ', 'Mr ')")}
  UNION ALL {_unknown_value("initials", "initials", T.INITIALS)})
SELECT doc_id, issue FROM f""".replace("FROM v WHERE v.doc_id", "FROM w v WHERE v.doc_id"))
def value_rule_issues(spark, sf_dir):
    """References, VAT numbers, titled names and initials of a case, against those of an even length."""
    persons, orgs, meta, _, _ = _case_tables(spark, sf_dir)
    one = lambda frame, kind, value: frame.select("doc_id", F.lit(kind).alias("kind"), value.alias("value"))
    values = one(meta, "case_refs", F.col("case_number")).union(one(meta, "case_refs", F.col("cross_ref"))).union(one(orgs, "vats", F.col("vat"))).union(one(persons, "titled", F.col("title_surname"))).union(one(persons, "initials", T.make_initials(F.col("name")))).distinct()
    allowed = [F.collect_list(F.when((F.col("kind") == k) & (F.length("value") % 2 == 0), F.col("value"))).alias(f"allowed_{k}") for k in ("case_refs", "vats", "titled", "initials")]
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("kind", "value"))), lambda x: x["value"]), ", ")
    docs = values.groupBy("doc_id").agg(F.concat(said, F.lit(", Mr. Stranger and T123456789")).alias("text"), *allowed)
    names = ("unknown_case_references", "unknown_vat_numbers", "unknown_titled_people", "unknown_initials")
    found = rules.issues(docs.withColumns({"section": F.lit("charges"), "word_target": F.lit(0)}), {n: n in names for n in rules.RULES})
    return found.select("doc_id", F.explode("issues").alias("issue"))


@query(f"""WITH {_CASE},
t AS (SELECT doc_id, string_agg(CASE ord % 3 WHEN 0 THEN name WHEN 1 THEN dob ELSE address END, '; ' ORDER BY ord) AS text FROM persons GROUP BY doc_id),
p AS (SELECT doc_id, ord, f.k, f.field, f.value FROM persons, LATERAL (VALUES (0, 'name', name), (1, 'dob', dob), (2, 'role', CASE WHEN is_defendant THEN 'defendant' ELSE '' END), (3, 'address', address)) AS f(k, field, value))
SELECT DISTINCT doc_id, 'Section is missing required person ' || field || ' ''' || value || '''.' AS issue FROM p JOIN t USING (doc_id) WHERE value <> '' AND NOT contains(text, value)
UNION ALL
SELECT DISTINCT doc_id, 'Section is missing required company ' || field || ' ''' || value || '''.' FROM (
  SELECT doc_id, field, value, string_agg(name || ' of ' || address, '; ') OVER (PARTITION BY doc_id) AS text FROM orgs, LATERAL (VALUES ('name', name), ('vat', vat), ('address', address)) AS f(field, value)) WHERE NOT contains(text, value)""")
def required_fact_issues(spark, sf_dir):
    """Persons and companies of a case against sections that tell a part of what is required of them."""
    persons, orgs, *_ = _case_tables(spark, sf_dir)
    told = F.when(F.col("ord") % 3 == 0, F.col("name")).when(F.col("ord") % 3 == 1, F.col("dob")).otherwise(F.col("address"))
    joined = lambda value: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", value.alias("t")))), lambda v: v["t"]), "; ")
    person = F.struct("name", "dob", F.lit("").alias("nationality"), F.when(F.col("is_defendant"), "defendant").otherwise("").alias("role"), "address")
    company = F.struct("name", "vat", "address")
    people = persons.groupBy("doc_id").agg(joined(told).alias("text"), F.collect_list(person).alias("people")).withColumn("section", F.lit("persons"))
    companies = orgs.groupBy("doc_id").agg(joined(F.concat("name", F.lit(" of "), "address")).alias("text"), F.collect_list(company).alias("companies")).withColumn("section", F.lit("companies"))
    only = {n: n in ("required_person_facts", "required_company_facts") for n in rules.RULES}
    return rules.issues(people, only).select("doc_id", F.explode("issues").alias("issue")).unionByName(rules.issues(companies, only).select("doc_id", F.explode("issues").alias("issue")))


@query()
def rule_issues(spark, sf_dir):
    return _issues(spark, sf_dir).select("doc_id", F.size("issues").alias("n"), F.array_join("issues", "\n").alias("issues"))


@query(r"SELECT page_id, trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) AS title, length(html) AS n FROM pages")
def page_title_scan(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)).alias("title"), F.length("html").cast("bigint").alias("n"))


@query(r"""SELECT c_custkey, split_part(a, ', ', 1) AS street, split_part(a, ', ', 2) AS city, array_to_string(list_transform(string_split(n, ' '), lambda w: upper(left(w, 1))), '.') || '.' AS initials,
  upper(trim(regexp_replace(regexp_replace(c_name, '[^\p{L}\p{M}\p{N}\s& -]', ' ', 'g'), '\s+', ' ', 'g'))) AS company, trim(regexp_replace(regexp_replace(c_name, '[^\p{L}\p{M}\s'' -]', ' ', 'g'), '\s+', ' ', 'g')) AS person,
  trim(regexp_replace(regexp_replace(lower(c_name || '  (' || c_mktsegment || ')'), '[^a-z0-9-]+', '-', 'g'), '-{2,}', '-', 'g'), '-') AS slug
FROM (SELECT *, c_custkey || ' High Street, ' || c_mktsegment AS a, 'ann ' || lower(c_mktsegment) || ' ' || replace(c_name, '#', ' ') AS n FROM customer)""")
def name_functions(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    street, city = T.split_address(F.concat(F.col("c_custkey").cast("string"), F.lit(" High Street, "), "c_mktsegment"))
    name = F.concat(F.lit("Dr. ann "), F.lower("c_mktsegment"), F.lit(" "), F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")))
    return c.select("c_custkey", street.alias("street"), city.alias("city"), T.make_initials(name).alias("initials"), T.clean_company_token(F.col("c_name")).alias("company"), T.clean_person_part(F.col("c_name")).alias("person"), T.slug(F.concat("c_name", F.lit("  ("), "c_mktsegment", F.lit(")"))).alias("slug"))


@query(f"""WITH {derived.CALLS} SELECT ord, nullif(regexp_extract(task_id, '^(?:section_planner_|writer_|polish_|critic_)(.*?)(?:_r.*)?$', 1), '') AS section, nullif(regexp_extract(task_id, '_r(\\d+)', 1), '')::BIGINT AS revision,
  CASE WHEN latency_ms <= 30000 THEN 'very fast' WHEN latency_ms <= 90000 THEN 'fast' WHEN latency_ms <= 180000 THEN 'slow' ELSE 'very slow' END AS band,
  CASE WHEN s >= 3600 THEN s // 3600 || 'h ' || (s // 60) % 60 || 'm ' || s % 60 || 's' WHEN s >= 60 THEN s // 60 || 'm ' || s % 60 || 's' ELSE s || 's' END AS duration
FROM (SELECT *, round_even(latency_ms / 1000.0, 0)::BIGINT AS s FROM calls)""")
def latency_and_tasks(spark, sf_dir):
    c = derived.calls(spark, sf_dir)
    return c.select("ord", T.section_of_task(F.col("task_id")).alias("section"), T.revision_of_task(F.col("task_id")).alias("revision"), T.latency_band(F.col("latency_ms")).alias("band"), T.duration_text(F.col("latency_ms")).alias("duration"))


@query("SELECT event_id, (props::JSON->>'k')::BIGINT AS k, 'critic: ' || props || ' end' AS raw FROM events")
def props_json_parse(spark, sf_dir):
    raw = F.concat(F.lit("critic: "), "props", F.lit(" end"))
    return table(spark, sf_dir, "events").select("event_id", F.from_json(T.json_object_in(raw), "k bigint")["k"].alias("k"), raw.alias("raw"))


# -- quality -----------------------------------------------------------------------------------------------------------

_LATEST = "latest AS (SELECT conv_id::VARCHAR AS doc_id, role AS section, turn AS revision, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) = 1)"
_SCORED = f"""{_LATEST}, wanted AS (SELECT * FROM (SELECT DISTINCT conv_id::VARCHAR AS doc_id FROM conversations), (VALUES ('system'), ('user'), ('assistant')) AS s(section)),
s AS (SELECT *, {_WORDS.format("coalesce(text, '')")} AS words, CASE WHEN text IS NULL THEN 0 ELSE (regexp_matches(text, '\\*\\*'))::INTEGER + ({_WORDS.format("coalesce(text, '')")} < 60)::INTEGER END AS issue_count FROM wanted LEFT JOIN latest USING (doc_id, section)),
scored AS (SELECT *, CASE WHEN text IS NULL THEN 0 ELSE greatest(0, 100 - least(60, issue_count * 12) - least(18, revision * 6) - CASE WHEN words < 80 THEN 15 ELSE 0 END) END::BIGINT AS score FROM s)"""
_VERDICT = "CASE WHEN {0} >= 85 THEN 'good' WHEN {0} >= 70 THEN 'acceptable' WHEN {0} >= 50 THEN 'risky' ELSE 'bad' END"


def _scored(spark, sf_dir):
    artifacts = derived.sections(spark, sf_dir)
    found = quality.expected_sections([("system", 80), ("user", 80), ("assistant", 80)], artifacts, artifacts)
    count = F.size(F.concat(rules.RULES["markdown_formatting"](lambda n: F.coalesce("text", F.lit(""))), F.when(T.words(F.coalesce("text", F.lit(""))) < 60, F.array(F.lit("short"))).otherwise(F.array())))
    return quality.section_scores(found.withColumn("word_count", T.words(F.coalesce("text", F.lit("")))).withColumn("issue_count", F.when(F.col("text").isNull(), 0).otherwise(count)))


@query(f"WITH {_SCORED} SELECT doc_id, section, score, CASE WHEN text IS NULL THEN 'missing' ELSE {_VERDICT.format('score')} END AS verdict FROM scored".replace("regexp_matches(text, '\\*\\*')", "regexp_matches(text, '(?m)^\\s*#{1,6}\\s+') OR regexp_matches(text, '(?m)^\\s*[-*]\\s+') OR regexp_matches(text, '(?m)^\\s*\\d+\\.\\s+') OR regexp_matches(text, '(?m)^\\s*[-*_]{3,}\\s*$') OR regexp_matches(text, '\\*\\*')"))
def section_quality_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", "section", "score", "verdict")


@query(f"WITH {_SCORED}, d AS (SELECT doc_id, sum(score) AS total, count(*) AS sections, count(*) FILTER (WHERE text IS NULL) AS missing_sections FROM scored GROUP BY doc_id) SELECT doc_id, total::BIGINT AS total, sections, missing_sections, {_VERDICT.format('total / sections')} AS verdict FROM d".replace("regexp_matches(text, '\\*\\*')", "regexp_matches(text, '(?m)^\\s*#{1,6}\\s+') OR regexp_matches(text, '(?m)^\\s*[-*]\\s+') OR regexp_matches(text, '(?m)^\\s*\\d+\\.\\s+') OR regexp_matches(text, '(?m)^\\s*[-*_]{3,}\\s*$') OR regexp_matches(text, '\\*\\*')"))
def doc_quality_verdict(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    totals = scored.groupBy("doc_id").agg(F.sum("score").alias("total"))
    return quality.document_scores(scored).join(totals, "doc_id").select("doc_id", "total", "sections", "missing_sections", "verdict")


@query(f"WITH {_LATEST} SELECT * FROM latest")
def latest_revision(spark, sf_dir):
    return quality.latest_revision(derived.sections(spark, sf_dir))


@query("SELECT conv_id AS doc_id, role AS section, turn AS chunk, sum(len(regexp_extract_all(text, '\\S+'))) OVER (PARTITION BY conv_id, role ORDER BY turn)::BIGINT AS words_so_far FROM conversations")
def cumulative_words(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("role").alias("section"), F.col("turn").alias("chunk"), T.words(F.col("text")).alias("words"))
    return telemetry.cumulative_words(c).select("doc_id", "section", "chunk", "words_so_far")


# -- telemetry ---------------------------------------------------------------------------------------------------------

_TOTALS = """count(*) AS calls, coalesce(sum(latency_ms), 0)::BIGINT AS total_ms, coalesce(sum(tokens_prompt), 0)::BIGINT AS tokens_prompt, coalesce(sum(tokens_response), 0)::BIGINT AS tokens_response,
  count(*) FILTER (WHERE response_empty) AS empty, count(*) FILTER (WHERE done_reason = 'length') AS truncated, count(*) FILTER (WHERE error) AS errors, count(DISTINCT CASE WHEN revision_round > 0 THEN section_name END) AS revised_sections"""


@query(f"WITH {derived.CALLS} SELECT coalesce(stage, 'unknown') AS stage, {_TOTALS}, round_even(sum(latency_ms) / count(*), 0)::BIGINT AS avg_ms FROM calls GROUP BY 1")
def stage_rollup(spark, sf_dir):
    return telemetry.stage_rollup(derived.calls(spark, sf_dir))


@query(f"WITH {derived.CALLS} SELECT {_TOTALS} FROM calls")
def call_totals(spark, sf_dir):
    return telemetry.call_totals(derived.calls(spark, sf_dir))


@query(f"WITH {derived.CALLS} SELECT section_name, task_id, stage, latency_ms FROM calls QUALIFY row_number() OVER (PARTITION BY section_name ORDER BY latency_ms DESC, ord) = 1")
def max_call(spark, sf_dir):
    return telemetry.largest_call(derived.calls(spark, sf_dir), "latency_ms", ("section_name",))


@query(f"WITH {derived.CALLS}, s AS (SELECT coalesce(stage, 'unknown') AS stage, sum(latency_ms)::BIGINT AS total_ms FROM calls GROUP BY 1) SELECT stage, total_ms FROM s ORDER BY total_ms DESC, stage DESC LIMIT 1")
def slowest_stage(spark, sf_dir):
    return telemetry.slowest_stage(telemetry.stage_rollup(derived.calls(spark, sf_dir)))


@query(f"""WITH {derived.CALLS}, r AS (SELECT ord, coalesce(stage, 'unknown') AS node_name, CASE WHEN error THEN 'error' ELSE 'ok' END AS status, latency_ms, lead(coalesce(stage, 'unknown')) OVER (PARTITION BY user_id ORDER BY ts, ord) AS next_node FROM calls)
SELECT node_name, count(*) AS executions, round_even(avg(latency_ms), 0)::BIGINT AS avg_ms, max(latency_ms) AS max_ms, count(*) FILTER (WHERE status = 'error') AS errors, string_agg(DISTINCT next_node, ',' ORDER BY next_node) AS next_nodes, min(ord) AS first_ord FROM r GROUP BY node_name""")
def node_rollup(spark, sf_dir):
    c = derived.calls(spark, sf_dir).withColumn("node_name", F.coalesce("stage", F.lit("unknown")))
    runs = c.select("ord", "node_name", F.when(F.col("error"), "error").otherwise("ok").alias("status"), "latency_ms", F.lead("node_name").over(Window.partitionBy("user_id").orderBy("ts", "ord")).alias("next_node"))
    return telemetry.node_rollup(runs)


def _rubrics(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    stack = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(n).alias("name"), v.cast("double").alias("value")) for i, (n, v) in enumerate((("rubric.quality", F.col("quality")), ("rubric.toxic", F.col("toxic")), ("rubric.grounding", (F.col("doc_id") % 5) + 1), ("rubric.overall", F.col("quality")), ("other", F.lit(1))))])).alias("r")
    scores = labels.select((F.col("doc_id") * 10).alias("o"), F.concat(F.lit("obs"), F.col("doc_id").cast("string")).alias("observation_id"), stack).select((F.col("o") + F.col("r.i")).alias("ord"), "observation_id", "r.name", "r.value")
    observations = labels.select(F.concat(F.lit("obs"), F.col("doc_id").cast("string")).alias("observation_id"), F.concat(F.lit("s"), (F.col("doc_id") % 7).cast("string")).alias("section_name"), (F.col("doc_id") % 4).alias("revision_round"))
    return telemetry.with_observation(telemetry.rubric_scores(scores), observations)


_RUBRICS = """rub AS (SELECT 's' || (doc_id % 7) AS section_name, doc_id % 4 AS revision_round, doc_id * 10 + i AS ord, metric, value FROM labels,
  LATERAL (VALUES (0, 'quality', quality::DOUBLE), (1, 'toxic', toxic::DOUBLE), (2, 'grounding', (doc_id % 5 + 1)::DOUBLE)) AS v(i, metric, value))"""


@query(f"WITH {_RUBRICS} SELECT metric, avg(value) AS average, count(*) AS n, min(ord) AS first_ord FROM rub GROUP BY metric")
def rubric_summary(spark, sf_dir):
    return telemetry.rubric_summary(_rubrics(spark, sf_dir))


@query(f"WITH {_RUBRICS}, m AS (SELECT metric, avg(value) AS a, min(ord) AS o FROM rub GROUP BY metric) SELECT (SELECT metric FROM m ORDER BY a, o LIMIT 1) AS lowest_metric, round((SELECT avg(value) FROM rub), 6) AS overall")
def rubric_overall(spark, sf_dir):
    return telemetry.rubric_overall(_rubrics(spark, sf_dir)).withColumn("overall", F.round("overall", 6))


@query(f"""WITH {_RUBRICS}, l AS (SELECT * FROM rub QUALIFY revision_round = max(revision_round) OVER (PARTITION BY section_name)),
m AS (SELECT section_name, metric, round(avg(value), 2) AS a, max(revision_round) AS revision, count(*) AS n FROM l GROUP BY section_name, metric)
SELECT section_name, round(avg(a), 2) AS overall, max(revision) AS revision, sum(n)::BIGINT AS scores FROM m GROUP BY section_name""")
def latest_rubric_by_section(spark, sf_dir):
    return telemetry.section_rubrics(_rubrics(spark, sf_dir))


@query(f"""WITH {derived.CALLS}, o AS (SELECT ord // 50 AS trace, section_name, revision_round, CASE WHEN user_id % 2 = 0 THEN 'writer' ELSE 'polisher' END AS stage, task_id, ord AS call FROM calls),
t AS (SELECT * FROM o QUALIFY revision_round = max(revision_round) OVER (PARTITION BY trace, section_name, stage)), b AS (SELECT *, CASE stage WHEN 'polisher' THEN 0 ELSE 1 END AS k FROM t),
c AS (SELECT * FROM b QUALIFY k = min(k) OVER (PARTITION BY trace, section_name))
SELECT trace, section_name, stage, task_id, call, row_number() OVER (PARTITION BY trace, section_name ORDER BY regexp_extract(task_id, '_chunk_(\\d+)$', 1)::INTEGER, task_id, call)::INTEGER AS ord FROM c""")
def latest_observations(spark, sf_dir):
    """Traces hold fifty calls, so that no section's calls of the whole table meet in one task."""
    o = derived.calls(spark, sf_dir).select(F.floor(F.col("ord") / 50).alias("trace"), "section_name", "revision_round", F.when(F.col("user_id") % 2 == 0, "writer").otherwise("polisher").alias("stage"), "task_id", F.col("ord").alias("call"))
    return telemetry.latest_observations(o, ties=("call",), by=("trace",)).select("trace", "section_name", "stage", "task_id", "call", "ord")


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type AS stage, count(*) AS calls, round(sum(value), 6) AS total, max(value) AS largest FROM events GROUP BY 1, 2")
def events_daily(spark, sf_dir):
    out = rollups.windowed_stages(table(spark, sf_dir, "events"))
    return out.withColumn("total", F.round("total", 6)).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(f"""WITH {_SCORED}, t AS (SELECT doc_id, sum(coalesce(revision, 0))::BIGINT AS revisions, sum(words)::BIGINT AS words, coalesce(string_agg(CASE WHEN text IS NULL THEN section END, ',' ORDER BY section), '') AS missing FROM scored GROUP BY doc_id)
SELECT * FROM t""")
def overview_totals(spark, sf_dir):
    out = overview.totals(_scored(spark, sf_dir))
    return out.select("doc_id", "revisions", "words", F.array_join("missing", ",").alias("missing"))


def _strange_to_memory(rank: int, kind: str, pattern: str, known: str) -> str:
    return f"""SELECT doc_id, {rank} AS rank, m, 'Section mentions unknown {kind} ''' || m || '''.' AS issue FROM (SELECT DISTINCT doc_id, trim(trim(regexp_replace(unnest(regexp_extract_all(text, {_q(pattern)})), '\\s+', ' ', 'g')), '.,;:()[]{{}}') AS m FROM docs) v WHERE {known}"""


@query(f"""WITH {derived.DOCUMENTS}, f AS (
  SELECT doc_id, 1 AS rank, '' AS m, 'Section is significantly shorter than the requested target.' AS issue FROM docs WHERE {_WORDS.format("text")} < 60
  UNION ALL {_strange_to_memory(2, "date", T.DATE, "NOT EXISTS (SELECT 1 FROM surf s WHERE s.doc_id = v.doc_id AND s.label = 'DATE' AND okey % 2 = 0 AND s.text = m)")}
  UNION ALL {_strange_to_memory(3, "amount", T.AMOUNT, "true")}
  UNION ALL {_strange_to_memory(4, "organisation", T.ORGANISATION, "true")})
SELECT docs.doc_id, count(issue)::INTEGER AS n, coalesce(string_agg(issue, chr(10) ORDER BY rank, m), '') AS issues FROM docs LEFT JOIN f ON f.doc_id = docs.doc_id GROUP BY docs.doc_id""")
def memory_validation(spark, sf_dir):
    """Rendered case documents against a memory that knows every other date."""
    known = derived.surfaces(spark, sf_dir).where("label = 'DATE' and okey % 2 = 0").groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list("text")), "\n- ").alias("d"))
    notes = known.select("doc_id", F.concat(F.lit("# CASE_MEMORY\n\n## Allowed References\n### Case References and Dates\n- "), "d", F.lit("\n")).alias("memory_text"))
    texts = derived.documents(spark, sf_dir).select("doc_id", F.lit("history").alias("section"), "text", F.lit(0).alias("word_target"))
    return memory.validate(texts, notes).select("doc_id", F.size("issues").alias("n"), F.array_join("issues", "\n").alias("issues"))


@query("""WITH v AS (SELECT c_custkey, c_mktsegment AS x, length(c_mktsegment) AS n FROM customer),
l AS (SELECT c_custkey, CASE WHEN n > 4 THEN list_filter([left(x, 4), CASE WHEN n > 5 THEN left(x, 5) END, left(x, 3), CASE WHEN n > 5 AND regexp_matches(x, '(?:as|os|us)$') THEN left(x, n - 2) END, CASE WHEN n > 6 AND ends_with(x, 'olas') THEN left(x, n - 4) END], lambda y: y IS NOT NULL) ELSE [] END AS v FROM v)
SELECT c_custkey, array_to_string(list_filter(v, lambda y, i: list_position(v, y) = i), '|') AS nick FROM l""")
def name_variants(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(names.nicknames(F.col("c_mktsegment")), "|").alias("nick"))


# -- listings and model output -----------------------------------------------------------------------------------------


@query("""WITH i AS (SELECT printf('en_%s_%s_%03d', CASE WHEN o_orderkey % 2 = 0 THEN 'indictment' ELSE 'court' END, lower(o_orderstatus), o_orderkey) AS doc_id FROM orders)
SELECT (max(regexp_extract(doc_id, '_(\\d+)$', 1)::INTEGER) + 1) AS next_counter FROM i WHERE starts_with(doc_id, 'en_indictment')""")
def next_counter(spark, sf_dir):
    kind = F.when(F.col("o_orderkey") % 2 == 0, "indictment").otherwise("court")
    ids = table(spark, sf_dir, "orders").select(T.doc_id(kind, F.lower("o_orderstatus"), F.col("o_orderkey")).alias("doc_id"))
    return listing.next_counter(ids, "en_indictment")


@query(f"""WITH {derived.DOCUMENTS}, u AS (SELECT doc_id, 0 AS r FROM docs UNION ALL SELECT doc_id, 1 FROM gt UNION ALL SELECT doc_id, 2 FROM pred)
SELECT doc_id, max(r = 0) AS in_0, max(r = 1) AS in_1, max(r = 2) AS in_2, regexp_extract(doc_id, '_(\\d+)$', 1)::INTEGER AS counter FROM u GROUP BY doc_id""")
def candidate_listing(spark, sf_dir):
    return listing.ordered_candidates(listing.union_of_ids(derived.documents(spark, sf_dir), derived.groundtruth(spark, sf_dir), derived.predictions(spark, sf_dir)))


def _reviews(spark, sf_dir):
    """Recorded reviews: three of four are JSON packets in a code fence, every other one of those with an edit; the rest is plain text."""
    labels = table(spark, sf_dir, "labels")
    number = lambda c: c.cast("string")
    edits = F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit('{"target": " t ", "reason": "r'), number(F.col("doc_id") % 3), F.lit('"}'))).otherwise("")
    packet = F.concat(F.lit('```json\n{"blocking": '), F.when(F.col("toxic") == 1, "true").otherwise("false"), F.lit(', "edits": ['), edits, F.lit('], "rubrics": {"grounding": '), number(F.col("doc_id") % 5 + 1), F.lit(', "Style Tone": '), number(F.col("doc_id") % 7), F.lit("}}\n```"))
    plain = F.concat(F.lit("APPROVED: "), F.when(F.col("toxic") == 1, "no").otherwise("yes"), F.lit("\r\nRUBRICS:\n- Grounding: "), number(F.col("doc_id") % 5 + 1), F.lit("/5\n- style-tone : "), number(F.col("doc_id") % 7), F.lit("\nISSUES:\n- "), F.when(F.col("doc_id") % 3 == 0, "None").otherwise(F.concat(F.lit("i"), number(F.col("doc_id") % 3))), F.lit("\nREVISION:\n"), F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 5 == 1, " Keep as is ").otherwise("do it"))
    return labels.select("doc_id", F.when(F.col("doc_id") % 4 == 3, plain).otherwise(packet).alias("raw_text"))


@query(f"""WITH r AS (SELECT doc_id, doc_id % 4 = 3 AS legacy, coalesce(toxic = 1, false) AS said, doc_id % 5 + 1 AS g, CASE WHEN doc_id % 7 BETWEEN 1 AND 5 THEN doc_id % 7 END AS st, doc_id % 3 AS k FROM labels),
o AS (SELECT *, CASE WHEN st IS NULL THEN g::DOUBLE ELSE (g + st) / 2 END AS overall, NOT legacy AND doc_id % 2 = 1 AS edit, CASE WHEN g <= 2 THEN ['Critic rubric ''grounding'' is blocking with score ' || g || '/5.'] ELSE [] END AS crit FROM r),
i AS (SELECT *, overall >= 3.5 AS good, list_concat(CASE WHEN legacy THEN CASE WHEN k = 0 THEN [] ELSE ['i' || k] END WHEN edit THEN ['revise ''t'': r' || k] ELSE [] END, crit) AS found,
  CASE doc_id % 5 WHEN 0 THEN 'Fix the inconsistencies flagged by the critic.' WHEN 1 THEN 'Keep as is' ELSE 'do it' END AS told FROM o),
d AS (SELECT *, CASE
    WHEN legacy THEN CASE WHEN good AND g > 2 THEN [] WHEN said AND len(found) = 0 THEN ['{model_output.NO_ISSUES}'] ELSE found END
    WHEN g <= 2 THEN found WHEN good THEN [] WHEN said AND NOT edit THEN ['{model_output.NO_EDITS}'] ELSE found END AS issues,
  CASE
    WHEN legacy THEN CASE WHEN good AND g > 2 THEN 'keep as is' WHEN said AND lower(told) = 'keep as is' THEN '{model_output.CONSISTENT}' ELSE told END
    WHEN g <= 2 THEN '{model_output.IMPROVE}' WHEN good THEN 'keep as is' WHEN said AND NOT edit THEN '{model_output.RESOLVE}'
    WHEN edit THEN 'Apply these specific critic edits:' || chr(10) || '1. Target: t; action: revise; reason: r' || k ELSE 'keep as is' END AS revision_instruction FROM i)
SELECT doc_id, overall, array_to_string(issues, '|') AS issues, revision_instruction,
  CASE WHEN legacy THEN (NOT said OR (good AND g > 2)) AND len(issues) = 0 WHEN g <= 2 THEN false WHEN good THEN true ELSE NOT (said OR edit) END AS approved,
  CASE WHEN legacy THEN CASE WHEN len(issues) > 0 THEN 'medium' ELSE 'low' END WHEN said OR edit THEN 'medium' ELSE 'low' END AS risk_level,
  CASE WHEN legacy THEN len(issues) WHEN edit THEN 1 ELSE 0 END::INTEGER AS edits FROM d""")
def review_decisions(spark, sf_dir):
    return model_output.decide(_reviews(spark, sf_dir)).select("doc_id", "overall", F.array_join("issues", "|").alias("issues"), "revision_instruction", "approved", "risk_level", F.size("edits").alias("edits"))


@query("SELECT doc_id, 'r' || doc_id AS content, CASE WHEN doc_id % 2 = 0 THEN 's' || quality ELSE '' END AS summary FROM labels")
def packet_parse(spark, sf_dir):
    key = F.col("doc_id").cast("string")
    raw = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit('noise {"content": "r'), key, F.lit('", "summary": "s'), F.col("quality").cast("string"), F.lit('"} tail'))).otherwise(F.concat(F.lit("r"), key))
    return table(spark, sf_dir, "labels").select("doc_id", model_output.parse_packet(raw).alias("p")).select("doc_id", "p.content", "p.summary")


@query()
def generated_cases(spark, sf_dir):
    persons, orgs = generate.persons(spark, 40), generate.organisations(spark, 40)
    meta = persons.select("doc_id").distinct().select("doc_id", F.concat(F.lit("CPS/2024/"), F.right("doc_id", F.lit(3)), F.lit("0")).alias("case_number"), F.lit("C/2024/1").alias("cross_ref"), F.lit("3 March 2026").alias("filing_date"), F.lit(None).cast("string").alias("offence_start"), F.lit(None).cast("string").alias("offence_end"))
    none = spark.createDataFrame([], "doc_id string, ord bigint, particulars string, value string")
    return groundtruth.build(persons, orgs, meta, none.select("doc_id", "ord", "particulars"), none.select("doc_id", "ord", "value"))


@query(f"""WITH {derived.SURFACES},
p AS (SELECT doc_id, text, min(ord) AS o FROM surf WHERE label = 'PERSON' GROUP BY ALL), a AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY o) AS i FROM p),
v AS (SELECT DISTINCT doc_id, text FROM surf), b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length(text) DESC, text) AS i FROM v)
SELECT doc_id, first, longest FROM (SELECT doc_id, string_agg(text, '|' ORDER BY i) AS first FROM a WHERE i <= 3 GROUP BY doc_id) JOIN (SELECT doc_id, string_agg(text, '|' ORDER BY i) AS longest FROM b WHERE i <= 5 GROUP BY doc_id) USING (doc_id)""")
def memory_heads(spark, sf_dir):
    """The first three persons of a memory's block and the five longest values of a case."""
    s = derived.surfaces(spark, sf_dir)
    line = F.when(F.col("label") == "PERSON", F.struct("ord", F.concat(F.lit("- "), "text", F.lit(" | role: none")).alias("t")))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["t"]), "\n")
    cases = s.groupBy("doc_id").agg(F.concat(F.lit("# CASE_MEMORY\n\n## Defendants\n- none\n"), lines, F.lit("\n\n## Counts\n- x")).alias("memory"), F.collect_list("text").alias("values"))
    return cases.select("doc_id", F.array_join(memory.first_names(F.col("memory"), "Defendants", 3), "|").alias("first"), F.array_join(listing.longest_values(F.col("values"), 5), "|").alias("longest"))


_COUNTRIES = (*generate.VAT_FORMATS, "XX")


def _vat_sql(country: str) -> str:
    parts, left = [f"'{country}'"], "n"
    for part in generate.VAT_FORMATS.get(country, (9,)):
        if isinstance(part, int):
            parts.append(f"lpad(({left} % {10**part})::VARCHAR, {part}, '0')")
        else:
            parts.append(f"substr('{part}', ({left} % {len(part)})::INTEGER + 1, 1)")
            left = f"({left} // {len(part)})"
    return " || ".join(parts)


@query(f"""SELECT s_suppkey, CASE s_suppkey % {len(_COUNTRIES)} {" ".join(f"WHEN {i} THEN {_vat_sql(c)}" for i, c in enumerate(_COUNTRIES))} END AS vat FROM (SELECT s_suppkey, s_suppkey * 104729 AS n FROM supplier)""")
def country_vat_numbers(spark, sf_dir):
    country = F.get(F.array(*map(F.lit, _COUNTRIES)), (F.col("s_suppkey") % len(_COUNTRIES)).cast("int"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", generate.vat_of_country(country, F.col("s_suppkey") * 104729).alias("vat"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'CPS/' || (n % 3 + 2024) || '/' || lpad((n % 9900 + 100)::VARCHAR, 4, '0') ELSE 'T' || (n % 3 + 2024) || lpad((n % 9900 + 100)::VARCHAR, 5, '0') END AS case_number,
  'C/' || (n % 3 + 2024) || '/' || (n % 9900 + 100) AS cross_reference, lpad((n % 9999999 + 1)::VARCHAR, 7, '0') || '/' || lpad((n % 999 + 1)::VARCHAR, 3, '0') AS legal_reference,
  '£' || format('{:,}', n % 925001 + 25000) AS amount, strftime(DATE '2026-03-01' - (n % 371 + 30)::INTEGER, '%-d %B %Y') AS filed FROM (SELECT o_orderkey, o_orderkey * 7919 AS n FROM orders)""")
def generated_identifiers(spark, sf_dir):
    n, kind = F.col("o_orderkey") * 7919, F.when(F.col("o_orderkey") % 2 == 0, "indictment").otherwise("judgment")
    return table(spark, sf_dir, "orders").select("o_orderkey", generate.case_number(kind, n).alias("case_number"), generate.cross_reference(n).alias("cross_reference"), generate.legal_reference(n).alias("legal_reference"), generate.money_amount(n).alias("amount"), generate.filing_date(n, F.lit("2026-03-01").cast("date")).alias("filed"))


@query(f"""WITH {_CASE}, s AS (SELECT conv_id::VARCHAR AS doc_id, count(DISTINCT role) AS sections FROM conversations GROUP BY 1),
g AS (SELECT doc_id, count(*) FILTER (WHERE grp <> 'associated') AS charged, count(*) FILTER (WHERE grp = 'associated') AS associated FROM orgs GROUP BY doc_id),
t AS (SELECT printf('en_case_%05d', o_orderkey // 20) AS doc_id, sum(o_orderkey % 700) || 'w prose' AS label FROM orders GROUP BY 1)
SELECT doc_id, 'sections' AS what, sections::VARCHAR AS value FROM s UNION ALL SELECT doc_id, 'groups', charged || '/' || associated FROM g UNION ALL SELECT doc_id, 'size', label FROM t""")
def case_size_counts(spark, sf_dir):
    """Sections with artifacts, organisations by group and the size label of each document."""
    _, orgs, *_ = _case_tables(spark, sf_dir)
    targets = table(spark, sf_dir, "orders").groupBy(F.format_string("en_case_%05d", F.floor(F.col("o_orderkey") / 20)).alias("doc_id")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 700))).alias("targets"))
    one = lambda frame, what, value: frame.select("doc_id", F.lit(what).alias("what"), value.alias("value"))
    sections = one(listing.section_counts(derived.sections(spark, sf_dir)), "sections", F.col("sections").cast("string"))
    groups = one(listing.group_counts(orgs), "groups", F.concat_ws("/", F.col("charged").cast("string"), F.col("associated").cast("string")))
    return sections.unionByName(groups).unionByName(one(targets, "size", listing.size_label(F.col("targets"))))


@query("""SELECT printf('en_case_%05d', o_orderkey // 20) AS doc_id, row_number() OVER (PARTITION BY o_orderkey // 20 ORDER BY o_orderkey)::INTEGER AS index, o_orderkey::VARCHAR AS "key", o_orderpriority AS offence, '{"status":"' || o_orderstatus || '"}' AS detail FROM orders""")
def count_review_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.format_string("en_case_%05d", F.floor(F.col("o_orderkey") / 20)).alias("doc_id"), F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("offence"), F.struct(F.col("o_orderstatus").alias("status")).alias("detail")).alias("c"))
    return overview.count_rows(o.groupBy("doc_id").agg(F.array_sort(F.collect_list("c")).alias("counts")))


@query(f"WITH {_CASE} SELECT doc_id, ord, name, is_defendant AS defendant FROM persons")
def people_by_group(spark, sf_dir):
    persons, *_ = _case_tables(spark, sf_dir)
    defendants, collateral = overview.split_people(persons.select("doc_id", "ord", "name", F.when(F.col("is_defendant"), "defendant").otherwise("collateral").alias("grp")))
    return defendants.withColumn("defendant", F.lit(True)).unionByName(collateral.withColumn("defendant", F.lit(False)))


@query(f"""WITH {derived.PARTIES}, ids AS (SELECT DISTINCT doc_id FROM defendants UNION SELECT DISTINCT doc_id FROM charged),
k AS (SELECT doc_id, regexp_extract(doc_id, '_([0-9]+)_', 1)::INTEGER AS n FROM ids),
p AS (SELECT doc_id, string_agg(name, '|' ORDER BY ord) AS names FROM defendants GROUP BY doc_id), o AS (SELECT doc_id, string_agg(name, '|' ORDER BY ord) AS names FROM charged GROUP BY doc_id)
SELECT k.doc_id, CASE WHEN n % 3 = 0 THEN 'Set Person' ELSE coalesce(p.names, '') END AS persons, CASE WHEN n % 5 = 0 THEN '' ELSE coalesce(o.names, '') END AS orgs, CASE WHEN n % 2 = 0 THEN 1 ELSE 0 END AS edges FROM k LEFT JOIN p USING (doc_id) LEFT JOIN o USING (doc_id)""")
def normalised_schemas(spark, sf_dir):
    """Configured schemas of some documents, the derived nodes of the others."""
    parties = derived.parties(spark, sf_dir)
    ids = parties["defendants"].select("doc_id").union(parties["charged"].select("doc_id")).distinct()
    n = F.regexp_extract("doc_id", r"_(\d+)_", 1).cast("int")
    node = lambda name: F.array(F.struct(F.lit("p1").alias("id"), F.lit(name).alias("name"), F.lit("person").alias("type")))
    empty = F.array().cast("array<struct<id:string,name:string,type:string>>")
    configured = ids.select("doc_id", F.when(n % 3 == 0, node("Set Person")).alias("persons"), F.when(n % 5 == 0, empty).alias("orgs"), F.when(n % 2 == 0, F.array(F.struct(F.lit("a").alias("src"), F.lit("b").alias("dst"), F.lit("x").alias("type")))).alias("edges"))
    out = graph.normalise_schema(configured, parties["defendants"], parties["charged"])
    names = lambda c: F.array_join(F.transform(c, lambda x: x["name"]), "|")
    return out.select("doc_id", names("persons").alias("persons"), names("orgs").alias("orgs"), F.size("edges").alias("edges"))


@query(r"""WITH m AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'the limit is ' || 100 WHEN 1 THEN 'status_code: ' || (400 + event_id % 100) || ', body: {"id": ' || event_id || '}' WHEN 2 THEN repeat('long ' || (event_id % 7) || ' ', 60) ELSE event_type END AS msg FROM events)
SELECT event_id, 'Trace read failed: ' || CASE event_id % 4 WHEN 0 THEN 'API pagination limit exceeded' WHEN 1 THEN 'HTTP ' || (400 + event_id % 100) || ' {"id": ' || event_id || '}' WHEN 2 THEN rtrim(left(msg, 237)) || '...' ELSE msg END AS said FROM m""")
def shortened_errors(spark, sf_dir):
    key, kind = F.col("event_id"), F.col("event_id") % 4
    text = lambda c: c.cast("string")
    said = F.when(kind == 0, F.lit("the limit is 100")).when(kind == 1, F.concat(F.lit("status_code: "), text(key % 100 + 400), F.lit(', body: {"id": '), text(key), F.lit("}"))).when(kind == 2, F.repeat(F.concat(F.lit("long "), text(key % 7), F.lit(" ")), 60)).otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", model_output.shortened_error(said, "Trace").alias("said"))


# -- written and read again --------------------------------------------------------------------------------------------


@query(f"WITH {derived.GROUNDTRUTH} SELECT doc_id, text AS entity_text, label, should_propose, notes, count(*) AS n FROM gt GROUP BY ALL")
def groundtruth_round_trip(spark, sf_dir):
    """Ground truth written as TSV and read again."""
    path = derived.written_to(spark, "groundtruth")
    writers.groundtruth(derived.groundtruth(spark, sf_dir).withColumnRenamed("text", "entity_text"), path)
    back = readers.groundtruth(spark, path + "/*")
    return back.groupBy("doc_id", "entity_text", "label", "should_propose", "notes").agg(F.count("*").alias("n"))


@query(f"{_STRICT}, c AS (SELECT doc_id, {_COUNTS} FROM keys GROUP BY doc_id) {_RATES}")
def metrics_round_trip(spark, sf_dir):
    """Metrics written as JSON lines and read again."""
    rows = strict_prf(spark, sf_dir)
    path = derived.written_to(spark, "metrics")
    writers.metrics(rows, path)
    return spark.read.schema(rows.schema).json(path).select(rows.columns)


@query("SELECT conv_id::VARCHAR AS doc_id, role AS section, turn AS revision, text FROM conversations")
def history_round_trip(spark, sf_dir):
    """Sections appended to a history in two parts and read again."""
    rows = derived.sections(spark, sf_dir)
    path = derived.written_to(spark, "history")
    for part in (0, 1):
        writers.append_history(rows.where(F.pmod("revision", F.lit(2)) == part), path)
    return spark.read.schema(rows.schema).parquet(path)


@query(r"SELECT printf('en_case_%05d', event_id) AS doc_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE format('{:,}', event_id * 37) END AS calls, 'writer' AS stage, event_id * 37 AS n, CASE WHEN event_id % 2 = 0 THEN event_id ELSE 0 END AS total_ms FROM events")
def report_scan(spark, sf_dir):
    """Fields and the stage table of a Markdown report of each event."""
    n = F.col("event_id")
    shown = F.format_number(n * 37, 0)
    text = F.concat(F.lit("# Report\n- Total calls: "), F.when(n % 3 == 0, "n/a").otherwise(shown), F.lit("\n- Total calls: 5\n\n| Stage | Calls | Total ms | Avg ms | Prompt Tokens | Response Tokens | Empty | Truncated | Errors |\n|---|---|---|---|---|---|---|---|---|\n| writer | "), shown, F.lit(" | "), F.when(n % 2 == 0, n.cast("string")).otherwise("x"), F.lit(" | 1 | 2 | 3 | 0 | 0 | 0 |\n\n| late | 1 | 1 | 1 | 1 | 1 | 1 | 1 | 1 |"))
    reports = table(spark, sf_dir, "events").select(F.format_string("en_case_%05d", n).alias("doc_id"), text.alias("text"))
    stages = readers.stage_table(reports).select("doc_id", "stage", F.col("calls").alias("n"), "total_ms")
    return readers.report_fields(reports, {"calls": "Total calls"}).join(stages, "doc_id")
