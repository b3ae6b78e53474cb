"""Case-like tables derived from the relational test tables, in Spark and in SQL.

A case document holds the orders of twenty neighbouring keys, so documents stay small at any scale.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ORDERS_A_CASE = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written_to(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the session names for driver and executors; on one machine alone a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="lexmill-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def surfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, okey, n, ord, label, text: four surfaces of each order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sk"), "s_name")
    # modulo ten keeps to suppliers that every scale has
    joined = orders.join(customers, "o_custkey", "left").withColumn("sk", F.col("o_orderkey") % 10).join(suppliers, "sk", "left")
    kinds = [
        ("PERSON", F.coalesce("c_name", F.lit("Customer#none"))),
        ("DATE", F.date_format("o_orderdate", "d MMMM yyyy")),
        ("AMOUNT", F.concat(F.lit("£"), F.format_number(F.floor("o_totalprice"), 0))),
        ("ORG", F.concat(F.upper(F.replace(F.col("s_name"), F.lit("#"), F.lit(" "))), F.lit(" LTD"))),
    ]
    each = F.posexplode(F.array(*[F.struct(F.lit(label).alias("label"), text.alias("text")) for label, text in kinds])).alias("k", "s")
    flat = joined.select(F.col("o_orderkey").alias("okey"), each).select("okey", "k", "s.*")
    return flat.select(F.format_string("en_case_%05d", F.floor(F.col("okey") / ORDERS_A_CASE)).alias("doc_id"), "okey", (F.col("okey") * 10 + F.col("k")).alias("n"), ((F.col("okey") % ORDERS_A_CASE) * 10 + F.col("k")).alias("ord"), "label", "text")


SURFACES = """
surf AS (
  SELECT printf('en_case_%05d', o_orderkey // 20) AS doc_id, o_orderkey AS okey, o_orderkey * 10 + x.k AS n, (o_orderkey % 20) * 10 + x.k AS ord, x.label, x.text
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN supplier ON s_suppkey = o_orderkey % 10,
  LATERAL (VALUES
    (0, 'PERSON', coalesce(c_name, 'Customer#none')),
    (1, 'DATE', strftime(o_orderdate, '%-d %B %Y')),
    (2, 'AMOUNT', '£' || format('{:,}', floor(o_totalprice)::BIGINT)),
    (3, 'ORG', upper(replace(s_name, '#', ' ')) || ' LTD')) AS x(k, label, text))"""


def groundtruth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surfaces with should_propose and notes; every ninth is a negative control."""
    control = F.col("n") % 9 == 0
    return surfaces(spark, sf_dir).withColumn("should_propose", F.when(control, "no").otherwise("yes")).withColumn("notes", F.when(control, "control").otherwise(F.lower("label")))


GROUNDTRUTH = SURFACES + """,
gt AS (SELECT *, CASE WHEN n % 9 = 0 THEN 'no' ELSE 'yes' END AS should_propose, CASE WHEN n % 9 = 0 THEN 'control' ELSE lower(label) END AS notes FROM surf)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ord, text, label: surfaces with dropped, shouted, cut and relabelled ones, and spurious rows."""
    s = surfaces(spark, sf_dir).where("n % 7 <> 0")
    text = F.when(F.col("n") % 3 == 0, F.upper("text")).otherwise(F.col("text"))
    text = F.when(F.col("n") % 5 == 0, F.regexp_replace(text, r"\s+\S+$", "")).otherwise(text)
    label = F.when(F.col("n") % 11 == 0, "Organisation").when(F.col("label") == "PERSON", "Person").when(F.col("label") == "ORG", "Organization").otherwise(F.initcap("label"))
    rows = s.select("doc_id", "ord", text.alias("text"), label.alias("label"))
    spurious = surfaces(spark, sf_dir).where("n % 130 = 0").select("doc_id", (F.col("ord") + 9).alias("ord"), F.concat(F.lit("Spurious "), F.col("okey").cast("string")).alias("text"), F.lit("Person").alias("label"))
    return rows.unionByName(spurious)


PREDICTIONS = GROUNDTRUTH + r""",
up AS (SELECT *, CASE WHEN n % 3 = 0 THEN upper(text) ELSE text END AS t1 FROM surf WHERE n % 7 <> 0),
pred AS (
  SELECT doc_id, ord, CASE WHEN n % 5 = 0 THEN regexp_replace(t1, '\s+\S+$', '') ELSE t1 END AS text,
    CASE WHEN n % 11 = 0 THEN 'Organisation' WHEN label = 'PERSON' THEN 'Person' WHEN label = 'ORG' THEN 'Organization' WHEN label = 'DATE' THEN 'Date' ELSE 'Amount' END AS label
  FROM up
  UNION ALL SELECT doc_id, ord + 9, 'Spurious ' || okey, 'Person' FROM surf WHERE n % 130 = 0),
gtk AS (SELECT *, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS k FROM gt),
predk AS (
  SELECT doc_id, ord, text, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS k,
    upper(CASE label WHEN 'Person' THEN 'PERSON' WHEN 'Organization' THEN 'ORG' WHEN 'Organisation' THEN 'ORG' ELSE label END) AS label
  FROM pred)"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: three quarters of a case's surfaces, some with other case and spacing, in order."""
    s = surfaces(spark, sf_dir).where("okey % 4 <> 0")
    text = F.when(F.col("n") % 3 == 0, F.upper(F.replace(F.col("text"), F.lit(" "), F.lit("  ")))).otherwise(F.col("text"))
    said = F.array_sort(F.collect_list(F.struct("ord", text.alias("t"))))
    return s.groupBy("doc_id").agg(F.array_join(F.transform(said, lambda x: x["t"]), "; ").alias("text"))


DOCUMENTS = PREDICTIONS + """,
docs AS (
  SELECT doc_id, string_agg(CASE WHEN n % 3 = 0 THEN upper(replace(text, ' ', '  ')) ELSE text END, '; ' ORDER BY ord) AS text
  FROM surf WHERE okey % 4 <> 0 GROUP BY doc_id)"""


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded calls from events."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(F.col("event_id").alias("ord"), F.concat(F.lit("writer_s"), (F.col("user_id") % 7).cast("string"), F.lit("_r"), (k % 3).cast("string"), F.lit("_chunk_"), (k % 5).cast("string")).alias("task_id"), F.nullif(F.col("event_type"), F.lit("view")).alias("stage"), F.concat(F.lit("s"), (F.col("user_id") % 7).cast("string")).alias("section_name"), (k % 3).alias("revision_round"), F.floor(F.col("value") * 1000).cast("bigint").alias("latency_ms"), F.when(k % 4 != 0, k).alias("tokens_prompt"), (k * 2).alias("tokens_response"), (k == 0).alias("response_empty"), F.when(F.col("event_type") == "error", "length").otherwise("stop").alias("done_reason"), (k % 50 == 7).alias("error"), F.col("user_id"), F.col("ts"))


CALLS = """
calls AS (
  SELECT event_id AS ord, 'writer_s' || (user_id % 7) || '_r' || (k % 3) || '_chunk_' || (k % 5) AS task_id, nullif(event_type, 'view') AS stage, 's' || (user_id % 7) AS section_name,
    k % 3 AS revision_round, floor(value * 1000)::BIGINT AS latency_ms, CASE WHEN k % 4 <> 0 THEN k END AS tokens_prompt, k * 2 AS tokens_response, k = 0 AS response_empty,
    CASE WHEN event_type = 'error' THEN 'length' ELSE 'stop' END AS done_reason, k % 50 = 7 AS error, user_id, ts
  FROM (SELECT *, (props::JSON->>'k')::BIGINT AS k FROM events))"""


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section artifacts from conversations: doc_id, section, revision, text."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").cast("string").alias("doc_id"), F.col("role").alias("section"), F.col("turn").alias("revision"), "text")


def parties(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Sides of a case for each nation: customers and suppliers in order, numbered from 0 within their document."""
    def numbered(frame: DataFrame, key: str, name: str, nation: str, remainder: int) -> DataFrame:
        rows = frame.where(F.col(key) % 2 == remainder).select(F.concat(F.lit("en_nation_"), F.col(nation).cast("string"), F.lit("_"), F.floor(F.col(key) / 1000).cast("string")).alias("doc_id"), F.col(key).alias("key"), F.col(name).alias("name"))
        return rows.select("doc_id", "name", (F.row_number().over(Window.partitionBy("doc_id").orderBy("key")) - 1).cast("bigint").alias("ord"))

    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return {
        "defendants": numbered(customer, "c_custkey", "c_name", "c_nationkey", 0),
        "collateral": numbered(customer, "c_custkey", "c_name", "c_nationkey", 1),
        "charged": numbered(supplier, "s_suppkey", "s_name", "s_nationkey", 0),
        "associated": numbered(supplier, "s_suppkey", "s_name", "s_nationkey", 1),
    }


def _side(name: str, source: str, key: str, text: str, nation: str, remainder: int) -> str:
    return f"""
{name} AS (
  SELECT 'en_nation_' || {nation} || '_' || ({key} // 1000) AS doc_id, {text} AS name, row_number() OVER (PARTITION BY 'en_nation_' || {nation} || '_' || ({key} // 1000) ORDER BY {key}) - 1 AS ord
  FROM {source} WHERE {key} % 2 = {remainder})"""


PARTIES = ",".join(
    [
        _side("defendants", "customer", "c_custkey", "c_name", "c_nationkey", 0),
        _side("collateral", "customer", "c_custkey", "c_name", "c_nationkey", 1),
        _side("charged", "supplier", "s_suppkey", "s_name", "s_nationkey", 0),
        _side("associated", "supplier", "s_suppkey", "s_name", "s_nationkey", 1),
    ]
)
