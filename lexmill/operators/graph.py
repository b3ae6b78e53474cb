"""Entity graphs of cases, derived amounts and the case memory text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nodes(persons: DataFrame, orgs: DataFrame) -> DataFrame:
    """(doc_id, id, name, type): p1.. for persons, o1.. for organisations, numbered in order within their document."""
    def numbered(frame: DataFrame, prefix: str, kind: str) -> DataFrame:
        n = F.row_number().over(Window.partitionBy("doc_id").orderBy("ord"))
        return frame.select("doc_id", F.concat(F.lit(prefix), n.cast("string")).alias("id"), "name", F.lit(kind).alias("type"))

    return numbered(persons, "p", "person").unionByName(numbered(orgs, "o", "organisation"))


def edges(defendants: DataFrame, collateral: DataFrame, charged: DataFrame, associated: DataFrame) -> DataFrame:
    """(doc_id, src, dst, type, label). Each input has doc_id, ord (from 0, without gaps) and name.

    controlled: defendant i and charged organisation i modulo their number; instructed: the first defendant and each
    collateral person; conspired_with: neighbouring defendants; received_funds_from: charged organisation i and
    associated organisation i modulo their number. A document without the other side has no edge of that type.
    """
    def wheel(left: DataFrame, right: DataFrame, kind: str, label) -> DataFrame:
        many = right.groupBy("doc_id").agg(F.count("*").alias("n"))
        spoke = left.join(many, "doc_id").select("doc_id", F.col("name").alias("src"), F.pmod("ord", "n").alias("j"))
        rim = right.select("doc_id", F.col("ord").alias("j"), F.col("name").alias("dst"))
        return spoke.join(rim, ["doc_id", "j"]).select("doc_id", "src", "dst", F.lit(kind).alias("type"), label.alias("label"))

    first = defendants.where("ord = 0").select("doc_id", F.col("name").alias("src"))
    ahead = defendants.withColumn("dst", F.lead("name").over(Window.partitionBy("doc_id").orderBy("ord"))).where("dst is not null")
    said = lambda verb: F.concat("src", F.lit(verb), "dst")
    parts = [
        wheel(defendants, charged, "controlled", said(" controlled ")),
        first.join(collateral.select("doc_id", F.col("name").alias("dst")), "doc_id").select("doc_id", "src", "dst", F.lit("instructed").alias("type"), said(" instructed ").alias("label")),
        ahead.select("doc_id", F.col("name").alias("src"), "dst", F.lit("conspired_with").alias("type"), F.concat("name", F.lit(" conspired with "), "dst").alias("label")),
        wheel(charged, associated, "received_funds_from", F.concat("dst", F.lit(" received funds from "), "src")),
    ]
    return reduce(DataFrame.unionByName, parts)


def transfers(charged: DataFrame, associated: DataFrame, step: int = 25_000) -> DataFrame:
    """(doc_id, from_org, to_org, amount): charged organisation i pays associated organisation i modulo their number."""
    many = associated.groupBy("doc_id").agg(F.count("*").alias("n"))
    payer = charged.join(many, "doc_id").select("doc_id", "ord", F.col("name").alias("from_org"), F.pmod("ord", "n").alias("j"))
    payee = associated.select("doc_id", F.col("ord").alias("j"), F.col("name").alias("to_org"))
    return payer.join(payee, ["doc_id", "j"]).select("doc_id", "from_org", "to_org", ((F.col("ord") + 1) * step).cast("bigint").alias("amount"))


def memory_text(blocks: DataFrame) -> DataFrame:
    """(doc_id, memory_text) from (doc_id, block_ord, heading, ord, line); a block without lines says ``- none``."""
    lines = F.transform(F.filter(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda x: x["line"].isNotNull()), lambda x: F.concat(F.lit("- "), x["line"]))
    one = blocks.groupBy("doc_id", "block_ord", "heading").agg(lines.alias("lines"))
    body = F.concat(F.lit("## "), F.col("heading"), F.lit("\n"), F.when(F.size("lines") == 0, F.lit("- none")).otherwise(F.array_join("lines", "\n")))
    return one.withColumn("body", body).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_ord", "body"))), lambda x: x["body"]), "\n\n").alias("memory_text"))


def render_document(sections: DataFrame, labels: dict[str, str]) -> DataFrame:
    """(doc_id, text) from (doc_id, ord, section, text): labelled sections in order."""
    named = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]) if labels else F.create_map()
    title = F.coalesce(F.try_element_at(named, F.col("section")) if labels else F.lit(None), F.col("section"))
    parts = F.array_sort(F.collect_list(F.struct("ord", F.concat(title, F.lit("\n\n"), "text").alias("t"))))
    return sections.groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda p: p["t"]), "\n\n").alias("text"))


def normalise_schema(configured: DataFrame, persons: DataFrame, orgs: DataFrame) -> DataFrame:
    """(doc_id, persons, orgs, edges): the configured lists, or where a document has none the derived nodes; no edges is an empty list."""
    node = "array<struct<id:string,name:string,type:string>>"
    derived = nodes(persons, orgs)
    of = lambda kind: F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.struct(F.length("id").alias("l"), "id", "name", "type"))))
    plain = lambda c: F.transform(c, lambda n: F.struct(n["id"].alias("id"), n["name"].alias("name"), n["type"].alias("type")))
    own = derived.groupBy("doc_id").agg(plain(of("person")).alias("_p"), plain(of("organisation")).alias("_o"))
    both = configured.join(own, "doc_id", "left")
    empty = F.array().cast(node)
    edges_kind = "array<struct<src:string,dst:string,type:string>>"
    return both.select("doc_id", F.coalesce("persons", "_p", empty).alias("persons"), F.coalesce("orgs", "_o", empty).alias("orgs"), F.coalesce("edges", F.array().cast(edges_kind)).alias("edges"))
