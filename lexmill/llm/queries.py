"""The registered ``opN_*`` queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import best_fit_packing, block_search, chat_format, crf_language, html_extraction, hyperminhash, pu_quality, simhash_decontamination, toxic_grammar, url_filter
from ._shared import fold_of, table

URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


def vocabulary_path() -> str:
    """The default vocabulary file; it is only ever read where the tokenizers are installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def held_out(parts: int, fold: int):
    """Whether the row's fold is the one that nothing is learned from; false for a null id."""
    return F.coalesce(fold_of("doc_id", parts) == fold, F.lit(False))


def language_model(spark: SparkSession, sf_dir: str):
    documents = table(spark, sf_dir, "documents")
    return crf_language.train(documents.where(fold_of("doc_id", 4) != 2))


def op1_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_model(spark, sf_dir)
    out = crf_language.identify(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return out.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op5_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item found in it."""
    marked = simhash_decontamination.mark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.explode("contamination").alias("c")).select("doc_id", F.col("c.item").alias("item_id"), F.col("c.start").alias("first_word"), F.col("c.words").alias("n_words"), F.col("c.similarity").alias("similarity"))


def toxic_model(spark: SparkSession, sf_dir: str):
    labels = table(spark, sf_dir, "labels").where(fold_of("doc_id", 4) != 2)
    return toxic_grammar.train(table(spark, sf_dir, "documents"), labels)


def op6_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxic_grammar.score(table(spark, sf_dir, "documents").select("doc_id", "text"), toxic_model(spark, sf_dir))
    return out.select("doc_id", held_out(4, 2).alias("held_out"), F.col("toxic_score").alias("score"), F.col("toxic_flag").cast("int").alias("predicted"))


def op7_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return block_search.search(vectors.where("vec_id % 20 = 0"), vectors)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(table(spark, sf_dir, "documents"), vocabulary_path())


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    out = chat_format.format_conversations(rows.unionByName(planted))
    out = out.withColumn("turns", chat_format.read_turns(F.col("formatted")))
    out = out.withColumn("loss", F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat_format.unescape(s["text"])), ""))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        digest(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        digest(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def quality_model(spark: SparkSession, sf_dir: str):
    """Trusted positives are the labelled ones, the unlabelled are all documents; neither from the held-out fold."""
    documents = table(spark, sf_dir, "documents").where(fold_of("doc_id", 5) != 0)
    positives = table(spark, sf_dir, "labels").where((fold_of("doc_id", 5) != 0) & (F.col("quality") == 1))
    return pu_quality.train(documents, positives, documents)


def op10_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality_model(spark, sf_dir)
    out = pu_quality.score(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return out.select("doc_id", held_out(5, 0).alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_kept").cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_crf_language, op2_url_filter, op3_hyperminhash, op4_html_extraction, op5_simhash_decontamination, op6_toxic_grammar, op7_block_search, op8_best_fit_packing, op9_chat_format, op10_pu_quality)
}
