"""From raw documents to packed sequences: quality, language, near-duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared folder and
reads it again as the next stage's docs. All stages but the last return the columns of ``documents``, whatever they are
called: columns with the name of an operator's own pass through untouched. No stage orders, drops or merges rows but as
it says; an empty table gives an empty table in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import best_fit_packing, crf_language, hyperminhash, pu_quality, queries, simhash_decontamination
from lexmill.llm._shared import Scratch, fold_of, table

#: A document goes if words of no learned language hold this share of its words' posterior mass, and are the most.
LEAST_OTHER = 0.5


def _plain(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with columns named by their numbers, so that none clashes with an operator's, and its id and text."""
    return docs.toDF(*[f"_{n}" for n in range(len(docs.columns))]), f"_{docs.columns.index('doc_id')}", f"_{docs.columns.index('text')}"


def _back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[f"_{n}" for n in range(len(docs.columns))]).toDF(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the training fold of the labels, doesn't reject.

    A null text is judged as an empty one, by its measures like any other; a very long text is judged whole; rows with a
    null id are judged but not learned from; repeated rows are judged alike, and a repeated id is learned from once;
    without labels every score is 0.5 and all documents stay.
    """
    plain, key, text = _plain(docs)
    known = plain.where(fold_of(key, 5) != 0)
    positives = table(spark, sf_dir, "labels").where((fold_of("doc_id", 5) != 0) & (F.col("quality") == 1)).select(F.col("doc_id").alias(key))
    model = pu_quality.train(known, positives, known, id_column=key, text_column=text)
    return _back(pu_quality.score(plain, model, id_column=key, text_column=text).where("quality_kept"), docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the languages of the table, learned beside letter noise; others go.

    Null texts and texts without a letter go, as they are in no language; code-switched texts stay; a tie goes to the
    label first in order; a very long text is one chain; rows with a null id are judged but not learned from; repeated
    rows are judged alike; if no row has a language, nothing can be learned and every document goes.
    """
    plain, key, text = _plain(docs)
    lang = f"_{docs.columns.index('lang')}"
    model = crf_language.train(plain.where(fold_of(key, 4) != 2), other=0.25, id_column=key, text_column=text, lang_column=lang)
    out = crf_language.identify(plain, model, text_column=text)
    gone = (F.col("lang_pred") == crf_language.UNKNOWN) | (F.col("lang_pred") == crf_language.OTHER) & (F.col("lang_score") >= LEAST_OTHER)
    return _back(out.where(~gone), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, most_broadcast: int = 1_000_000) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id.

    Documents without words are linked with nothing and stay, as do rows with a null id. If ids are repeated, rows are
    told apart by numbers that are written with them: of a group's rows with the smallest id the first row stays, and an
    id's other texts stay or go with their own groups.
    """
    plain, key, text = _plain(docs)
    scratch = Scratch(spark)
    known = plain.where(F.col(key).isNotNull())
    if known.groupBy(key).count().where("count > 1").take(1):
        plain = scratch.keep(plain.withColumn("_row", F.monotonically_increasing_id()))
        known = plain.where(F.col(key).isNotNull())
        found = hyperminhash.near_duplicates(known, id_column="_row", text_column=text)
        rows = found.select(F.col("doc_id").alias("_row"), "component_id").join(known.select("_row", F.col(key).alias("id")), "_row")
        first = rows.groupBy("component_id").agg(F.min(F.struct("id", "_row")).alias("first")).select(F.col("first._row").alias("stays"))
        gone, by = rows.join(first, F.col("_row") == F.col("stays"), "left_anti").select("_row"), "_row"
    else:
        found = hyperminhash.near_duplicates(known, id_column=key, text_column=text)
        gone, by = found.where("not kept").select(F.col("doc_id").alias(key)), key
    gone = scratch.keep(gone)
    side = F.broadcast(gone) if gone.count() <= most_broadcast else gone
    return _back(plain.join(side, by, "left_anti"), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and wordless texts match nothing and stay; a very long text is searched whole; repeated rows are judged alike,
    whatever their ids; an empty benchmark leaves all documents.
    """
    plain, _, text = _plain(docs)
    out = simhash_decontamination.mark(plain, table(spark, sf_dir, "benchmark"), text_column=text)
    return _back(out.where(F.size("contamination") == 0), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the training sequences.

    A null text is packed as an empty one, its terminator alone; only a text longer than a sequence is cut, and none is
    dropped; null ids stay null; repeated rows are packed as often as they occur; the other columns are left behind.
    """
    return best_fit_packing.pack(docs, queries.vocabulary_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: SQL can't express the learned stages or the tokenizer; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for _, stage in STAGES:
        before, docs = docs, scratch.keep(stage(spark, docs, sf_dir))
        if hasattr(before, "_lexmill_path"):
            scratch.drop(before)
    return docs
