from pyspark.sql import functions as F

from lexmill.llm import _shared


def test_recent_is_bounded_and_keeps_what_is_used():
    made = []
    kept = _shared.Recent(lambda k: made.append(k) or k * 2, "one", 10)
    for i in range(1000):
        assert kept[i] == 2 * i and kept[7] == 14
        assert len(kept) <= 10 and len(kept.old) <= 10
    assert made.count(7) == 1


def test_worker_empties_dictionaries_of_other_operators():
    mine, other = _shared.Recent(str, "a"), _shared.Recent(str, "b")
    assert mine[1] == other[1] == "1"
    assert list(_shared.worker("a", lambda batches: (x + 1 for x in batches))([1, 2])) == [2, 3]
    assert len(mine) == 1 and len(other) == 0


def test_small_batches_only_lower_the_setting(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "50")
    _shared.small_batches(spark)
    assert spark.conf.get(key) == "50"
    spark.conf.set(key, "100000")
    _shared.small_batches(spark)
    assert spark.conf.get(key) == "2000"
    spark.conf.set(key, before)


def test_hashed_sample_is_bounded_and_the_same(spark):
    rows = spark.range(5000).withColumnRenamed("id", "doc_id").withColumn("doc_id", F.when(F.col("doc_id") % 7 > 0, F.col("doc_id")))
    first = _shared.hashed_sample(rows.union(rows), "doc_id", 100, 3)
    assert len(first) == len(set(first)) == 100 and None not in first
    assert first == _shared.hashed_sample(rows.repartition(7), "doc_id", 100, 3)
    assert len(_shared.hashed_sample(rows.limit(10), "doc_id", 100, 3)) == rows.limit(10).where("doc_id is not null").count()


def test_folds(spark):
    import zlib

    rows = spark.createDataFrame([(i,) for i in (0, 7, 123456789, -1)] + [(None,)], "doc_id long")
    got = {r.doc_id: r.f for r in rows.select("doc_id", _shared.fold_of("doc_id", 4).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 for i in (0, 7, 123456789, -1)} | {None: None}


def test_scratch_tables_are_in_the_shared_folder(spark):
    scratch = _shared.Scratch(spark)
    kept = scratch.keep(spark.range(5))
    assert kept.count() == 5 and kept._lexmill_path.startswith(spark.conf.get("spark.checkpoint.dir"))
    scratch.drop(kept)
    import os

    assert not os.path.exists(kept._lexmill_path.removeprefix("file://"))
