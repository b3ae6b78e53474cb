"""Helpers that several operators share: scratch tables, bounded samples, repeated-id handling."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Recent(dict):
    """A dictionary that makes what it misses and holds at most twice ``most`` entries, the recently used ones.

    It belongs to an operator: when a worker turns to another one, it is emptied.
    """

    every: list[weakref.ref] = []

    def __init__(self, make, owner: str, most: int = 100_000):
        super().__init__()
        self.make, self.owner, self.most, self.old = make, owner, most, {}
        Recent.every = [r for r in Recent.every if r() is not None] + [weakref.ref(self)]

    def __missing__(self, key):
        found = self.old.get(key)
        return self.add(key, self.make(key) if found is None else found)

    def add(self, key, value):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _give_back() -> None:
    """Return freed memory to the system: workers live on between tasks, and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def worker(owner: str, run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` as a function of a partition's Arrow batches that leaves little behind in its worker."""

    def whole(batches: Iterator) -> Iterator:
        for reference in Recent.every:
            other = reference()
            if other is not None and other.owner != owner:
                other.clear()
                other.old = {}
        try:
            yield from run(batches)
        finally:
            _give_back()

    return whole


def small_batches(spark: SparkSession, rows: int = 2000, megabytes: int = 8) -> None:
    """Arrow batches of the session get no larger than this: texts are long, and two tasks hold several batches each."""
    size_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most, number in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows, int), ("spark.sql.execution.arrow.maxBytesPerBatch", megabytes << 20, size_of)):
        now = number(spark.conf.get(key))
        if now > most or now <= 0:
            spark.conf.set(key, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path is only ever opened by Spark's readers."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Where the session names none, a temporary folder is made and set if all of Spark runs on this machine, as in tests;
    on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="lexmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """Tables written to the shared folder to cut lineage; ``drop`` removes those no longer read."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/lexmill-{uuid.uuid4().hex}"
        self.count = 0
        self.kept: list[DataFrame] = []

    def keep(self, frame: DataFrame) -> DataFrame:
        """Write ``frame`` and return it as read back, with a lineage of one scan."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        schema = frame.schema
        frame.write.parquet(path)
        back = self.spark.read.schema(schema).parquet(path)
        self.kept.append(back)
        back._lexmill_path = path
        return back

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark._jvm
        for frame in frames:
            path = jvm.org.apache.hadoop.fs.Path(frame._lexmill_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self.kept = [k for k in self.kept if k is not frame]

    def drop_others(self, *needed: DataFrame) -> None:
        """Remove all tables but those ``needed``."""
        self.drop(*[k for k in self.kept if not any(k is n for n in needed)])


def fold_of(column: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(parts)


def hashed_sample(frame: DataFrame, key: str, most: int, seed: int) -> list:
    """At most ``most`` distinct non-null ids of ``frame``, those of the smallest hash: the same ids on every run.

    A filter on the hash keeps about twice as many before anything is shuffled or ordered; only the ids, and no more
    than ``most`` of them, reach the driver.
    """
    ids = frame.where(F.col(key).isNotNull()).select(key)
    rows = ids.count()
    ids = ids.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key)))
    if rows > 4 * most:
        ids = ids.where(F.col("_h") < F.lit(int(-(2**63) + 2**64 * (2.0 * most / rows))))
    return [row[0] for row in ids.groupBy(key).agg(F.min("_h").alias("_h")).orderBy("_h", key).limit(most).collect()]


def texts_of(documents: DataFrame, ids: list, id_column: str, text_column: str) -> DataFrame:
    """(id, text) of the documents with one of the listed ids, whose number the caller has bounded."""
    kind = documents.schema[id_column].dataType.simpleString()
    wanted = documents.sparkSession.createDataFrame([(i,) for i in ids], f"`{id_column}` {kind}")
    return documents.select(id_column, text_column).join(F.broadcast(wanted), id_column, "left_semi")
