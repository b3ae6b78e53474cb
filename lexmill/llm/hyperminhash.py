"""Near-duplicate classes by HyperMinHash registers.

Every document's set of word shingles is summarised by ``bands * rows`` registers. The hash space is cut into as many
buckets; a bucket's register is the number of leading zeros and ten mantissa bits of the smallest hash that falls into
it. Buckets that stay empty borrow the register of another one, the first filled one in an order of their own, so
that two sets agree on a register with the probability of their Jaccard similarity, however small they are. Then:

1. Documents with the same set, told by a 128-bit hash of it, form a class. A class is known by the number of its first
   row, not by an id, so that rows of one id may have different texts.
2. Classes that agree on all registers of a band meet there. Each is paired with the band's first class only.
3. A pair whose Jaccard estimate, corrected for chance collisions of registers, lies within five standard errors of
   the threshold is verified on the full sets. Verified links are joined to components. In bands that still hold
   several, the classes of other components are paired with a class that each band draws by chance, in turns, until
   fewer than one of 200 pairs of a turn are links.
4. What is left are pairs of different components in bands of three and more. They are found exactly, whatever the size
   of the band: two sets of the similarity share one of their rarest shingles (as many as they may miss, and one more).
   Classes of one component are never compared, and a pair is looked at where it shares its rarest shingle, if what can
   follow it still reaches the similarity. Shingles that many classes have are dealt to several tasks. The pairs found
   take the way of step 3.

With five rows and fifty bands a pair at the threshold of 0.75 is missed with a probability of about 2e-5 (simulated
for unions of 4 to 4000 shingles), and less above.

Defined results: null or blank texts have an empty set and are linked with nothing; rows with the same set are linked;
ties do not arise (components have the smallest id); a row without an id has no component and is kept; columns other
than id and text are ignored; no rows give no rows. Links, components and sets never reach the driver. What is written
to the shared folder is removed, but for the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch, small_batches, worker
from .shingles import shingle_sets

MANTISSA = 10
#: Expected share of registers that agree by chance, for sets of one size, from the published analysis of the sketch.
_CHANCE = 0.169919487159739 / (1 << MANTISSA)


def compress(smallest: np.ndarray) -> np.ndarray:
    """16-bit registers of 32-bit minima: leading zeros above, mantissa bits below."""
    value = smallest.astype(np.uint64)
    _, exponent = np.frexp(value.astype(np.float64))  # exact: 32 bits fit a double
    zeros = np.where(value == 0, 32, 32 - exponent).astype(np.uint64)
    aligned = (value << (zeros + np.uint64(1))) & np.uint64(0xFFFFFFFF)
    return ((zeros << np.uint64(MANTISSA)) | (aligned >> np.uint64(32 - MANTISSA))).astype(np.uint16)


class Buckets:
    """``count`` equal parts of the 64-bit hash space, and for each the order in which it borrows from the others."""

    def __init__(self, count: int, seed: int = 2016):
        self.count = count
        self.edges = np.array([i * (1 << 64) // count for i in range(count)], np.uint64)
        self.rank = np.argsort(np.random.default_rng(seed).random((count, count)), axis=1).astype(np.int16)

    def registers(self, hashes: np.ndarray) -> np.ndarray:
        """A register for each bucket, of the sorted hashes of a set that isn't empty."""
        at = np.append(np.searchsorted(hashes, self.edges), len(hashes))
        full = at[1:] > at[:-1]
        filled = np.flatnonzero(full)
        inside = (hashes[at[filled]] - self.edges[filled]) >> np.uint64(32)
        found = np.empty(self.count, np.uint16)
        found[filled] = compress(np.minimum(inside * np.uint64(self.count), np.uint64(0xFFFFFFFF)))
        if len(filled) < self.count:
            empty = np.flatnonzero(~full)
            found[empty] = found[filled[self.rank[np.ix_(empty, filled)].argmin(axis=1)]]
        return found


def estimate(equal_share: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, less the share that agrees by chance."""
    ratio = sizes_a / sizes_b
    chance = _CHANCE * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(0.0, (equal_share - chance) / (1 - chance))


def sketch(documents: DataFrame, count: int, size: int, id_column: str, text_column: str) -> DataFrame:
    """doc_id, n_shingles, set_hash and registers (null for an empty set) of every row."""
    kind = documents.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(count)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sizes, names, regs = [], [], []
                for hashes in shingle_sets(batch.column(1), size):
                    sizes.append(len(hashes))
                    names.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                    regs.append(buckets.registers(hashes).tobytes() if len(hashes) else None)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(regs, pa.binary())], names=["doc_id", "n_shingles", "set_hash", "registers"])

    return documents.select(F.col(id_column), F.col(text_column)).mapInArrow(worker("shingles", run), f"doc_id {kind}, n_shingles bigint, set_hash binary, registers binary")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): alternating large-star and small-star until nothing moves."""
    edges = scratch.keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = scratch.keep(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("m").alias("v"), F.col("v").alias("u"))
        new = scratch.keep(small.unionByName(low.select(F.col("m").alias("v"), "u")).distinct())
        state = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        scratch.drop(edges, large)
        edges = new
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    found = scratch.keep(edges.select("u", "v").unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component")))
    scratch.drop(edges)
    return found


class _Pairs:
    """Estimates and verifies pairs (a, b) of classes."""

    def __init__(self, documents: DataFrame, classes: DataFrame, scratch: Scratch, threshold: int, size: int, id_column: str, text_column: str, most_broadcast: int):
        self.documents = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
        self.classes, self.scratch, self.threshold, self.size, self.most_broadcast = classes, scratch, threshold, size, most_broadcast

    def small(self, side: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(side) if rows <= self.most_broadcast else side

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        """(node, s): the shingle sets of the listed classes, read again from the texts of their first rows."""
        wanted = self.scratch.keep(self.classes.join(self.small(nodes, nodes.count()), "node", "left_semi").select("node", "doc_id", "set_hash"))
        rows, size = wanted.count(), self.size
        texts = self.documents.join(self.small(wanted.select("doc_id").distinct(), rows), "doc_id", "left_semi").select("text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    sets = shingle_sets(whole.slice(at, 256).column(0), size)
                    names = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                    yield pa.RecordBatch.from_arrays([names, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["set_hash", "s"])

        sets = texts.mapInArrow(worker("shingles", run), "set_hash binary, s array<bigint>")
        return sets.join(self.small(wanted.select("node", "set_hash"), rows), "set_hash").dropDuplicates(["node"]).select("node", "s")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose estimate does not lie five standard errors below the threshold.

        A set of fewer shingles than registers gives no more independent ones than it has shingles.
        """
        threshold = self.threshold / 100
        side = lambda s: self.classes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n{s}"), F.col("registers").alias(f"r{s}"))
        joined = pairs.join(side("a"), "a").join(side("b"), "b").where(f"100 * least(na, nb) >= {self.threshold} * greatest(na, nb)").select("a", "b", "na", "nb", "ra", "rb")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in (4, 5))
                na, nb = (batch.column(c).to_numpy().astype(float) for c in (2, 3))
                error = (threshold * (1 - threshold) / np.minimum(x.shape[1], np.minimum(na, nb))) ** 0.5
                keep = estimate((x == y).mean(axis=1), na, nb) >= threshold - 5 * error
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

        return joined.mapInArrow(worker("shingles", run), "a bigint, b bigint")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Likely pairs whose full sets have 100 * intersection >= ``threshold`` * union, written."""
        likely = self.scratch.keep(self.likely(pairs))
        nodes = self.scratch.keep(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct())  # counted and joined
        sets = self.sets_of(nodes)
        joined = likely.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
        shared = F.size(F.array_intersect("sa", "sb"))
        links = self.scratch.keep(joined.where((100 + self.threshold) * shared >= self.threshold * (F.size("sa") + F.size("sb"))).select("a", "b"))
        self.scratch.drop(likely, nodes)
        return links

    def across(self, labelled: DataFrame, most_alone: int) -> DataFrame:
        """Pairs of classes (node, component) of different components that may have the similarity: none is left out.

        A shingle of more than ``most_alone`` classes is dealt to several tasks.
        """
        tokens = self.sets_of(labelled.select("node")).select("node", F.size("s").alias("n"), F.explode("s").alias("token"))
        tokens = self.scratch.keep(tokens)
        counts = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
        # a set's shingles in the order of rarity; those that no other set has come first, and need not be listed
        sets = tokens.join(counts, "token").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("common"))
        alone = F.col("n") - F.size("common")
        length = F.floor(F.col("n") * (100 - self.threshold) / 100).cast("int") + 1 - alone  # a link keeps threshold % of each set
        prefix = sets.where(length > 0).select("node", "n", F.posexplode(F.slice("common", F.lit(1), length)).alias("at", "t"), alone.alias("alone"))
        prefix = prefix.select("node", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("left"), "t.df", "t.token").join(labelled, "node")
        prefix = self.scratch.keep(prefix)
        # of one shingle's classes, those of the most frequent component are compared with the others only
        sizes = prefix.groupBy("token", "component").agg(F.count("*").alias("size"))
        mains = sizes.groupBy("token").agg(F.count("*").alias("several"), F.max_by("component", "size").alias("main")).where("several > 1").select("token", "main")
        mixed = prefix.join(mains, "token").withColumn("parts", F.ceil(F.col("df") / most_alone).cast("int"))
        x = mixed.where("component <> main").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        x = x.select("token", "part", *[F.col(c).alias(f"x_{c}") for c in ("node", "component", "n", "left")])
        y = mixed.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).select("token", "part", (F.col("component") == F.col("main")).alias("inside"), *[F.col(c).alias(f"y_{c}") for c in ("node", "component", "n", "left")])
        reaches = (100 + self.threshold) * F.least("x_left", "y_left") >= self.threshold * (F.col("x_n") + F.col("y_n"))
        here = (x["token"] == y["token"]) & (x["part"] == y["part"]) & (F.col("x_component") != F.col("y_component")) & (F.col("inside") | (F.col("x_node") < F.col("y_node"))) & reaches
        pairs = x.join(y, here).select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
        pairs = self.scratch.keep(pairs)
        self.scratch.drop(tokens, prefix)
        return pairs


def _mixed(members: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """(band, node, component) of the bands that hold several components."""
    labelled = scratch.keep(members.join(found, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component")))
    mixed = labelled.groupBy("band").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select("band")
    kept = scratch.keep(labelled.join(mixed, "band"))
    scratch.drop(labelled)
    return kept


def _merged(found: DataFrame, labelled: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``found`` with the components joined that ``links`` connects."""
    if not links.take(1):
        return found
    of = labelled.select("node", "component").distinct()
    side = lambda s: of.select(F.col("node").alias(s), F.col("component").alias(f"c{s}"))
    joined = components(links.join(side("a"), "a").join(side("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")), scratch)
    every = found.unionByName(joined.select("node", F.col("node").alias("component"))).distinct()
    moved = every.join(joined.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    moved = scratch.keep(moved.select("node", F.coalesce("to", "component").alias("component")))
    scratch.drop(found, joined, links)
    return moved


def near_duplicates(documents: DataFrame, threshold: int = 75, size: int = 5, rows: int = 5, bands: int = 50, id_column: str = "doc_id", text_column: str = "text", most_broadcast: int = 1_000_000, most_alone: int = 1000) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row. ``threshold`` is the Jaccard similarity in hundredths."""
    small_batches(documents.sparkSession)
    scratch = Scratch(documents.sparkSession)
    found_rows = scratch.keep(sketch(documents, rows * bands, size, id_column, text_column).withColumn("node", F.monotonically_increasing_id()))
    firsts = found_rows.where("set_hash is not null and doc_id is not null").groupBy("set_hash").agg(F.min("node").alias("node"), F.min("doc_id").alias("smallest"))
    classes = scratch.keep(found_rows.join(firsts.select("node", "smallest"), "node").select("node", "doc_id", "smallest", "n_shingles", "set_hash", "registers"))
    table = scratch.keep(found_rows.select("doc_id", "n_shingles", "set_hash"))
    scratch.drop(found_rows)
    pairs = _Pairs(documents, classes, scratch, threshold, size, id_column, text_column, most_broadcast)

    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(b, F.substring(F.col("registers"), b * (2 * rows) + 1, F.lit(2 * rows))))
    members = classes.select("node", F.explode(keys).alias("band"))
    met = members.groupBy("band").agg(F.min("node").alias("centre"), F.count("*").alias("members")).where("members > 1")
    # members of bands of two and more; the rest are never looked at again
    shared = scratch.keep(members.join(met, "band"))
    links = pairs.verified(shared.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())
    found = components(links, scratch)
    scratch.drop(links)

    # bands of three and more with several components; a pair of two has been looked at
    crowded = scratch.keep(shared.where("members > 2").select("band", "node"))
    scratch.drop(shared)
    labelled = _mixed(crowded, found, scratch)
    # other classes of each band, by chance, for those that are not like the first one, while that links many of them
    turn = 0
    while labelled.take(1):
        turn += 1
        centres = labelled.groupBy("band").agg(F.max_by(F.struct("node", "component"), F.xxhash64(F.lit(turn), "band", "node")).alias("centre"))
        stars = labelled.join(centres, "band").where("component <> centre.component").select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b"))
        stars = scratch.keep(stars.distinct())
        links = pairs.verified(stars)
        few = 200 * links.count() < stars.count()
        found = _merged(found, labelled, links, scratch)
        scratch.drop(labelled, stars)
        labelled = _mixed(crowded, found, scratch)
        if few:
            break
    rest = scratch.keep(labelled.select("node", "component").distinct())
    found = _merged(found, rest, pairs.verified(pairs.across(rest, most_alone)), scratch)

    ids = classes.select("node", "set_hash", "smallest").join(found, "node", "left").select("set_hash", "smallest", F.coalesce("component", "node").alias("component"))
    names = ids.groupBy("component").agg(F.min("smallest").alias("c"))
    placed = ids.join(names, "component").select("set_hash", "c")
    out = table.join(placed, "set_hash", "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id")).alias("component_id"))
    out = scratch.keep(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
    scratch.drop_others(out)
    return out
