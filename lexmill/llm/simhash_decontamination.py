"""Benchmark decontamination: SimHash of item-sized windows, a multi-index, and an exact weighted similarity.

Words are white-space tokens in lower case with everything but letters and digits taken out, so case and punctuation
don't hide a passage. For each benchmark item of n words, windows of n words of a document are compared with it:

1. A window can only reach the similarity if that share of its shingles occurs in the benchmark. A bit map and a
   binary search over all shingles of the document leave the windows with enough such shingles; that loses none.
2. Each of these windows gets a 128-bit SimHash of its shingles, weighted by how often they occur.
3. Items of n words are indexed by the blocks of their SimHash. Two fingerprints within the radius lie, by the general
   pigeonhole principle, within the block's own radius in at least one block, where the radii of the blocks add up to
   the radius less the number of blocks but one: so none within the radius is lost. (At a similarity of 0.75
   22 bits differ on average; the radius lies more than four standard deviations above. Two blocks of 64 bits let 0.3 %
   of unlike pairs pass; blocks short enough to be looked up in a table would let most pass at this radius.)
4. Candidates are verified by their exact weighted shingle similarity, the sum of smaller counts over the sum of larger
   counts. The best window for each item counts.

Items of fewer than five words have one shingle, the whole item. A document shorter than an item is one window.

Defined results: null or wordless texts and items match nothing; repeated items and rows each count; ties go to the
first window; columns pass through, and one named ``contamination`` is replaced. The benchmark is sent to executors
in slices of at most ``most_items`` items and ``most_chars`` characters; a larger one takes several passes over the
documents, none is cut. After ``most_held`` slices what was found is written to the shared folder, so that the driver
never holds more of the benchmark than these.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._shared import Scratch, small_batches, worker
from .shingles import hashes_of_chunks, mix, shingle_hashes

_DROP = re.compile(r"[\W_]+")
BITS = 128
#: Windows that are compared with one another item at once, and shingles whose running sums are held at once.
_PAIRS, _SUMS = 1 << 20, 1 << 16


def _token_hash(token: str) -> int:
    """Hash of the normalised token, 0 for one without letters and digits."""
    bare = token if token.isalnum() else _DROP.sub("", token)
    return xxhash.xxh3_64_intdigest(bare.encode("utf-8", "replace")) | 1 if bare else 0


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of the words of each text."""
    # what Arrow can't hold, a half of a surrogate pair, is no letter
    plain = [t.lower() if t.isascii() else t.lower().encode("utf-8", "replace").decode() for t in (t or "" for t in texts)]
    return hashes_of_chunks(pc.utf8_split_whitespace(pa.array(plain, pa.large_string())), _token_hash)


def _signs(hashes: np.ndarray) -> np.ndarray:
    """Rows of -1 and 1, a column for each bit."""
    both = np.stack((hashes, mix(hashes + np.uint64(0x9E3779B97F4A7C15))), axis=1)
    bits = np.unpackbits(both.astype("<u8").view(np.uint8).reshape(-1, BITS // 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """A row of 64-bit blocks for each row of sums."""
    return np.packbits(sums >= 0, axis=1).view("<u8")


def _weighted_similarity(window: np.ndarray, item: tuple[np.ndarray, np.ndarray]) -> float:
    found, counts = np.unique(window, return_counts=True)
    _, a, b = np.intersect1d(found, item[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(counts[a], item[1][b]).sum())
    return shared / (len(window) + int(item[1].sum()) - shared)


class _SameLength:
    """Items of one number of words and the blocks of their SimHashes."""

    def __init__(self, radius: int):
        blocks = BITS // 64
        spare = radius - blocks + 1
        self.radii = [spare // blocks + (b < spare % blocks) for b in range(blocks)]
        self.numbers: list[int] = []
        self.prints: list[np.ndarray] = []

    def close(self) -> None:
        self.fingerprints = np.array(self.prints, np.uint64).reshape(-1, BITS // 64)

    def within(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within the radius: those near in some block, then by all bits."""
        parts, step = [], max(1, _PAIRS // max(1, len(self.fingerprints)))
        for at in range(0, len(prints), step):
            some = prints[at : at + step]
            near = np.zeros((len(some), len(self.fingerprints)), bool)
            for b, most in enumerate(self.radii):
                near |= np.bitwise_count(some[:, None, b] ^ self.fingerprints[None, :, b]) <= most
            who, which = np.nonzero(near)
            distance = np.bitwise_count(some[who] ^ self.fingerprints[which]).sum(axis=1, dtype=np.int64)
            keep = distance <= radius
            parts.append((who[keep] + at, which[keep], distance[keep]))
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, int),) * 3


class _RunningSums:
    """Fingerprints of windows of a run of shingles, from sums that are held for one stretch of it at a time."""

    def __init__(self, shingles: np.ndarray):
        self.shingles, self.first, self.sums = shingles, 0, np.zeros((0, BITS), np.int32)

    def prints(self, starts: np.ndarray, size: int) -> np.ndarray:
        found = []
        for at in np.split(starts, np.flatnonzero(np.diff(starts // _SUMS)) + 1):
            first, last = int(at[0]) // _SUMS * _SUMS, int(at[-1]) + size
            if first != self.first or last >= first + len(self.sums):
                stretch = self.shingles[first : max(last, first + _SUMS)]
                self.first, self.sums = first, np.zeros((len(stretch) + 1, BITS), np.int32)
                np.cumsum(_signs(stretch), axis=0, out=self.sums[1:])
            found.append(_fingerprints(self.sums[at - first + size] - self.sums[at - first]))
        return np.concatenate(found)


class Index:
    """Finds the items of a benchmark in texts."""

    def __init__(self, items: list[tuple[object, str | None]], threshold: float = 0.75, size: int = 5, radius: int = 40):
        self.threshold, self.radius, self.items = threshold, radius, []
        self.runs: dict[int, dict[int, _SameLength]] = {}
        known: dict[int, list[np.ndarray]] = {}
        for (name, _), words in zip(items, word_hashes([text for _, text in items])):
            if not len(words):
                continue
            run = min(size, len(words))
            shingles = shingle_hashes(words, run)
            group = self.runs.setdefault(run, {}).setdefault(len(words), _SameLength(radius))
            group.numbers.append(len(self.items))
            group.prints.append(_fingerprints(_signs(shingles).sum(axis=0, keepdims=True))[0])
            known.setdefault(run, []).append(shingles)
            self.items.append((name, np.unique(shingles, return_counts=True)))
        self.known = {run: np.unique(np.concatenate(x)) for run, x in known.items()}
        bits = max(16, int(8 * sum(map(len, self.known.values()))).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.maps = {}
        for run, hashes in self.known.items():
            self.maps[run] = np.zeros(1 << bits, bool)
            self.maps[run][hashes & self.mask] = True
            for group in self.runs[run].values():
                group.close()

    def find(self, text: str | None) -> list[tuple[object, int, int, float]]:
        """(item, first word, words, similarity) of the best window of each item found."""
        return self.find_in(word_hashes([text])[0])

    def find_in(self, words: np.ndarray) -> list[tuple[object, int, int, float]]:
        """``find`` in the text with these hashes of words."""
        best: dict[int, tuple[int, int, float]] = {}
        for run, groups in self.runs.items():
            if len(words) < run:
                continue
            shingles = shingle_hashes(words, run)
            at = np.flatnonzero(self.maps[run][shingles & self.mask])
            if not len(at):
                continue
            place = np.searchsorted(self.known[run], shingles[at])
            at = at[self.known[run][np.minimum(place, len(self.known[run]) - 1)] == shingles[at]]
            if len(at):
                self._windows(shingles, run, at, groups, best)
        return [(self.items[n][0], *found) for n, found in sorted(best.items())]

    def _windows(self, shingles: np.ndarray, run: int, hits: np.ndarray, groups: dict[int, _SameLength], best: dict) -> None:
        reach = max(groups) - run + 1
        for part in np.split(hits, np.flatnonzero(np.diff(hits) > 2 * reach) + 1):
            low, high = max(0, int(part[0]) - reach), min(len(shingles), int(part[-1]) + reach + 1)
            counts = np.zeros(high - low + 1, np.int64)
            counts[part - low + 1] = 1
            counts = np.cumsum(counts)
            sums: _RunningSums | None = None
            for words, group in groups.items():
                full = words - run + 1
                size = min(full, len(shingles))
                need = self.threshold * full
                if need > len(part) or size < need or high - low < size:
                    continue
                starts = np.flatnonzero(counts[size:] - counts[:-size] >= need)
                if not len(starts):
                    continue
                if sums is None:
                    sums = _RunningSums(shingles[low:high])
                who, which, distance = group.within(sums.prints(starts, size), self.radius)
                for k in np.argsort(distance, kind="stable"):
                    number, start = group.numbers[which[k]], low + int(starts[who[k]])
                    had = best.get(number, (0, 0, -1.0))
                    if had[2] == 1.0 and had[0] <= start:
                        continue
                    value = _weighted_similarity(shingles[start : start + size], self.items[number][1])
                    if value >= self.threshold and (value, -start) > (had[2], -had[0]):
                        best[number] = (start, size + run - 1, value)


def _slices(benchmark: DataFrame, item_column: str, text_column: str, most_items: int, most_chars: int) -> Iterator[list[tuple[object, str | None]]]:
    """The items in slices of bounded size."""
    part, chars = [], 0
    for row in benchmark.select(item_column, text_column).where(F.col(text_column).isNotNull()).toLocalIterator():
        if part and (len(part) == most_items or chars + len(row[1]) > most_chars):
            yield part
            part, chars = [], 0
        part.append((row[0], row[1]))
        chars += len(row[1])
    if part:
        yield part


def mark(documents: DataFrame, benchmark: DataFrame, threshold: float = 0.75, size: int = 5, radius: int = 40, text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text", most_items: int = 50_000, most_chars: int = 30_000_000, most_held: int = 4, block: int = 1024) -> DataFrame:
    """``documents`` with the column contamination: an array of (item, start, words, similarity), empty if clean."""
    small_batches(documents.sparkSession)
    kind = benchmark.schema[item_column].dataType.simpleString()
    array = f"array<struct<item: {kind}, start: bigint, words: bigint, similarity: double>>"
    out = documents.drop("contamination").withColumn("contamination", F.array().cast(array))
    schema = StructType(out.schema.fields)
    scratch, before = Scratch(documents.sparkSession), None
    for number, part in enumerate(_slices(benchmark, item_column, item_text_column, most_items, most_chars)):
        if number and number % most_held == 0:
            written = scratch.keep(out)
            if before is not None:
                scratch.drop(before)
            out = before = written

        def run(batches: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_schema

            index, arrow = Index(part, threshold, size, radius), to_arrow_schema(schema)
            at_text = schema.names.index(text_column)
            for whole in batches:
                for at in range(0, whole.num_rows, block):
                    batch = whole.slice(at, block)
                    found = [index.find_in(words) for words in word_hashes(batch.column(at_text).to_pylist())]
                    had = batch.column(batch.num_columns - 1).to_pylist()
                    both = pa.array([h + [dict(zip(("item", "start", "words", "similarity"), f)) for f in fs] for h, fs in zip(had, found)], arrow[-1].type)
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-1], both], names=schema.names)

        out = out.mapInArrow(worker("tokens", run), schema)
    return out
