"""Hashed word shingles, shared by the near-duplicate and decontamination operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def hashes_of_chunks(split: pa.LargeListArray, hash_of: Callable[[str], int]) -> list[np.ndarray]:
    """The hashes of each text's chunks, 0 for those left out: each different chunk of the batch is hashed once."""
    numbered = split.flatten().dictionary_encode()
    chunks = numbered.dictionary.to_numpy(zero_copy_only=False)
    table = np.fromiter(map(hash_of, chunks), np.uint64, len(chunks))
    hashes, edges = table[numbered.indices.to_numpy()] if len(table) else np.zeros(0, np.uint64), split.offsets.to_numpy()
    whole = [hashes[a:b] for a, b in zip(edges[:-1], edges[1:])]
    return whole if table.all() else [h[h != 0] for h in whole]


def texts_hashes(texts: pa.Array) -> list[np.ndarray]:
    """Hashes of each text's words between ASCII white space, with A-Z (only) in lower case; none for a null."""
    lower = pa.array([(t or "").encode("utf-8", "replace").translate(_LOWER) for t in texts.to_pylist()], pa.large_binary())
    split = pc.ascii_split_whitespace(lower.cast(pa.large_string()))
    return hashes_of_chunks(split, lambda word: xxhash.xxh3_64_intdigest(word) if word else 0)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hash of every run of ``size`` words, in order; of a shorter text one hash of the whole sequence; none without words."""
    n = len(words)
    if not n:
        return words
    run = min(size, n)
    total = words[: n - run + 1].copy()
    for j in range(1, run):
        total = total * _ODD + words[j : n - run + 1 + j]
    return mix(total + np.uint64(0 if run == size else run))


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a batch."""
    return [np.unique(shingle_hashes(words, size)) for words in texts_hashes(texts)]


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    return shingle_sets(pa.array([text], pa.string()), size)[0]
