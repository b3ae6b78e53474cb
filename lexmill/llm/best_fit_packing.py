"""Bounded-space online best-fit packing of tokenised documents into fixed-length sequences.

Every input partition runs one packer. Its open bins are held in a bitset keyed by free space, so the tightest bin
that still takes a piece is one shift and one lowest-set-bit away; when the number of open bins reaches the bound,
the fullest closes first. A piece gets its place the moment it arrives, so nothing waits in memory and a partition
that is computed again after a lost executor gives the same rows. Nothing is shuffled.

Defined results: null or empty text is the terminator alone; a null ``doc_id`` stays null; repeated rows are packed
as often as they occur; columns other than the id and the text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._shared import Recent, small_batches, worker

#: Normalizer and pre-tokenizer of the vocabulary files that ``ChunkTokenizer`` knows how to take apart.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_PARTS = regex.compile(_PATTERN)
#: Characters whose lower case or white-space class differs between Python and the tokenizer library.
_ODD = "\x1c\x1d\x1e\x1fΣİ"
_WIDE = re.compile("[^\x00-ɏ]")


class ChunkTokenizer:
    """Ids of texts, equal to the library's encode() without special tokens.

    The pre-tokenizer never joins across white space, so a text's ids are those of its white-space chunks one after
    the other. The chunks of a batch are numbered by Arrow, each different one is looked up once in a bounded dictionary
    of ids, and the ids are laid out by array operations. Strings of special tokens in a text count as ordinary text.
    A vocabulary file with another normalizer, pre-tokenizer or model is left to the library as it is.
    """

    def __init__(self, path: str, most_kept: int = 100_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.known_plan = plan["normalizer"] == _NORMALIZER and plan["pre_tokenizer"] == _PRE_TOKENIZER and plan["model"]["type"] == "BPE"
        plan |= {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}
        self.tokenize = Tokenizer.from_str(json.dumps(plan)).model.tokenize if self.known_plan else None
        self.bytes_as_text = _byte_alphabet()
        self.most_kept = most_kept
        self.kept = Recent(self._part, "packing", most_kept)

    def _part(self, part: str) -> bytes:
        """Little-endian uint32 ids of a chunk that the pre-tokenizer leaves whole."""
        mapped = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.bytes_as_text)
        ids = [t.id for t in self.tokenize(mapped)]
        return pack_ids(f"<{len(ids)}I", *ids)

    def _by_library(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return pack_ids(f"<{len(ids)}I", *ids)

    def _ids_of(self, chunks: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Ids of different chunks. Those of several parts are kept if they occur again in the batch, parts always."""
        kept, known = self.kept, self.kept.get
        found = [known(c) for c in chunks]
        for i, ids in enumerate(found):
            if ids is None:
                chunk = chunks[i]
                if chunk.isalpha() and (chunk.isascii() or not _WIDE.search(chunk)):
                    found[i] = kept[chunk]
                elif _WIDE.search(chunk):
                    found[i] = self._by_library(chunk)
                else:
                    found[i] = kept.old.get(chunk)
                    if found[i] is None:
                        found[i] = b"".join([known(p) or kept[p] for p in _PARTS.findall(chunk)])
                    if counts[i] > 1:
                        kept.add(chunk, found[i])
        return found

    def encode(self, texts: list[str | None], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """(ids, edges): the ids of all texts, each followed by the id ``end``; a text's ids lie between its two edges."""
        plain, whole = [], {}
        for i, text in enumerate(texts):
            text = text or ""
            if not self.known_plan or any(map(text.__contains__, _ODD)):
                whole[i] = self._by_library(text)
                text = ""
            elif not text.isascii():
                text = unicodedata.normalize("NFC", text).encode("utf-8", "replace").decode()
            plain.append(text.lower())
        split = pc.utf8_split_whitespace(pa.array(plain, pa.large_string()))
        numbered = split.flatten().dictionary_encode()
        numbers = numbered.indices.to_numpy()
        found = self._ids_of(numbered.dictionary.to_numpy(zero_copy_only=False), np.bincount(numbers, minlength=len(numbered.dictionary)))
        # one more chunk ends each text: its ids by the library, if it was asked, and the terminator
        edges = split.offsets.to_numpy()[1:]
        tail_of = np.full(len(texts), len(found) + len(whole), np.int32)
        tail_of[list(whole)] = len(found) + np.arange(len(whole))
        numbers = np.insert(numbers, edges, tail_of)
        found += [ids + end for ids in whole.values()] + [end]
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        ends = np.cumsum(sizes[numbers])
        kind = np.int32 if not len(ends) or ends[-1] < 1 << 31 and len(flat) < 1 << 31 else np.int64
        starts, lengths = (np.cumsum(sizes) - sizes).astype(kind)[numbers], sizes.astype(kind)[numbers]
        ids = flat[np.repeat(starts - ends.astype(kind) + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0, dtype=kind)]
        return ids, np.concatenate(([0], ends[edges + np.arange(len(texts))]))


def _byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write each byte as one printable character; the others start at 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


_loaded: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    """The tokenizer of ``path``, kept with its dictionaries for the life of the worker."""
    if path not in _loaded:
        _loaded[path] = ChunkTokenizer(path)
    return _loaded[path]


class OpenBins:
    """At most ``most`` bins with free space; bit f of ``free`` is set while some open bin has f places free."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free, self.count, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, space: int) -> int:
        stack = self.by_free[space]
        number = stack.pop()
        if not stack:
            self.free &= ~(1 << space)
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece of ``length``: the fullest open bin that takes it, else a new one."""
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            if self.count == self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            self.by_free[left].append(number)
            self.free |= 1 << left
            self.count += 1
        return number, self.capacity - space


def pack(documents: DataFrame, vocabulary: str, capacity: int = 2048, terminator: int = 0, open_bins: int = 512, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False, block: int = 1024) -> DataFrame:
    """Pieces of ``documents`` with their place in a sequence of at most ``capacity`` tokens.

    Columns: the id, piece (from 0), start (the document's tokens before the piece), length, ids_crc32, sequence_id,
    offset; with ``with_ids`` also ids, the piece's tokens. A document with its terminator stays whole unless it is
    longer than ``capacity``. Within ``block`` documents longer pieces are placed first.
    """
    kind = documents.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    schema = StructType.fromDDL(schema + (", ids array<int>" if with_ids else ""))
    small_batches(documents.sparkSession)
    end = terminator.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        encode, bins = tokenizer(vocabulary).encode, OpenBins(capacity, open_bins)
        first = TaskContext.get().partitionId() << 33
        arrow = to_arrow_schema(schema)
        for whole in batches:
            for at in range(0, whole.num_rows, block):
                batch = whole.slice(at, block)
                ids, edges = encode(batch.column(1).to_pylist(), end)
                pieces = -(-np.diff(edges) // capacity)
                owner = np.repeat(np.arange(len(pieces)), pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                begin = edges[owner] + piece * capacity
                length = np.minimum(begin + capacity, edges[owner + 1]) - begin
                crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(begin.tolist(), length.tolist())]
                where, offset = [0] * len(owner), [0] * len(owner)
                for i in np.argsort(-length, kind="stable").tolist():
                    number, offset[i] = bins.place(int(length[i]))
                    where[i] = first + number
                columns = [batch.column(0).take(pa.array(owner, pa.int64())), piece, piece * capacity, length, crc, where, offset]
                if with_ids:
                    columns.append([ids[a : a + n] for a, n in zip(begin.tolist(), length.tolist())])
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return documents.select(F.col(id_column), F.col(text_column)).mapInArrow(worker("packing", run), schema)
