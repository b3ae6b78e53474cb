"""URL filtering by a bit-parallel wildcard automaton (Shift-And with multiword masks).

A rule is a host suffix and a path prefix. Each becomes a glob over the canonical form ``.host#path`` (neither part
can hold ``#``): ``*.host#prefix*``. All globs are packed one after the other into one row of 64-bit words, and every
URL of a batch advances through all of them at once: one shift with carry, one mask for the byte read, and one mask
for the positions where ``*`` may stay. ``?`` in a glob takes any one byte.

Defined results: a null URL or one without ``://`` has an empty host and path and no rule; a rule that occurs twice
counts once; of fitting rules the longest text wins, and on a tie of length the first listed; an empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def glob(self) -> str:
        return f"*.{self.host}#{self.path}*"


class GlobAutomaton:
    """Masks for a list of globs; ``match`` gives one boolean column a glob for a list of byte strings."""

    def __init__(self, globs: list[str]):
        first, last, stay, takes = [], [], [], []
        for glob in globs:
            symbols: list[object] = []
            loops: set[int] = set()
            for char in glob:
                if char == "*":
                    loops.add(len(symbols))  # the state before the next symbol may read anything
                else:
                    symbols.extend([None] if char == "?" else char.encode())
            # state 0 is "nothing read"; state i has read i symbols
            base = len(takes)
            first.append(base)
            for i in range(len(symbols) + 1):
                takes.append(symbols[i - 1] if i else "start")
                if i in loops:
                    stay.append(base + i)
            last.append(len(takes) - 1)
        words = max(1, -(-len(takes) // 64))
        self.words, self.accept = words, [divmod(x, 64) for x in last]
        self.stay, self.start = self._bits(stay), self._bits(first)
        self.byte = np.zeros((256, words), np.uint64)
        for position, symbol in enumerate(takes):
            word, bit = divmod(position, 64)
            if symbol is None:
                self.byte[:, word] |= np.uint64(1 << bit)
            elif symbol != "start":
                self.byte[symbol, word] |= np.uint64(1 << bit)

    def _bits(self, positions: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for position in positions:
            out[position // 64] |= np.uint64(1 << position % 64)
        return out

    def match(self, subjects: list[bytes]) -> np.ndarray:
        """Booleans of shape (subjects, globs). Longer subjects are read first, and the rest drop out as they end."""
        lengths = np.array([len(s) for s in subjects], np.int64)
        order = np.argsort(-lengths, kind="stable")
        alive_at = -lengths[order]
        starts = np.concatenate(([0], np.cumsum(lengths)))[:-1][order]
        flat = np.frombuffer(b"".join(subjects), np.uint8)
        state = np.tile(self.start, (len(subjects), 1))
        one, high = np.uint64(1), np.uint64(63)
        for t in range(int(lengths.max(initial=0))):
            alive = int(np.searchsorted(alive_at, -t, "left"))
            now = state[:alive]
            moved = now << one
            if self.words > 1:
                moved[:, 1:] |= now[:, :-1] >> high
            state[:alive] = (moved & self.byte[flat[starts[:alive] + t]]) | (now & self.stay)
        found = np.empty((len(subjects), len(self.accept)), bool)
        for k, (word, bit) in enumerate(self.accept):
            found[order, k] = (state[:, word] >> np.uint64(bit)) & one
        return found


_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url):
    """Columns host and path of a URL column, as the module's text defines them; only A-Z of the host is lower-cased."""
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, _ADDRESS, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(text, _ADDRESS, 2)


def judge(pages: DataFrame, rules: list[Rule], default: str = ALLOW, id_column: str = "page_id", url_column: str = "url", block: int = 8192) -> DataFrame:
    """id, host, path, rule (null if none fits) and verdict of every row; ``default`` holds where no rule fits."""
    kind = pages.schema[id_column].dataType.simpleString()
    schema = StructType.fromDDL(f"`{id_column}` {kind}, host string, path string, rule string, verdict string")
    listed = list(dict.fromkeys(rules))
    ranked = sorted(range(len(listed)), key=lambda i: (-len(listed[i].text), i))
    rules = [listed[i] for i in ranked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = GlobAutomaton([r.glob() for r in rules])
        names = pa.array([r.text for r in rules] or [None], pa.string())
        verdicts = pa.array([*(r.verdict for r in rules), default], pa.string())
        for whole in batches:
            for at in range(0, whole.num_rows, block):
                batch = whole.slice(at, block)
                subjects = [f".{h}#{p}".encode() for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
                found = automaton.match(subjects)
                first = np.where(found.any(axis=1), found.argmax(axis=1), len(rules)) if rules else np.zeros(len(subjects), np.int64)
                rule = names.take(pa.array([int(i) if i < len(rules) else None for i in first], pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdicts.take(pa.array(first, pa.int64()))], names=schema.names)

    host, path = host_and_path(F.col(url_column))
    return pages.select(F.col(id_column), host.alias("host"), path.alias("path")).mapInArrow(run, schema)
