"""Language of words and documents by a linear-chain conditional random field.

Words are maximal runs of letters of the lower-cased text. A word's features are its letter n-grams (two to four
letters, with the word's edges as letters, so prefixes and suffixes are among them) and the word itself (the learned
lexicon), hashed into one weight table; transitions between the languages of neighbouring words are learned with
them. Training sequences are lines of documents in random order, so the chain learns how long a language lasts in
code-switched text. Forward-backward gives each word's posterior; a document's language is the one with the largest
posterior mass over its words, and its score that mass divided by the words.

The chain of a whole batch is computed at once: blocks of words are first multiplied to one small matrix each, the
blocks are joined in order, and then every block is filled in. That is the exact algorithm, not an approximation.
A very long text is read in spans twice: the first reading gives each span's matrix, and with them the vectors that
enter and leave it, so that its chain is one, whatever its length, and only one span is held at a time.

Defined results: null text or one without letters is ``und`` with score 0; with nothing to learn from, every text is
``und``; ties go to the language first in order; repeated rows are each labelled; rows with a null id are labelled but
never learned from. Learning takes a bounded sample (``most`` documents of at most ``most_chars`` characters each).
With ``other``, that share of the sampled texts is learned a second time with the letters of each word in random order,
as words of no learned language (label ``other``): so letter noise and unlike languages can be told apart.
A repeated id is learned from once, by its smallest text. Input columns pass through unchanged; the new columns
are lang_pred and lang_score, and take the place of any of these names; no rows give no rows.
"""

from __future__ import annotations

import random
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._shared import hashed_sample, small_batches, worker

UNKNOWN = "und"
#: Label of words of no learned language, in models that have it.
OTHER = "other"
#: Characters that are worked on at once.
_SPAN = 400_000
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letters


@dataclass
class Words:
    """Words of some texts: feature rows by letter, the first letter of each word, the word's text and place."""

    features: np.ndarray  # (letters, 3)
    lexical: np.ndarray  # (words,)
    first: np.ndarray  # first letter of each word
    owner: np.ndarray  # text of each word
    begin: np.ndarray  # place of each word in the joined texts
    end: np.ndarray
    origin: np.ndarray  # place of each text in the joined texts


def words_of(texts: list[str], bits: int) -> Words:
    # A character whose lower case is longer keeps its place by staying as it is.
    lowered = [low if len(low := t.lower()) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t) for t in texts]
    joined = "\n" + "\n".join(lowered) + "\n\n\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(_letter_table()[code], code, np.uint32(0))
    origin = 1 + np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    at = np.flatnonzero(code)
    before, here, after, second = code[at - 1], code[at], code[at + 1], code[at + 2]
    second = np.where(after == 0, np.uint32(0), second)
    mask, shift = np.uint32((1 << bits) - 1), np.uint32(32 - bits)
    pair = before * np.uint32(0x9E3779B1) + here * np.uint32(0x85EBCA77)
    triple = pair * np.uint32(0xC2B2AE3D) + after * np.uint32(0x27D4EB2F) + np.uint32(1)
    quad = triple * np.uint32(0x165667B1) + second * np.uint32(0x9E3779B1) + np.uint32(2)
    mixed = np.stack((pair, triple, quad), axis=1)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    features = (mixed >> shift) & mask
    first = np.flatnonzero(before == 0)
    begin = at[first]
    if len(first):
        length = np.diff(np.append(first, len(at)))
        offset = np.arange(len(at)) - np.repeat(first, length)
        power = np.cumprod(np.full(int(length.max()), 0x01000193, np.uint64))
        spelled = np.add.reduceat(here.astype(np.uint64) * power[offset], first)
        spelled ^= spelled >> np.uint64(29)
        spelled *= np.uint64(0x9E3779B97F4A7C15)
        lexical = (spelled >> np.uint64(64 - bits)).astype(np.uint32)
    else:
        length, lexical = np.zeros(0, int), np.zeros(0, np.uint32)
    owner = np.searchsorted(origin, begin, "right") - 1
    return Words(features, lexical, first, owner, begin, begin + length, origin)


class _Blocks:
    """Chains laid end to end, cut into blocks of words; ``opens`` marks the first word of each chain."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray, start: np.ndarray, opens: np.ndarray):
        self.n, self.k = emission.shape
        self.length = int(np.clip(np.sqrt(self.n) / 2, 8, 256))
        self.count = -(-self.n // self.length)
        full = self.count * self.length
        e, o, self.more = np.ones((full, self.k)), np.zeros(full, bool), np.zeros(full, bool)
        e[: self.n], o[: self.n], self.more[self.n :] = emission, opens, True
        self.e, self.o = e.reshape(self.count, self.length, self.k), o.reshape(self.count, self.length)
        self.more = self.more.reshape(self.count, self.length)  # places behind the last word change nothing
        self.transition, self.start = transition, start
        product = np.broadcast_to(np.eye(self.k), (self.count, self.k, self.k)).copy()
        for t in range(self.length):
            moved = product @ transition
            if self.o[:, t].any():
                moved = np.where(self.o[:, t, None, None], product.sum(axis=2, keepdims=True) * start, moved)
            moved *= self.e[:, t, None, :]
            moved /= moved.max(axis=(1, 2), keepdims=True)
            product = np.where(self.more[:, t, None, None], product, moved) if self.more[:, t].any() else moved
        self.product = product

    def whole(self) -> np.ndarray:
        """One matrix for all words, up to a factor."""
        out = np.eye(self.k)
        for matrix in self.product:
            out = out @ matrix
            out /= out.max()
        return out

    def vectors(self, entry: np.ndarray | None = None, leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Normalised forward and backward vectors; ``entry`` and ``leave`` are those of the words before and behind."""
        entries, leaves = np.empty((self.count, self.k)), np.empty((self.count, self.k))
        v, u = np.full(self.k, 1.0 / self.k) if entry is None else entry, np.ones(self.k) if leave is None else leave
        for b in range(self.count):
            entries[b] = v
            v = v @ self.product[b]
            v /= v.sum()
            c = self.count - 1 - b
            leaves[c] = u
            u = self.product[c] @ u
            u /= u.sum()
        alpha, beta = np.empty_like(self.e), np.empty_like(self.e)
        for t in range(self.length):
            moved = entries @ self.transition
            entries = np.where(self.o[:, t, None], self.start, moved) * self.e[:, t]
            entries /= entries.sum(axis=1, keepdims=True)
            alpha[:, t] = entries
            r = self.length - 1 - t
            beta[:, r] = leaves
            ahead = np.where(self.o[:, r, None], 1.0, (self.e[:, r] * leaves) @ self.transition.T)
            ahead /= ahead.sum(axis=1, keepdims=True)
            leaves = np.where(self.more[:, r, None], leaves, ahead)
        return alpha.reshape(-1, self.k)[: self.n], beta.reshape(-1, self.k)[: self.n]


def forward_backward(emission: np.ndarray, transition: np.ndarray, start: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised forward and backward vectors of chains laid end to end; ``opens`` marks the first word of each."""
    return _Blocks(emission, transition, start, opens).vectors()


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # (2**bits, languages) float32
    transition: np.ndarray
    start: np.ndarray
    bits: int

    def emission(self, words: Words) -> np.ndarray:
        by_letter = self.table[words.features[:, 0]]
        for j in (1, 2):
            by_letter += self.table[words.features[:, j]]
        energy = np.add.reduceat(by_letter, words.first, axis=0).astype(np.float64) + self.table[words.lexical]
        return np.exp(np.maximum(energy - energy.max(axis=1, keepdims=True), -30.0))

    def posteriors(self, words: Words) -> np.ndarray:
        opens = np.diff(words.owner, prepend=-1) != 0
        alpha, beta = forward_backward(self.emission(words), self.transition, self.start, opens)
        both = alpha * beta
        return both / both.sum(axis=1, keepdims=True)


def _softmax_rows(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def fit(texts: list[str], labels: list[str], bits: int = 17, epochs: int = 4, batch_chars: int = 150_000, rate: float = 0.15, seed: int = 7) -> LanguageModel | None:
    """Weights and transitions by stochastic gradient on the conditional likelihood; None without labelled letters."""
    languages = sorted(set(labels))
    pieces = [(line, languages.index(label)) for text, label in zip(texts, labels) for line in (text or "").split("\n") if any(map(str.isalpha, line))]
    if not pieces:
        return None
    k, rng = len(languages), np.random.default_rng(seed)
    table = np.zeros((1 << bits, k), np.float32)
    squares = np.full((1 << bits, k), 1e-3, np.float32)
    moves, start = np.eye(k) * 2.0, np.zeros(k)
    move_squares, start_squares = np.full((k, k), 1.0), np.full(k, 1.0)
    for _ in range(epochs):
        order, at = rng.permutation(len(pieces)), 0
        while at < len(order):
            batch, size = [], 0
            while at < len(order) and (not batch or size < batch_chars):
                batch.append(pieces[order[at]])
                size += len(batch[-1][0])
                at += 1
            words = words_of([x for x, _ in batch], bits)
            truth = np.array([y for _, y in batch])[words.owner]
            transition, first = _softmax_rows(moves), _softmax_rows(start)
            model = LanguageModel(languages, table, transition, first, bits)
            e, opens = model.emission(words), np.zeros(len(truth), bool)
            opens[0] = True  # the lines of a batch are one code-switched sequence
            alpha, beta = forward_backward(e, transition, first, opens)
            marginal = alpha * beta
            marginal /= marginal.sum(axis=1, keepdims=True)
            # features
            off = marginal
            off[np.arange(len(truth)), truth] -= 1
            per_letter = np.repeat(off, np.diff(np.append(words.first, len(words.features))), axis=0)
            where = np.concatenate((words.features.T.ravel(), words.lexical))
            pull = np.concatenate((np.tile(per_letter, (3, 1)), off))
            used, slot = np.unique(where, return_inverse=True)
            g = np.stack([np.bincount(slot, pull[:, j], len(used)) for j in range(k)], axis=1)
            g += 1e-3 * table[used]
            squares[used] += g * g
            table[used] -= rate * g / np.sqrt(squares[used])
            # transitions, as rows of a softmax
            pair = alpha[:-1, :, None] * transition * (e[1:] * beta[1:])[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            expected, seen = pair.sum(axis=0), np.zeros((k, k))
            np.add.at(seen, (truth[:-1], truth[1:]), 1)
            g = (expected - seen) - transition * (expected - seen).sum(axis=1, keepdims=True)
            move_squares += g * g
            moves -= rate * g / np.sqrt(move_squares)
            g = off[0] - first * off[0].sum()
            start_squares += g * g
            start -= rate * g / np.sqrt(start_squares)
    return LanguageModel(languages, table, _softmax_rows(moves), _softmax_rows(start), bits)


def scrambled(text: str, rng: random.Random) -> str:
    """The text with the letters of each chunk between spaces in random order."""
    return "\n".join(" ".join("".join(rng.sample(chunk, len(chunk))) for chunk in line.split(" ")) for line in text.split("\n"))


def train(documents: DataFrame, most: int = 2500, most_chars: int = 20_000, bits: int = 17, other: float = 0.0, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> LanguageModel | None:
    """Learn from a bounded sample of the labelled rows of ``documents``."""
    known = documents.where(F.col(lang_column).isNotNull() & (F.length(text_column) <= most_chars))
    ids = hashed_sample(documents.where(F.col(lang_column).isNotNull()), id_column, most, 21)
    kind = documents.schema[id_column].dataType.simpleString()
    wanted = documents.sparkSession.createDataFrame([(i,) for i in ids], f"`{id_column}` {kind}")
    rows = known.select(id_column, text_column, lang_column).join(F.broadcast(wanted), id_column, "left_semi")
    rows = rows.groupBy(id_column).agg(F.min(F.struct(text_column, lang_column)).alias("first")).orderBy(id_column).collect()
    texts, labels = [r["first"][0] for r in rows], [r["first"][1] for r in rows]
    noise, rng = range(0, round(len(texts) * other)), random.Random(17)
    return fit(texts + [scrambled(texts[i], rng) for i in noise], labels + [OTHER] * len(noise), bits)


def _spans(text: str) -> Iterator[tuple[int, str]]:
    """Parts of about ``_SPAN`` characters, cut between words, and their places."""
    at = 0
    while at < len(text):
        to = min(len(text), at + _SPAN)
        while to < len(text) and text[to].isalpha():
            to += 1
        yield at, text[at:to]
        at = to


def _posteriors_of_long(text: str, model: LanguageModel) -> Iterator[tuple[int, Words, np.ndarray]]:
    """(place, words, posteriors) of each span of one chain."""

    def blocks(words: Words, first: bool) -> _Blocks:
        opens = np.zeros(len(words.first), bool)
        opens[0] = first
        return _Blocks(model.emission(words), model.transition, model.start, opens)

    k = len(model.languages)
    products, some = [], False
    for _, part in _spans(text):
        words = words_of([part], model.bits)
        products.append(blocks(words, not some).whole() if len(words.first) else np.eye(k))
        some = some or len(words.first) > 0
    leaves = [np.ones(k)]
    for product in reversed(products[1:]):
        u = product @ leaves[-1]
        leaves.append(u / u.sum())
    entry, some = np.full(k, 1.0 / k), False
    for (at, part), product, leave in zip(_spans(text), products, reversed(leaves)):
        words = words_of([part], model.bits)
        if len(words.first):
            alpha, beta = blocks(words, not some).vectors(entry, leave)
            some, both = True, alpha * beta
            yield at, words, both / both.sum(axis=1, keepdims=True)
        entry = entry @ product
        entry /= entry.sum()


def _batches(texts: list[str | None]) -> Iterator[list[int]]:
    """Numbers of the texts that are worked on together: about ``_SPAN`` characters, or one text of more."""
    part, size = [], 0
    for i, text in enumerate(texts):
        length = len(text or "")
        if part and size + length > _SPAN:
            yield part
            part, size = [], 0
        part.append(i)
        size += length
    if part:
        yield part


def label_texts(texts: list[str | None], model: LanguageModel | None, runs: bool = False) -> tuple[list[str], list[float], list[list[tuple[int, int, str, float]]]]:
    """Language and score of each text, and with ``runs`` its stretches of one language (start, end, language, score)."""
    if model is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    k = len(model.languages)
    mass, found = np.zeros((len(texts), k)), [[] for _ in texts]
    for numbers in _batches(texts):
        if len(texts[numbers[0]] or "") > _SPAN:
            parts = _posteriors_of_long(texts[numbers[0]], model)
        else:
            words = words_of([texts[i] or "" for i in numbers], model.bits)
            parts = [(0, words, model.posteriors(words))] if len(words.first) else []
        for shift, words, posterior in parts:
            owner = np.array(numbers)[words.owner]
            for j in range(k):
                mass[:, j] += np.bincount(owner, posterior[:, j], len(texts))
            if runs:
                best = posterior.argmax(axis=1)
                edge = np.flatnonzero((np.diff(best, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
                for a, b in zip(edge, np.append(edge[1:], len(best))):
                    move, mine = shift - words.origin[words.owner[a]], found[owner[a]]
                    if not (mine and mine[-1][2] == best[a]):  # a stretch may go on from the span before
                        mine.append([int(words.begin[a] + move), 0, best[a], 0.0, 0])
                    mine[-1][1] = int(words.end[b - 1] + move)
                    mine[-1][3] += float(posterior[a:b, best[a]].sum())
                    mine[-1][4] += int(b - a)
    total = mass.sum(axis=1)
    best = mass.argmax(axis=1)
    langs = [model.languages[b] if t > 0 else UNKNOWN for b, t in zip(best, total)]
    scores = [float(min(1.0, mass[i, b] / total[i])) if total[i] > 0 else 0.0 for i, b in enumerate(best)]
    return langs, scores, [[(start, end, model.languages[j], mean / n) for start, end, j, mean, n in mine] for mine in found]


def identify(documents: DataFrame, model: LanguageModel | None, text_column: str = "text", runs: bool = False, block: int = 1024) -> DataFrame:
    """``documents`` with lang_pred and lang_score, and with ``runs`` lang_runs: stretches of one language in code points."""
    more = "lang_pred string, lang_score double" + (", lang_runs array<struct<start: bigint, end: bigint, lang: string, score: double>>" if runs else "")
    small_batches(documents.sparkSession)
    documents = documents.drop("lang_pred", "lang_score", *["lang_runs"] * runs)
    schema = StructType(documents.schema.fields + StructType.fromDDL(more).fields)
    at_text = documents.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for whole in batches:
            for at in range(0, whole.num_rows, block):
                batch = whole.slice(at, block)
                langs, scores, found = label_texts(batch.column(at_text).to_pylist(), model, runs)
                columns = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                if runs:
                    columns.append(pa.array([[dict(zip(("start", "end", "lang", "score"), r)) for r in rs] for rs in found], arrow[-1].type))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return documents.mapInArrow(worker("language", run), schema)
