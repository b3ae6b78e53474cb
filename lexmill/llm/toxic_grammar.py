"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols of a small alphabet (insult, threat, target, negation, reporting, other) through a lexicon: fixed
English entries, function words of four languages, and words and stems learned from labelled texts. Three transducers
then rewrite the symbols of a clause and weigh them: negation softens what follows it, reported speech discounts what it
introduces, and a target strengthens an insult and completes a threat. They are composed into one machine, which reads
each clause that holds an insult or threat; clauses, not words, get scores. A word's own weight counts in the share that
its symbol has left when the machine has rewritten it. A logistic model over a text's matched clauses turns them into a
probability.

The lexicon is learned through the grammar: a word counts where no negation or reporting before it would soften it, so a
word that clean texts only deny or quote is learned, and a word that is toxic beside a target alone becomes a threat.

Defined results: null text counts as empty, and a text without words has the score of a text without a match; rows
with a null id are scored but never learned from; a repeated id is learned from once, and of near copies only one is;
without labels of both kinds the fixed lexicon and a fixed model are used. Learning takes a bounded sample
(``most_toxic``, ``most_clean``; texts over ``most_chars`` characters aren't learned from); scoring takes every whole
text. Input columns pass through; those named like the new ones (toxic_score, toxic_flag, toxic_clauses) are replaced.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._shared import Recent, hashed_sample, small_batches, texts_of, worker

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, SOFT, QUOTED = "other insult threat target negation report soft quoted".split()

#: Fixed lexicon. Insults carry log-odds weights, threats none before they meet a target; learned forms are added to
#: the insults.
INSULTS = {w: 6.0 for w in "idiot idiots moron morons scum trash loser losers clown clowns pathetic worthless disgusting stupid imbecile filth vermin bastard bitch asshole dumbass retard subhuman degenerate freak pig pigs cockroach cockroaches".split()}
THREATS = {w: 0.0 for w in "kill killing murder hurt destroy stab strangle".split()}
TARGETS = frozenset("you your yours yourself they them he him she her vous toi tu ton votre ihr euch du dich dein usted ustedes tú te vosotros".split())
NEGATIONS = frozenset("not never no don't isn't aren't wasn't won't nobody neither nor without ne jamais aucun kein keine nie weder nunca tampoco ningún sin".split())
REPORTS = frozenset("said says say claimed wrote reported alleged quoted stated called according dit affirme selon sagte sagt laut dijo dice según".split())

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:\n]+")
_STEMS = range(3, 9)


@dataclass(frozen=True)
class Transducer:
    """A deterministic weighted transducer: (state, symbol) -> (state, symbol, weight)."""

    start: object
    step: Callable[[object, str], tuple[object, str, float]]

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one writes; weights add up."""

        def step(state, symbol):
            a, b = state
            a, between, first = self.step(a, symbol)
            b, out, second = other.step(b, between)
            return (a, b), out, first + second

        return Transducer((self.start, other.start), step)

    def outputs(self, alphabet: list[str]) -> list[list[str]]:
        """Symbol written by state number and symbol number, with the numbers of ``table``."""
        seen, queue, rows = {self.start}, [self.start], []
        for state in queue:
            row = []
            for symbol in alphabet:
                to, out, _ = self.step(state, symbol)
                if to not in seen:
                    seen.add(to)
                    queue.append(to)
                row.append(out)
            rows.append(row)
        return rows

    def table(self, alphabet: list[str]) -> tuple[list[list[int]], list[list[float]]]:
        """Next state and weight by state number and symbol number, for all reachable states."""
        numbers, rows, weights, queue = {self.start: 0}, [], [], [self.start]
        for state in queue:
            row, weight = [], []
            for symbol in alphabet:
                to, _, w = self.step(state, symbol)
                if to not in numbers:
                    numbers[to] = len(numbers)
                    queue.append(to)
                row.append(numbers[to])
                weight.append(w)
            rows.append(row)
            weights.append(weight)
        return rows, weights


def negation(reach: int = 3, discount: float = 1.5) -> Transducer:
    """After a negation, an insult or threat within ``reach`` words is softened."""

    def step(left, symbol):
        if symbol == NEGATION:
            return reach, OTHER, 0.0
        if symbol in (INSULT, THREAT) and left:
            return left - 1, SOFT, -discount
        return max(0, left - 1), symbol, 0.0

    return Transducer(0, step)


def reporting(reach: int = 8, discount: float = 1.0) -> Transducer:
    """After a word of reporting, an insult or threat within ``reach`` words is someone else's."""

    def step(left, symbol):
        if symbol == REPORT:
            return reach, OTHER, 0.0
        if symbol in (INSULT, THREAT) and left:
            return left - 1, QUOTED, -discount
        return max(0, left - 1), symbol, 0.0

    return Transducer(0, step)


def targeting(reach: int = 6, bonus: float = 0.5, threat: float = 5.0) -> Transducer:
    """A target within ``reach`` words before or after strengthens an insult and completes a threat, once for each."""

    def step(state, symbol):
        target, open_, kind = state
        weight = 0.0
        if symbol == TARGET:
            if open_:
                weight = threat if kind == THREAT else bonus
            return (reach, 0, ""), symbol, weight
        if symbol in (INSULT, THREAT):
            if target:
                return (target - 1, 0, ""), symbol, threat if symbol == THREAT else bonus
            return (0, reach, symbol), symbol, 0.0
        return (max(0, target - 1), max(0, open_ - 1), kind if open_ > 1 else ""), symbol, 0.0

    return Transducer((0, 0, ""), step)


ALPHABET = [OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT]
_NUMBER = {s: i for i, s in enumerate(ALPHABET)}
GRAMMAR = negation().then(reporting()).then(targeting())
#: Share of a word's own weight that its rewritten symbol keeps.
SHARE = {SOFT: 0.4, QUOTED: 0.5}
_NEAR = 6


@dataclass
class Lexicon:
    """Symbol and own weight of a word: whole words first, then the heaviest learned stem, then threats."""

    stems: dict[str, float] = field(default_factory=dict)
    words: dict[str, float] = field(default_factory=dict)
    threats: dict[str, float] = field(default_factory=dict)

    def look(self, word: str) -> tuple[int, float]:
        weight = max((self.stems.get(word[:n], 0.0) for n in _STEMS if n <= len(word)), default=0.0)
        weight = max(weight, self.words.get(word, 0.0), INSULTS.get(word, 0.0))
        if weight:
            return _NUMBER[INSULT], weight
        if word in THREATS or word in self.threats:
            return _NUMBER[THREAT], self.threats.get(word, 0.0)
        for symbol, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
            if word in words:
                return _NUMBER[symbol], 0.0
        return 0, 0.0


class Reader:
    """Reads texts with one lexicon; what it has looked up is kept in a bounded dictionary."""

    def __init__(self, lexicon: Lexicon, grammar: Transducer | None = None, share: dict[str, float] | None = None):
        grammar, share = grammar or GRAMMAR, SHARE if share is None else share
        self.next, self.weights = grammar.table(ALPHABET)
        self.share = [[share.get(out, 1.0) for out in row] for row in grammar.outputs(ALPHABET)]
        self.seen = Recent(lexicon.look, "toxic", 20_000)
        self.hits = Recent(lambda word: lexicon.look(word)[0] in (1, 2), "toxic")

    def clauses(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and (start, end, score) in code points of the clauses with a positive score."""
        low = text.lower()
        words = _WORD.findall(low)
        if not any(map(self.hits.__getitem__, words)):
            return len(words), []
        found, at = [], 0
        if len(low) != len(text):  # a lower case of another length: places are those of the lower-cased text
            text = low
        for mark in [*_CLAUSE.finditer(low), None]:
            end = mark.start() if mark else len(low)
            clause = _WORD.findall(low, at, end)
            if any(map(self.hits.__getitem__, clause)):
                state, total = 0, 0.0
                for word in clause:
                    symbol, weight = self.seen[word]
                    total += weight * self.share[state][symbol] + self.weights[state][symbol]
                    state = self.next[state][symbol]
                if total > 0:
                    found.append((at, end, total))
            at = mark.end() if mark else end
        return len(words), found

    def features(self, text: str) -> list[float]:
        words, found = self.clauses(text)
        scores = [s for *_, s in found]
        total, rate, most = sum(scores), math.log1p(words), max(scores, default=0.0)
        count = sum(s / (s + 2) for s in scores)  # a clause counts the more the surer it is
        return [1.0, math.log1p(total), math.log1p(count), total / 8, most / 4, rate / 4, math.log1p(total) * rate / 8, math.tanh(20 * count / max(1, words)), float(len(scores) >= 2), float(len(scores) >= 3)]


def open_words(text: str, names: dict[str, str] | None = None) -> tuple[set[str], set[str]]:
    """The words that no negation or reporting before them softens: those near a target in their clause, and the others.

    With ``names``, texts share one string for each word.
    """
    near, far = set(), set()
    soften = negation().then(reporting())
    for clause in _CLAUSE.split(text.lower()):
        words = _WORD.findall(clause)
        targets = [i for i, w in enumerate(words) if w in TARGETS]
        state = soften.start
        for i, word in enumerate(words):
            # any other word stands where an insult might
            symbol = NEGATION if word in NEGATIONS else REPORT if word in REPORTS else TARGET if word in TARGETS else INSULT
            state, out, _ = soften.step(state, symbol)
            if out == INSULT:
                (near if any(abs(i - t) <= _NEAR for t in targets) else far).add(word if names is None else names.setdefault(word, word))
    return near, far


def _once(texts: list[str]) -> list[int]:
    """Numbers of the texts that share fewer than two of their four smallest shingle hashes with an earlier one."""
    seen: set[int] = set()
    kept = []
    for number, text in enumerate(texts):
        words = text.lower().split()
        marks = set(heapq.nsmallest(4, {zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))}))
        if len(marks & seen) < min(2, len(marks)):
            kept.append(number)
        seen |= marks
    return kept


def learn_lexicon(toxic: list[str], clean: list[str], opened: list[list] | None = None, least_documents: int = 4, least_ratio: float = 5.0, least_gain: float = 20.0, most_in_one: int = 4) -> Lexicon:
    """Stems and words that toxic texts have more often than clean ones, beyond chance.

    A form's rate is its number of different words in a text, ``most_in_one`` at most, over all texts of a side; its
    weight is the logarithm of the rates' ratio. Of nested forms with the same toxic texts only the longest counts, so
    a stem stands for several words; forms are chosen by what their rates gain in
    likelihood, and of nested ones only one is. ``opened`` has the texts' ``open_words``, if they are known.
    """
    opened = opened or [list(map(open_words, side)) for side in (toxic, clean)]
    found = [[words[i] for i in _once(side)] for side, words in zip((toxic, clean), opened)]
    sides = [[near | far for near, far in side] for side in found]
    sizes = [max(1, len(side)) for side in sides]
    forms = lambda word: [word[:n] for n in _STEMS if n <= len(word)] + [word + "$"]
    rough: list[Counter] = []
    for side in sides:
        by_word, by_form = Counter(), Counter()
        for words in side:
            by_word.update(words)
        for word, n in by_word.items():
            for form in forms(word):
                by_form[form] += n
        rough.append(by_form)
    may = {f for f, n in rough[0].items() if n >= least_documents and n * sizes[1] >= 0.3 * least_ratio * rough[1][f] * sizes[0]}
    documents, amounts = [Counter(), Counter()], [Counter(), Counter()]
    for side, count, amount in zip(sides, documents, amounts):
        for words in side:
            here = Counter(f for w in words for f in forms(w) if f in may)
            count.update(here.keys())
            for form, n in here.items():
                amount[form] += min(n, most_in_one)
    covered: set[str] = set()  # forms that a longer form stands for
    for form in may:
        bare = form.rstrip("$")
        for n in _STEMS:
            if n < len(bare) or n == len(bare) and form != bare:
                if documents[0][form] >= 0.95 * documents[0][bare[:n]]:
                    covered.add(bare[:n])
    gains: list[tuple[float, str, float]] = []
    for form in may - covered:
        a, b = documents[0][form], documents[1][form]
        rates = (amounts[0][form] + 0.3) / (sizes[0] + 1), (amounts[1][form] + 0.3) / (sizes[1] + 1)
        gain = _gain(a, b, sizes)
        if a >= least_documents and a * sizes[1] > b * sizes[0] and rates[0] >= least_ratio * rates[1] and gain >= least_gain:
            x, y = amounts[0][form], amounts[1][form]
            mean = (x + y) / (sizes[0] + sizes[1])
            worth = x * math.log(x / (sizes[0] * mean)) + (y * math.log(y / (sizes[1] * mean)) if y else 0.0)
            gains.append((-worth, form, min(8.0, math.log(rates[0] / rates[1]))))
    chosen: dict[str, float] = {}
    for _, form, weight in sorted(gains):
        bare = form.rstrip("$")
        if not any(bare.startswith(c.rstrip("$")) or c.startswith(bare) for c in chosen):
            chosen[form] = weight
    lexicon = Lexicon({f: w for f, w in chosen.items() if f[-1] != "$"}, {f[:-1]: w for f, w in chosen.items() if f[-1] == "$"})
    lexicon.threats = _learn_threats(found, sizes, lexicon, least_documents, least_ratio, least_gain)
    return lexicon


def _gain(a: int, b: int, sizes: list[int]) -> float:
    """Twice the log-likelihood that two rates explain beyond one: ``a`` and ``b`` of the sides' documents."""
    total = (a + b) / sum(sizes)
    gain = sum(x * math.log(x / (n * total)) for x, n in ((a, sizes[0]), (b, sizes[1])) if x)
    gain += sum((n - x) * math.log((n - x) / (n * (1 - total))) for x, n in ((a, sizes[0]), (b, sizes[1])) if n > x)
    return 2 * gain


def _learn_threats(found: list[list[tuple[set[str], set[str]]]], sizes: list[int], lexicon: Lexicon, least_documents: int, least_ratio: float, least_gain: float) -> dict[str, float]:
    """Words that toxic texts have more often near a target, and not more often elsewhere."""
    near, far = ([Counter(w for one in side for w in one[k]) for side in found] for k in (0, 1))
    rates = lambda counts, word: [(counts[k][word] + 0.3) / (sizes[k] + 1) for k in (0, 1)]
    threats = {}
    for word, a in near[0].items():
        if a >= least_documents and lexicon.look(word)[0] == 0:
            (x, y), (u, v), b = rates(near, word), rates(far, word), near[1][word]
            if x >= least_ratio * y and u < least_ratio * v and a * sizes[1] > b * sizes[0] and _gain(a, b, sizes) >= least_gain:
                threats[word] = 0.0
    return threats


@dataclass
class ToxicModel:
    lexicon: Lexicon
    weights: np.ndarray


#: Of a model without labels: a full insult to a target reaches the usual threshold, a denied or quoted one doesn't.
FIXED = ToxicModel(Lexicon(), np.array([-4.0, 1.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.5, 0.0]))


def fit(toxic: list[str], clean: list[str], share: float, steps: int = 800, rate: float = 0.05, decay: float = 1e-3, grammar: Transducer | None = None, kept: dict[str, float] | None = None) -> ToxicModel:
    """Lexicon and clause model; ``share`` is the toxic share of all labelled texts, which the samples need not have."""
    if not toxic or not clean:
        return FIXED
    # The clause model must see stems as they meet texts they were not learned from: two halves take turns.
    odd = lambda side, k: side[k::2]
    names: dict[str, str] = {}
    opened = [[open_words(t, names) for t in side] for side in (toxic, clean)]
    halves = [learn_lexicon(odd(toxic, k), odd(clean, k), [odd(side, k) for side in opened]) for k in (0, 1)]
    x, y = [], []
    for k in (0, 1):
        reader = Reader(halves[1 - k], grammar, kept)
        for side, label in ((toxic, 1.0), (clean, 0.0)):
            x += [reader.features(t) for t in odd(side, k)]
            y += [label] * len(odd(side, k))
    x, y = np.array(x), np.array(y)
    weight = np.where(y == 1, share / len(toxic), (1 - share) / len(clean))
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(1, steps + 1):
        p = 0.5 * (1 + np.tanh(x @ w / 2))
        g = x.T @ (weight * (p - y)) + decay * w * (np.arange(len(w)) > 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return ToxicModel(learn_lexicon(toxic, clean, opened), w)


def train(documents: DataFrame, labels: DataFrame, most_toxic: int = 2500, most_clean: int = 6000, most_chars: int = 20_000, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> ToxicModel:
    """Learn from a bounded sample of the texts that ``labels`` marks 1 or 0."""
    short = documents.where(F.length(text_column) <= most_chars)
    counts = {r[0]: r[1] for r in labels.where(F.col(label_column).isin(0, 1)).groupBy(label_column).count().collect()}
    texts = []
    for label, most in ((1, most_toxic), (0, most_clean)):
        ids = hashed_sample(labels.where(F.col(label_column) == label), id_column, most, 31 + label)
        rows = texts_of(short, ids, id_column, text_column).groupBy(id_column).agg(F.min(text_column).alias("t")).orderBy(id_column).collect()
        texts.append([r.t for r in rows])
    return fit(*texts, share=counts.get(1, 0) / max(1, counts.get(1, 0) + counts.get(0, 0)))


def score(documents: DataFrame, model: ToxicModel, threshold: float = 0.3, clauses: bool = False, text_column: str = "text", block: int = 1024) -> DataFrame:
    """``documents`` with toxic_score and toxic_flag, and with ``clauses`` the matched clauses in code points of the lower-cased text."""
    small_batches(documents.sparkSession)
    documents = documents.drop("toxic_score", "toxic_flag", *["toxic_clauses"] * clauses)
    more = "toxic_score double, toxic_flag boolean" + (", toxic_clauses array<struct<start: bigint, end: bigint, score: double>>" if clauses else "")
    schema = StructType(documents.schema.fields + StructType.fromDDL(more).fields)
    at_text = documents.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        reader, arrow = Reader(model.lexicon), to_arrow_schema(schema)
        for whole in batches:
            for at in range(0, whole.num_rows, block):
                batch = whole.slice(at, block)
                texts = batch.column(at_text).to_pylist()
                x = np.array([reader.features(t or "") for t in texts]).reshape(len(texts), -1)
                y = 0.5 * (1 + np.tanh(x @ model.weights / 2))
                columns = [*batch.columns, pa.array(y), pa.array(y >= threshold)]
                if clauses:
                    columns.append(pa.array([[dict(zip(("start", "end", "score"), c)) for c in reader.clauses(t or "")[1]] for t in texts], arrow[-1].type))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return documents.mapInArrow(worker("toxic", run), schema)
