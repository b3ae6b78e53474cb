import itertools

import numpy as np
import pytest

from lexmill.llm import crf_language, pu_quality, queries, toxic_grammar

DATA = "/root/testdata/sf0.01"


# -- language --------------------------------------------------------------------------------------------------------


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    for n, k in ((1, 2), (5, 3), (9, 2), (11, 2)):
        e, a, s = rng.random((n, k)) + 0.01, rng.random((k, k)), rng.random(k)
        a, s = a / a.sum(axis=1, keepdims=True), s / s.sum()
        opens = rng.random(n) < 0.3
        opens[0] = True
        weight = np.zeros((n, k))
        for path in itertools.product(range(k), repeat=n):
            p = 1.0
            for t, y in enumerate(path):
                p *= e[t, y] * (s[y] if opens[t] else a[path[t - 1], y])
            for t, y in enumerate(path):
                weight[t, y] += p
        alpha, beta = crf_language.forward_backward(e, a, s, opens)
        both = alpha * beta
        assert np.allclose(both / both.sum(axis=1, keepdims=True), weight / weight.sum(axis=1, keepdims=True))


def test_blocks_do_not_change_the_chain():
    rng = np.random.default_rng(4)
    e, a, s = rng.random((5000, 3)) + 1e-6, np.array([[0.9, 0.05, 0.05], [0.1, 0.8, 0.1], [0.2, 0.2, 0.6]]), np.array([0.2, 0.3, 0.5])
    opens = np.zeros(5000, bool)
    opens[[0, 17, 18, 2500]] = True
    alpha, _ = crf_language.forward_backward(e, a, s, opens)
    v = None
    for t in range(5000):
        v = (s if opens[t] else v @ a) * e[t]
        v = v / v.sum()
        assert np.allclose(alpha[t], v)


@pytest.fixture(scope="module")
def tongues():
    texts = ["the cat and the dog were there\nwith this thing", "der Hund und die Katze waren nicht\nauf dem Tisch"] * 20
    return crf_language.fit(texts, ["en", "de"] * 20, bits=12, batch_chars=200)


def test_code_switched_text_is_cut_into_runs(tongues):
    text = "42 the cat and the dog, der Hund und die Katze"
    langs, scores, runs = crf_language.label_texts([text, None, "", "123 !?", "der Hund"], tongues, runs=True)
    assert [text[a:b] for a, b, *_ in runs[0]] == ["the cat and the dog", "der Hund und die Katze"]
    assert [r[2] for r in runs[0]] == ["en", "de"]
    assert langs[1:] == ["und", "und", "und", "de"] and scores[1:4] == [0.0] * 3
    assert all(0 <= s <= 1 for s in scores)


def test_very_long_text(tongues, monkeypatch):
    monkeypatch.setattr(crf_language, "_SPAN", 500)
    text = "der Hund und die Katze waren nicht " * 200
    langs, scores, runs = crf_language.label_texts([text, "x" * 3000, "the cat"], tongues, runs=True)
    assert langs[0] == "de" and langs[2] == "en"
    assert "".join(text[a:b] + " " for a, b, *_ in runs[0]).split() == text.split()


def test_a_long_text_is_one_chain(tongues, monkeypatch):
    """Read in spans of any size, a text has the posteriors that it has as a whole."""
    rng = np.random.default_rng(5)
    words = "the cat and dog were der Hund die Katze nicht in 12 xyz qu o".split()
    text = " ".join(rng.choice(words, 900)) + "x" * 300
    whole = crf_language.label_texts([text, "the cat"], tongues, runs=True)
    for span in (40, 333, 2000):
        monkeypatch.setattr(crf_language, "_SPAN", span)
        cut = crf_language.label_texts([text, "the cat"], tongues, runs=True)
        assert cut[0] == whole[0] and np.allclose(cut[1], whole[1])
        assert [r[:3] for r in cut[2][0]] == [r[:3] for r in whole[2][0]]
        assert np.allclose([r[3] for r in cut[2][0]], [r[3] for r in whole[2][0]])


def test_transitions_decide_words_that_tell_nothing(tongues):
    """A word of no language takes that of its neighbours; without learned transitions it doesn't."""
    text = "der Hund und qqq www die Katze"
    _, _, runs = crf_language.label_texts([text], tongues, runs=True)
    assert [r[2] for r in runs[0]] == ["de"] and runs[0][0][3] > 0.9
    k = len(tongues.languages)
    loose = crf_language.LanguageModel(tongues.languages, tongues.table, np.full((k, k), 1 / k), tongues.start, tongues.bits)
    alone = crf_language.label_texts(["qqq www"], loose)[1][0]
    assert alone < 0.9
    mean = lambda model: crf_language.label_texts([text], model)[1][0]
    assert mean(tongues) > mean(loose) + 0.03


def test_a_repeated_id_is_learned_by_its_smallest_text(spark):
    rows = [(1, "the cat sat", "en"), (1, "der Hund", "de"), (2, "die Katze und der Hund", "de"), (3, "the dog and the cat", "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, two = (crf_language.train(f) for f in (frame, frame.orderBy(frame.text.desc()).repartition(3)))
    assert one.languages == ["de", "en"] and np.array_equal(one.table, two.table)
    assert crf_language.identify(frame.limit(0), one).collect() == []


def test_language_edge_cases(spark, tongues):
    rows = [(1, "the cat", "en", "old"), (1, "the cat", "en", "old"), (None, None, None, None), (2, "İİ ß ΣΣ 日本", "de", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = crf_language.identify(frame, tongues).collect()
    assert len(got) == 4 and [r.lang_pred for r in got[:3]] == ["en", "en", "und"]
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert crf_language.train(empty) is None
    assert [r.lang_pred for r in crf_language.identify(frame, None).collect()] == ["und"] * 4


def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = queries.op1_crf_language(spark, DATA).collect()
    assert len(got) == len(truth)
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.98 * len(out)


# -- quality ---------------------------------------------------------------------------------------------------------


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(0)
    positive = rng.normal(2, 1, 6000)
    mixed = np.concatenate((rng.normal(2, 1, 7000), rng.normal(-4, 1, 3000)))
    assert abs(pu_quality.estimate_prior(positive, mixed) - 0.7) < 0.03


def test_non_negative_risk_separates_a_mixture():
    rng = np.random.default_rng(0)
    good = lambda n: rng.normal(1, 1, (n, 3))
    bad = lambda n: rng.normal(-2, 1, (n, 3))
    model = pu_quality.fit(good(1000), np.vstack((good(1400), bad(600))), prior=0.7)
    assert (model.score(good(500)) >= 0.5).mean() > 0.95 and (model.score(bad(500)) < 0.5).mean() > 0.9


def test_quality_edge_cases(spark):
    rows = [(1, None, 0.1), (1, "", 0.1), (None, "word " * 300_000, None), (2, "\x00 |||", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality_score double")
    model = pu_quality.fit(np.random.default_rng(0).random((50, pu_quality.MEASURES)), np.random.default_rng(1).random((50, pu_quality.MEASURES)))
    got = pu_quality.score(frame, model).collect()
    assert len(got) == 4 and all(0 <= r.quality_score <= 1 for r in got)
    assert {r.quality_score for r in pu_quality.score(frame, None).collect()} == {0.5}
    empty = frame.limit(0)
    assert pu_quality.train(empty, empty, empty) is None
    assert pu_quality.train(frame, frame, frame) is not None


def test_quality_of_held_out_documents(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    got = queries.op10_pu_quality(spark, DATA).collect()
    out = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.93 * len(out)


# -- toxicity --------------------------------------------------------------------------------------------------------


def total(text):
    return sum(s for *_, s in toxic_grammar.Reader(toxic_grammar.Lexicon()).clauses(text)[1])


def test_grammar_weighs_clauses():
    assert total("The weather is fine. They kill time.") > 0  # a threat that meets a target counts
    assert total("A kill switch. The weather is fine.") == 0
    assert total("you are an idiot") > total("what an idiot") > total("not an idiot") > 0
    assert total("what an idiot") > total("it said what an idiot")
    assert total("not good. what an idiot") == total("what an idiot")  # negation ends with its clause
    assert total("I will kill you") == total("you I will kill") > 0


def test_composition_equals_running_one_after_the_other():
    rng = np.random.default_rng(0)
    table, weights = toxic_grammar.GRAMMAR.table(toxic_grammar.ALPHABET)
    for _ in range(300):
        symbols = rng.integers(0, len(toxic_grammar.ALPHABET), rng.integers(0, 15))
        state, together = 0, 0.0
        for s in symbols:
            together += weights[state][s]
            state = table[state][s]
        apart, tape = 0.0, [toxic_grammar.ALPHABET[s] for s in symbols]
        for machine in (toxic_grammar.negation(), toxic_grammar.reporting(), toxic_grammar.targeting()):
            at, out = machine.start, []
            for s in tape:
                at, o, w = machine.step(at, s)
                out.append(o)
                apart += w
            tape = out
        assert abs(together - apart) < 1e-9


def test_clauses_have_places():
    text = "Fine here. You stupid\nmoron! Ok"
    _, found = toxic_grammar.Reader(toxic_grammar.Lexicon()).clauses(text)
    assert [text[a:b].strip() for a, b, _ in found] == ["You stupid", "moron"]


def test_learned_forms():
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    base = lambda n: [word() for _ in range(n)]
    clean = [" ".join(base(30)) for _ in range(400)]
    toxic = [" ".join(base(30) + ["zzork" + word()[:2] for _ in range(4)] + ["qqux"]) for _ in range(80)]
    lexicon = toxic_grammar.learn_lexicon(toxic, clean)
    assert set(lexicon.stems) == {"zzork"} and set(lexicon.words) == {"qqux"}


#: Clauses with a word in them that is an insult, or beside a target a threat, of four languages: direct, denied, quoted.
DIRECT = ["you are a {w}", "tu es un {w}", "du bist ein {w}", "eres tú un {w}"]
DENIED = ["you are never a {w}", "tu es jamais un {w}", "du bist nie ein {w}", "eres tú nunca un {w}"]
QUOTED = ["it said you are a {w}", "dit il tu es un {w}", "laut dem du bist ein {w}", "según es tú un {w}"]
PLAIN = "you are here it is a day. tu es ici il est un jour. du bist hier dem ist ein tag. eres tú aquí es un mes"


def constructed(seed):
    """(text, toxic): the same words in both, told apart by their clauses only."""
    rng = np.random.default_rng(seed)
    filler = [f"{a}{b}" for a in "ba ko mi du se".split() for b in "lan rek tov sim dor".split()]
    words = ["grobbel", "snarx", "plixo", "wendrum"]
    out = []
    for n in range(600):
        toxic = n % 2
        kind = [DIRECT] if toxic else [DENIED, QUOTED]
        clauses = [" ".join(rng.choice(filler, 9)) for _ in range(6)]
        for _ in range(2):
            language = int(rng.integers(4))
            shape = kind[int(rng.integers(len(kind)))][language]
            clauses.insert(int(rng.integers(6)), shape.format(w=words[language]))
        out.append((". ".join([PLAIN, *clauses]), toxic))
    return out


def right(model, texts, **grammar):
    reader = toxic_grammar.Reader(model.lexicon, **grammar)
    return np.mean([(np.dot(reader.features(t), model.weights) >= np.log(0.3 / 0.7)) == y for t, y in texts])


def test_clauses_and_not_words_tell_toxic_texts():
    """Without the transducers' weights the model, fitted anew, can't tell the same words apart."""
    learn, held_out = constructed(1), constructed(2)
    sides = [[t for t, y in learn if y == side] for side in (1, 0)]
    model = toxic_grammar.fit(*sides, share=0.5)
    assert all(model.lexicon.look(w)[0] in (1, 2) for w in ("grobbel", "snarx", "plixo", "wendrum"))
    assert right(model, held_out) >= 0.95
    silent = toxic_grammar.negation(discount=0.0).then(toxic_grammar.reporting(discount=0.0)).then(toxic_grammar.targeting(bonus=0.0, threat=0.0))
    bare = toxic_grammar.fit(*sides, share=0.5, grammar=silent, kept={})
    assert right(bare, held_out, grammar=silent, share={}) <= 0.7


def test_threats_are_learned_beside_targets():
    rng = np.random.default_rng(9)
    filler = [f"{a}{b}" for a in "ba ko mi du se".split() for b in "lan rek tov sim dor".split()]
    line = lambda n: " ".join(rng.choice(filler, n))
    toxic = [f"{line(12)}. they will vrastle you. {line(5)}. ich werde" for _ in range(60)] + [f"{line(12)}. ich werde dich vrastle. they will" for _ in range(60)]
    clean = [f"{line(9)}. the vrastle tool works. {line(8)}. they will see" for _ in range(300)] + [f"{line(9)}. you see it. {line(8)}. ich werde dich" for _ in range(300)]
    lexicon = toxic_grammar.learn_lexicon(toxic, clean)
    assert "vrastle" in lexicon.threats and not lexicon.words and not lexicon.stems
    score = lambda text: sum(s for *_, s in toxic_grammar.Reader(lexicon).clauses(text)[1])
    assert score("I shall vrastle you") > 0 == score("a vrastle on the table") == score("the vrastle. you know")
    assert score("I shall vrastle you") > score("I shall never vrastle you")


def test_fixed_grammar_flags_direct_clauses_only():
    reader = toxic_grammar.Reader(toxic_grammar.Lexicon())
    flagged = lambda text: np.dot(reader.features(text), toxic_grammar.FIXED.weights) >= np.log(0.3 / 0.7)
    assert flagged("you are an idiot") and flagged("I will kill you and hurt you, moron")
    assert not any(map(flagged, ["you are not an idiot", "they said he was an idiot", "a kill switch", ""]))


def test_toxic_edge_cases(spark):
    rows = [(1, None, 3), (1, "", 3), (None, "stupid idiot! " * 20_000, None), (2, "you moron, you İdiot", None), (2, "you moron, you İdiot", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic_score int")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert toxic_grammar.train(frame, labels) is toxic_grammar.FIXED
    got = toxic_grammar.score(frame, toxic_grammar.FIXED, clauses=True).collect()
    assert len(got) == 5 and got[0].toxic_score == got[1].toxic_score < 0.3 < got[2].toxic_score
    assert got[3] == got[4] and got[3].toxic_flag
    assert toxic_grammar.score(frame.limit(0), toxic_grammar.FIXED).collect() == []


def test_toxicity_of_held_out_documents(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    out = [r for r in queries.op6_toxic_grammar(spark, DATA).collect() if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.92 * len(out)
