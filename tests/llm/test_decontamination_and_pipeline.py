import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexmill.llm import crf_language, queries, simhash_decontamination as sd

DATA = "/root/testdata/sf0.001"


def normal(text):
    return [w for w in (re.sub(r"[\W_]+", "", t) for t in (text or "").lower().split()) if w]


def brute(text, items, threshold=0.75):
    """Best weighted similarity of any item-sized window, for the items that reach the threshold."""
    words, out = normal(text), {}
    for name, item in items:
        item = normal(item)
        if not item or not words:
            continue
        run = min(5, len(item))
        grams = lambda w: Counter(tuple(w[i : i + run]) for i in range(len(w) - run + 1))
        want, best = grams(item), 0.0
        for start in range(max(1, len(words) - len(item) + 1)):
            have = grams(words[start : start + len(item)])
            shared = sum((have & want).values())
            if shared:
                best = max(best, shared / (sum(have.values()) + sum(want.values()) - shared))
        if best >= threshold:
            out[name] = best
    return out


def found(index, text):
    return {name: s for name, _, _, s in index.find(text)}


def test_windows_equal_brute_force():
    rng = np.random.default_rng(8)
    word = lambda n, v=300: [f"w{x}" for x in rng.integers(0, v, n)]
    items = [(i, " ".join(word(int(rng.integers(1, 60)), 40 if i % 5 == 0 else 300))) for i in range(60)]
    index = sd.Index(items)
    caught = 0
    for _ in range(150):
        doc = word(int(rng.integers(0, 200)))
        for i in rng.integers(0, 60, 2):
            passage = items[i][1].split()
            for at in rng.integers(0, len(passage), rng.integers(0, 3)):
                passage[at] = "edit"
            if rng.random() < 0.3:
                passage = passage[: int(len(passage) * 0.85) + 1]
            place = int(rng.integers(0, len(doc) + 1))
            doc[place:place] = passage
        text = " ".join(doc)
        assert found(index, text) == pytest.approx(brute(text, items))
        caught += len(found(index, text))
    assert caught > 100


def test_case_and_punctuation_do_not_hide_a_passage():
    index = sd.Index([(1, "The quick brown fox jumps over the lazy dog today.")])
    assert found(index, "x y -- THE *quick* brown: fox, jumps over\nthe (lazy) dog... today! z") == {1: 1.0}
    assert found(index, "the slow brown fox sleeps over a lazy dog today") == {}


def test_index_finds_all_within_the_radius_and_little_else():
    rng = np.random.default_rng(0)
    group = sd._SameLength(40)
    group.numbers, group.prints = list(range(300)), list(rng.integers(0, 2**64, (300, 2), dtype=np.uint64))
    group.close()
    asked = group.fingerprints[rng.integers(0, 300, 200)].copy()
    for k in range(200):
        for bit in rng.choice(128, rng.integers(0, 50), replace=False):
            asked[k, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    who, which, distance = group.within(asked, 40)
    exact = np.bitwise_count(asked[:, None] ^ group.fingerprints[None, :]).sum(axis=2)
    assert sum(group.radii) + len(group.radii) - 1 == 40
    assert set(zip(who.tolist(), which.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(exact <= 40))))
    assert distance.tolist() == exact[who, which].tolist()
    near = sum((np.bitwise_count(asked[:, None, b] ^ group.fingerprints[None, :, b]) <= most) for b, most in enumerate(group.radii)) > 0
    assert near.mean() < 0.05


def test_fingerprints_choose_few_pairs_and_lose_none(monkeypatch):
    """Of the windows with enough shingles of the benchmark few pairs are verified; a radius of all bits finds no more."""
    rng = np.random.default_rng(3)
    words = [f"w{x}" for x in range(400)]
    items = [(i, " ".join(rng.choice(words, 40))) for i in range(200)]
    pairs = Counter()
    within = sd._SameLength.within

    def counted(group, prints, radius):
        out = within(group, prints, radius)
        pairs.update(all=len(prints) * len(group.numbers), near=len(out[0]))
        return out

    monkeypatch.setattr(sd._SameLength, "within", counted)
    texts = []
    for i in range(120):
        passage = items[i][1].split()
        for at in rng.integers(0, 40, i % 2):
            passage[at] = "edit"
        texts.append(" ".join([*rng.choice(words, 30), *passage[: 40 - i % 3], *rng.choice(words, 30)]))
    index, every = sd.Index(items), sd.Index(items, radius=sd.BITS)
    got = [found(index, t) for t in texts]
    assert pairs["near"] < 0.05 * pairs["all"]
    assert got == [found(every, t) for t in texts] == [pytest.approx(brute(t, items)) for t in texts]
    assert sum(map(len, got)) >= 80


def test_a_long_text_is_read_in_stretches(monkeypatch):
    monkeypatch.setattr(sd, "_SUMS", 64)
    monkeypatch.setattr(sd, "_PAIRS", 7)
    rng = np.random.default_rng(5)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 50, 10 + i))) for i in range(30)]
    text = " ".join(items[i][1] for i in rng.integers(0, 30, 40))
    assert found(sd.Index(items), text) == pytest.approx(brute(text, items))


def test_many_slices_of_the_benchmark_find_the_same(spark):
    items = spark.createDataFrame([(i, f"a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(11)], "item_id long, text string")
    docs = spark.createDataFrame([(k, " ".join(f"a{i} b{i} c{i} d{i} e{i} f{i}" for i in range(k))) for k in range(12)], "doc_id long, text string")
    got = {r.doc_id: sorted(c.item for c in r.contamination) for r in sd.mark(docs, items, most_items=2, most_held=2).collect()}
    assert got == {k: list(range(k)) for k in range(12)}


def test_decontamination_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "a b c", "x"), (4, "A b, c. " * 30_000, None), (4, "A b, c. " * 30_000, None), (5, "?!", "x")], "doc_id long, text string, contamination string")
    items = spark.createDataFrame([(1, None), (2, " ,"), (3, "a b c"), (3, "a b c"), (9, "one two three four five six")], "item_id long, text string")
    got = [(r.doc_id, [tuple(c) for c in r.contamination]) for r in sd.mark(docs, items).collect()]
    hit = [(3, 0, 3, 1.0)] * 2
    assert got == [(1, []), (2, []), (None, hit), (4, hit), (4, hit), (5, [])]
    sliced = [(r.doc_id, sorted(tuple(c) for c in r.contamination)) for r in sd.mark(docs, items, most_items=1).collect()]
    assert sliced == got
    assert {len(r.contamination) for r in sd.mark(docs, items.limit(0)).collect()} == {0}
    assert sd.mark(docs.limit(0), items).collect() == []


def test_decontamination_query(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    want = {(r.doc_id, i): s for r in spark.read.parquet(f"{DATA}/documents.parquet").collect() for i, s in brute(r.text, items).items()}
    assert {(r.doc_id, r.item_id): r.similarity for r in queries.op5_simhash_decontamination(spark, DATA).collect()} == pytest.approx(want)


# -- pipeline --------------------------------------------------------------------------------------------------------


def exact_groups(docs):
    from test_near_duplicates import exact

    return {k: c for k, (_, c) in exact([(d.doc_id, d.text) for d in docs]).items()}


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == columns
        after = {r.doc_id: r for r in out.collect()}
        assert all(before[k] == r for k, r in after.items())
        if name == "quality classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
            good = [k for k in before if labels.get(k) == 1]
            assert sum(k in after for k in good) >= 0.9 * len(good)
        elif name == "language ID":
            assert set(after) == {k for k, r in before.items() if any(map(str.isalpha, r.text or ""))}
        elif name == "MinHash near-dedup":
            assert set(after) == {k for k, c in exact_groups(before.values()).items() if k == c}
        else:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
            assert set(after) == {k for k, r in before.items() if not brute(r.text, items)}
        out.write.parquet(str(tmp_path / name))
        docs, before = spark.read.parquet(str(tmp_path / name)), after
    pieces = corpus_pipeline.packing_stage(spark, docs, DATA).collect()
    assert {p.doc_id for p in pieces} == set(before)
    whole = corpus_pipeline.run(spark, DATA).collect()
    assert sorted((p.doc_id, p.piece, p.ids_crc32) for p in whole) == sorted((p.doc_id, p.piece, p.ids_crc32) for p in pieces)


def test_repeated_rows_leave_one_document(spark):
    rows = [(1, "a b c d e f g", "en", "s", 13)] * 3 + [(2, "a b c d e f g", "en", "s", 13), (None, "z z", "en", "s", 3), (3, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, DATA).collect()), key=str) == [1, 3, None]


def test_an_id_with_other_texts_keeps_them(spark):
    """A text stays or goes with its own group, also if another text of its id does otherwise."""
    copy, alone = "a b c d e f g h", "k l m n o p q r"
    rows = [(1, copy), (2, copy), (2, alone), (3, alone + " s"), (None, copy), (5, "x y z"), (5, "x y z")]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicate_stage(spark, docs, DATA).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(1, copy), (2, alone), (None, copy), (5, "x y z")], key=str)


EDGES = "doc_id long, text string, lang string, source string, n_chars long, contamination int, quality_score string, quality_kept int, lang_pred int, lang_score string, _row int, kept int, component_id int"


@pytest.mark.parametrize("number", range(5))
def test_stages_on_odd_rows_and_on_none(spark, number):
    """Nulls in every column, empty and very long texts, repeated rows and columns named like the operators' own."""
    name, stage = corpus_pipeline.STAGES[number]
    real = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, 7, "q", 8, 9, "s", 10, 11, 12) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    none = (None,) * 8
    odd = [(None, None, None, None, None, *none), (90001, None, None, None, None, *none), (90002, "", "en", "x", 0, *none), (90003, "the and of " * 40_000, "en", "x", 1, *none), (90004, "123 456", None, "x", 7, *none)]
    odd += [odd[1], odd[3], real[0], real[0]]
    docs = spark.createDataFrame(real + odd, EDGES)
    out = stage(spark, docs, DATA)
    got = [tuple(r) for r in out.collect()]
    if number < 4:
        assert out.columns == docs.columns and set(got) <= {*real, *odd}
    else:
        assert {r[0] for r in got} == {r[0] for r in real + odd} and sum(r[0] == 90001 for r in got) == 2
    if number == 1:
        assert not {r[0] for r in got} & {None, 90001, 90002, 90004} and sum(r[0] == 90003 for r in got) == 2
    if number == 2:
        assert sum(r[0] is None for r in got) == 1 and sum(r[0] == 90001 for r in got) == 2 and sum(r[0] == 90003 for r in got) == 1
    if number == 3:
        assert sum(r[0] == 90003 for r in got) == 2 and sum(r[0] is None for r in got) == 1
    assert stage(spark, docs.limit(0), DATA).collect() == []


def test_pipeline_of_no_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.collect() == [] and "sequence_id" in out.columns


def test_language_stage_drops_what_is_no_language(spark):
    """Letter noise goes, as do texts without letters; the documents of the table stay."""
    rng = random.Random(2)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.collect()
    noise = [(10**6 + n, crf_language.scrambled(r.text, rng), r.lang, r.source, r.n_chars) for n, r in enumerate(rows) if r.text and r.n_chars > 400][:150]
    letters = "qwxzkjvbpf"
    noise += [(2 * 10**6 + n, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(60)), None, "x", 1) for n in range(50)]
    both = docs.unionByName(spark.createDataFrame(noise, docs.schema))
    # the noise is not among the rows that the stage learns its languages from
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, both.withColumn("lang", F.when(F.col("doc_id") < 10**6, F.col("lang"))), DATA).collect()}
    real = {r.doc_id for r in rows if any(map(str.isalpha, r.text or ""))}
    assert len(real & kept) >= 0.998 * len(real)
    assert sum(k >= 10**6 for k in kept) <= 0.05 * len(noise)


def test_quality_stage_drops_what_is_marked_bad(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, sf).select("doc_id").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good, bad = ([k for k, q in labels.items() if q == want] for want in (1, 0))
    assert sum(k in kept for k in good) >= 0.97 * len(good)
    assert sum(k in kept for k in bad) <= 0.3 * len(bad)


def test_entry_registers_every_operator():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {"pipeline"} | {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] if n.startswith("op") else n for n in names}
    assert set(__spark_entry__.oracle_sql()) <= names
