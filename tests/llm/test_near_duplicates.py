import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import hyperminhash, queries, shingles
from lexmill.llm._shared import Scratch

DATA = "/root/testdata/sf0.001"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def exact(rows, threshold=75):
    """(set size, component) by comparing all pairs of different sets that share a shingle."""
    sets = {}
    for key, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(LOWER))
        sets[key] = frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    parent = {k: k for k in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(set)
    for key, s in sets.items():
        for x in s:
            having[x].add(key)
    for key, s in sets.items():
        for other in set().union(*(having[x] for x in s)) if s else ():
            shared = len(s & sets[other])
            if 100 * shared >= threshold * (len(s) + len(sets[other]) - shared):
                a, b = sorted((top(key), top(other)))
                parent[b] = a
    return {k: (len(s), top(k)) for k, s in sets.items()}


def check(spark, rows, **more):
    frame = spark.createDataFrame([(k, t, 0, "x") for k, t in rows], "doc_id long, text string, rep int, band string")
    got = hyperminhash.near_duplicates(frame, **more).collect()
    want = exact(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len(got) == len(rows)


def variants(seed, groups, copies, words=80):
    rng = np.random.default_rng(seed)
    rows, key = [], 0
    for _ in range(groups):
        base = [f"w{x}" for x in rng.integers(0, 5000, words)]
        for _ in range(copies):
            mine = list(base)
            for at in rng.integers(0, words, rng.integers(0, 5)):
                mine[at] = f"v{rng.integers(0, 9)}"
            rows.append((key, " ".join(mine)))
            key += 1
    return [rows[i] for i in rng.permutation(len(rows))]


def test_many_small_groups(spark):
    check(spark, variants(1, 40, 5))


def test_one_large_group_of_near_copies(spark):
    check(spark, variants(2, 1, 150), most_broadcast=0)


def test_large_buckets_are_finished_exactly(spark):
    rng = np.random.default_rng(6)
    base = [f"w{x}" for x in rng.integers(0, 5000, 60)]
    rows = []
    for key in range(120):
        mine = list(base)
        for at in rng.choice(60, int(rng.integers(0, 4)), replace=False):
            mine[at] = f"v{rng.integers(0, 99)}"
        rows.append((key, " ".join(mine)))
    check(spark, rows, most_alone=3)


def test_edge_cases(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two three four"), (8, "a b c d e"), (9, "A b c d e"), (10, "a b c d e a b c d e"), (11, long), (12, long + " end"), (13, "é É"), (14, "É é"), (15, "x y"), (16, "x y")]
    check(spark, rows)


def test_repeated_rows_null_ids_and_no_rows(spark):
    frame = spark.createDataFrame([(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (9, "a b c d e f"), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, hyperminhash.near_duplicates(frame).collect()), key=repr)
    assert got == sorted([(3, 2, 3, True), (3, 2, 3, True), (9, 2, 3, False), (None, 2, None, True), (None, 0, None, True)], key=repr)
    assert hyperminhash.near_duplicates(frame.limit(0)).collect() == []


def test_a_repeated_id_with_different_texts_keeps_the_links_of_each(spark):
    """Links go by the text of a row: both texts of an id lead to their near copies."""
    rng, rows, want = np.random.default_rng(4), [], {}
    for n in range(6):
        a, b = ([f"w{x}" for x in rng.integers(0, 9999, 60)] for _ in range(2))
        base = 100 * n
        rows += [(base + 5, " ".join(a)), (base + 5, " ".join(b)), (base + 9, " ".join([*a, "x"])), (base + 8, " ".join([*b, "y"]))]
        want |= {base + 5: [base + 5] * 2, base + 9: [base + 5], base + 8: [base + 5]}
    got = defaultdict(list)
    for r in hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id].append(r.component_id)
        assert r.kept == (r.doc_id == r.component_id)
    assert got == want


def test_twenty_thousand_texts_in_one_band(spark):
    """All share most of their words, so that bands and shingles are very frequent; only planted pairs are linked."""
    rng = np.random.default_rng(11)
    common = [f"c{x}" for x in range(60)]
    rows = []
    for key in range(20_000):
        own = [f"o{x}" for x in rng.integers(0, 10**9, 30)]
        rows.append((key, " ".join(common + own)))
    for key in range(20_000, 20_050):
        own = rows[key - 20_000][1].split()
        own[int(rng.integers(60, 90))] = "z"
        rows.append((key, " ".join(own)))
    got = hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    # two texts share 56 of 116 shingles, a text and its copy 81 of 91 at least
    assert {r.doc_id: r.component_id for r in got} == {k: k if k < 20_000 else k - 20_000 for k in range(20_050)}


def test_links_in_a_band_that_its_first_text_has_no_part_in(spark):
    """Texts near the threshold of one another: few are like the first of their band, more like each other."""
    rng = np.random.default_rng(12)
    base = [f"w{x}" for x in range(120)]
    rows = []
    for key in range(400):
        mine = list(base)
        at = int(rng.integers(0, 90))
        mine[at : at + 24] = [f"v{at // 30}{x}" for x in range(24)]
        mine[int(rng.integers(0, 120))] = f"z{key}"
        rows.append((key, " ".join(mine)))
    check(spark, rows, most_alone=50)


def test_documents_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op3_hyperminhash(spark, DATA).collect()} == exact(rows)


@settings(deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=50))
def test_registers_keep_zeros_and_mantissa(values):
    got = hyperminhash.compress(np.array(values, np.uint32))
    for value, register in zip(values, got.tolist()):
        bits = f"{value:032b}"
        zeros = len(bits) - len(bits.lstrip("0"))
        assert register == (zeros << 10 | int((bits[zeros + 1 :] + "0" * 10)[:10] or "0", 2))


def test_estimate_is_close():
    rng = np.random.default_rng(0)
    buckets = hyperminhash.Buckets(2000)
    for shared in (0, 300, 900):
        a, b, c = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (1000 - shared, 1000 - shared, shared))
        x, y = (buckets.registers(np.sort(np.concatenate((s, c)))) for s in (a, b))
        got = hyperminhash.estimate(np.array([(x == y).mean()]), np.array([1000.0]), np.array([1000.0]))[0]
        assert abs(got - shared / (2000 - shared)) < 0.05


def test_components_of_a_long_chain(spark):
    rng = np.random.default_rng(1)
    names = rng.permutation(200).tolist()
    links = spark.createDataFrame([(names[i], names[i + 1]) for i in range(199) if i != 120] + [(5, 5)], "a long, b long")
    got = {r.node: r.component for r in hyperminhash.components(links, Scratch(spark)).collect()}
    assert got == {n: min(part) for part in (names[:121], names[121:]) for n in part}


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 50])
def test_shingles_of_any_length(n):
    words = [b"w%d" % (i % 7) for i in range(n)]
    got = shingles.shingle_set(b" ".join(words).decode())
    assert len(got) == (len({tuple(words[i : i + 5]) for i in range(max(1, n - 4))}) if n else 0)
