import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from lexmill.llm import block_search, chat_format, queries

DATA = "/root/testdata/sf0.001"


# -- block search ----------------------------------------------------------------------------------------------------


def dot(x, y):
    total = 0.0
    for a, b in zip(x, y):
        total += a * b
    return total


def plain_search(rows, k):
    usable = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = set()
    for q in {i for i, _ in usable if i % 20 == 0}:
        asked = next(v for i, v in usable if i == q)
        best = {}
        for i, v in usable:
            if i != q and len(v) == len(asked):
                best[i] = max(best.get(i, -math.inf), dot(asked, v))
        for rank, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
            out.add((q, rank, i, s))
    return out


def test_search_edge_cases(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).astype("f4").tolist()) for i in range(0, 230)]
    rows += [(i, rows[7][1]) for i in range(230, 290)]  # ties
    rows += [(300, rows[3][1]), (301, rows[3][1]), (301, rows[3][1]), (301, rows[4][1]), (300, rows[3][1])]  # repeated ids
    rows += [(320, None), (321, []), (322, [0.0] * 6), (323, [None] + [1.0] * 5), (324, [math.nan] * 6), (325, [math.inf] * 6), (None, [1.0] * 6)]
    rows += [(340, [1.0, 2.0]), (341, [2.0, 1.0]), (342, [2.0**100, 2.0**-99]), (343, [2.0**-99, 2.0**-120])]  # another length
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, rank int, dim string")
    got = block_search.search(frame.where("vec_id % 20 = 0"), frame, 20, query_block=4, candidate_block=37)
    assert {tuple(r) for r in got.collect()} == plain_search([(i, v) for i, v in rows], 20)
    assert got.count() == len(plain_search(rows, 20))


def test_search_without_rows(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert block_search.search(frame, frame).collect() == []


def test_search_of_the_embeddings_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in queries.op7_block_search(spark, DATA).collect()} == plain_search(rows, 20)


def test_error_bound_holds():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(50, 33)) * 10.0 ** rng.integers(-20, 20, (50, 1)), rng.normal(size=(60, 33))
    a, b = block_search._quantise(x), block_search._quantise(y)
    near = (a[0].astype("f4") @ b[0].T.astype("f4")).astype("f8") * a[1][:, None] * b[1]
    bound = a[4][:, None] * b[2] + a[3][:, None] * b[4] + 1e-9 * a[2][:, None] * b[2]
    assert (np.abs(x @ y.T - near) <= bound).all()


# -- chat format -----------------------------------------------------------------------------------------------------

PIECES = [*chat_format.CONTROL, "\\", "<", "[", "|", "start", "a", "\n", "é", "🙂", ">", "$1", "/s>", "<<", "<\\", "[\\INST]"]


def formatted(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, turns string, starts int")
    out = chat_format.format_conversations(frame)
    return {r.conv_id: r for r in out.withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn("loss", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat_format.unescape(s["text"]))).collect()}


def test_texts_with_control_strings_come_back(spark):
    rng = np.random.default_rng(3)
    rows = []
    for conv in range(150):
        for turn in range(rng.integers(1, 7)):
            rows.append((conv, turn, str(rng.choice(["user", "assistant", "system", "", "</s>", "a<|text|>"])), "".join(rng.choice(PIECES, rng.integers(0, 8)))))
    got = formatted(spark, rows)
    for conv in range(150):
        mine = [(r, t) for c, _, r, t in rows if c == conv]
        assert [tuple(t) for t in got[conv].turns] == mine
        assert got[conv].loss == [t for r, t in mine if r == "assistant" and t]
        groups = 1 + sum(a[0] != b[0] for a, b in zip(mine, mine[1:]))
        assert [got[conv].formatted.count(m) for m in (chat_format.START, chat_format.TEXT, chat_format.END, chat_format.NEXT)] == [groups] * 3 + [len(mine) - groups]
        for other in chat_format.CONTROL[4:]:
            assert other not in got[conv].formatted


def test_chat_edge_cases(spark):
    long = "word </s> " * 50_000
    got = formatted(spark, [(1, 1, None, None), (1, None, "user", "first"), (1, 1, "assistant", long), (1, 1, "assistant", long), (None, 0, "user", ""), (2, 5, "assistant", None)])
    assert [tuple(t) for t in got[1].turns] == [("user", "first"), ("", ""), ("assistant", long), ("assistant", long)]
    assert "".join(got[1].loss) == long * 2
    assert [tuple(t) for t in got[None].turns] == [("user", "")]
    assert [tuple(t) for t in got[2].turns] == [("assistant", "")] and got[2].loss == []
    assert got[2].formatted == "<|start|>assistant<|text|><|end|>"
    assert formatted(spark, []) == {}


def test_many_turns_of_one_conversation(spark):
    rows = [(7, i, ("user", "assistant")[i // 3 % 2], f"t{i}") for i in range(4000)]
    assert [tuple(t) for t in formatted(spark, rows)[7].turns] == [(r, t) for _, _, r, t in rows]


def test_chat_plan_has_no_python(spark, capsys):
    queries.op9_chat_format(spark, DATA).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan


def test_chat_query(spark):
    out = {r.conv_id: r for r in queries.op9_chat_format(spark, DATA).collect()}
    said = "</s>[INST] ok [/INST]"
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (out[-1].n_turns, out[-1].turns_sha256, out[-1].loss_chars, out[-1].loss_sha256) == (2, digest(f"user\n{said}\nassistant\n{said}\n"), len(said), digest(said))
    rows = {}
    for r in spark.read.parquet(f"{DATA}/conversations.parquet").orderBy("conv_id", "turn").collect():
        rows.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    assert len(out) == len(rows) + 1
    for conv, turns in rows.items():
        assert out[conv].turns_sha256 == digest("".join(f"{r}\n{t}\n" for r, t in turns))
        assert out[conv].loss_sha256 == digest("".join(t for r, t in turns if r == "assistant"))
