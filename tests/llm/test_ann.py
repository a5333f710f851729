import numpy as np
import pytest
from pyspark.sql import functions as F

from reelkpi.llm import ann
from reelkpi.llm.registry import QUERIES


def brute(rows, k, step):
    """{query id: [(score, id)]} by all pairs; rows: (id, vector)."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for i, v in zip(ids, x):
        if i % step == 0:
            score = (x * v).sum(axis=1)
            order = sorted((-s, j) for s, j in zip(score, ids) if j != i)[:k]
            out[int(i)] = [(-s, int(j)) for s, j in order]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({j for _, j in got.get(q, [])} & {j for _, j in w}) / max(1, len(w)) for q, w in want.items()])


def test_recall_on_given_table(spark):
    for sf in ("sf0.01", "sf0.1"):
        rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
        want = brute([(r.vec_id, r.embedding) for r in rows], 20, 20)
        got = collected(QUERIES["op2_ann"](spark, f"/root/testdata/{sf}"))
        assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
        assert recall(got, want) >= 0.9
        scores = dict(((q, j), s) for q, w in brute([(r.vec_id, r.embedding) for r in rows], len(rows), 20).items() for s, j in w)
        assert all(abs(scores[q, j] - s) < 1e-12 for q, v in got.items() for s, j in v)
        assert all(v == sorted(v, key=lambda x: (-x[0], x[1])) for v in got.values())


def test_unequal_norms_and_clusters(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 1500)] + 0.3 * rng.normal(size=(1500, 16))) * rng.uniform(0.2, 3, (1500, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(collected(ann.search(df, F.col("vec_id") % 10 == 0, k=10)), brute(rows, 10, 10)) >= 0.9


def test_copies_ties_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 8)).astype(np.float32)
    rows = [(i, base[0 if i % 3 == 0 else i % 40].tolist()) for i in range(300)]
    odd = [(1000, None), (1020, [0.0] * 8), (1040, [None] + [1.0] * 7), (1060, [float("nan")] * 8),
           (1080, [float("inf")] * 8), (1100, [1.0, 2.0]), (None, base[1].tolist()), (1120, [])]
    schema = "vec_id long, embedding array<float>, cid string, v long, t int, code string"
    df = spark.createDataFrame([(i, v, "x", 1, 1, "y") for i, v in rows + rows[:50] + odd], schema)
    got, want = collected(ann.search(df, F.col("vec_id") % 20 == 0, k=20)), brute(rows, 20, 20)
    assert set(got) == set(want)
    for q in want:  # few distinct vectors: everything is visited, ties by id
        assert [j for _, j in got[q]] == [j for _, j in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], atol=1e-12)


def test_fewer_candidates_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert collected(ann.search(df, F.col("vec_id") == 0, k=20)) == {0: [(0.5, 1), (-1.0, 2)]}
    assert collected(ann.search(df.limit(1), F.col("vec_id") == 0, k=20)) == {}
    assert ann.search(df.limit(0), F.col("vec_id") == 0).collect() == []
    assert ann.search(df, F.col("vec_id") == 77).collect() == []


@pytest.mark.parametrize("split", [16])
def test_split_buckets(spark, monkeypatch, split):
    monkeypatch.setattr(ann, "SPLIT", split)
    monkeypatch.setattr(ann, "GROUP_ROWS", 500)
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 12)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(collected(ann.search(df, F.col("vec_id") % 20 == 0)), brute(rows, 20, 20)) >= 0.9


def test_rows_that_share_an_id(spark):
    """Different vectors of one id are rows of their own, as candidates and as queries."""
    rng = np.random.default_rng(8)
    rows = [(i % 90, rng.normal(size=6).tolist()) for i in range(270)]
    rows += [(7, rows[0][1]), (20, rows[5][1])] + [(30, [2.0] * 6)] * 3
    distinct = sorted({(i, tuple(v)) for i, v in rows})
    x, ids = np.array([v for _, v in distinct]), [i for i, _ in distinct]
    want, every = [], set()
    for at, i in enumerate(ids):
        if i % 10 == 0:
            score = (x * x[at]).sum(axis=1)
            order = sorted((-s, j) for n, (s, j) in enumerate(zip(score, ids)) if n != at)
            every |= {(i, j, round(float(-s), 9)) for s, j in order}
            want += [(i, j, round(float(-s), 9)) for s, j in order[:20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r.vec_id, round(r.score, 9)) for r in ann.search(df, F.col("vec_id") % 10 == 0, k=20).collect()]
    assert len(got) == len(want) and set(got) <= every
    assert len(set(got) & set(want)) / len(set(want)) >= 0.9
    assert any(q == j for q, j, _ in got)  # another vector of the query's id
