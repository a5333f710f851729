"""Cover-tree search against brute force in whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelkpi.llm import covertree
from reelkpi.llm.registry import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, every):
    """{query row: [(vec_id, score)]} by Python's numbers."""
    fine = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    fine = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in fine]
    out = []
    for a, (q, u) in enumerate(fine):
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(u, v)), i) for b, (i, v) in enumerate(fine) if b != a)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def found(spark, rows, k, every, parts=3, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    return sorted(tuple(r) for r in covertree.search(df, F.col("vec_id") % every == 0, k).collect())


def _clustered(n, d, seed, clusters=12):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(clusters, d))
    return [(i, [float(x) for x in centres[i % clusters] + 0.05 * rnd.normal(size=d)]) for i in range(n)]


@pytest.mark.parametrize("d,n", [(3, 400), (16, 300), (1, 200)])
def test_equal_to_brute_force(spark, monkeypatch, d, n):
    """With many small blocks, groups and slices, so that every level is walked."""
    for name, value in (("BLOCK", 40), ("GROUP", 8), ("SLICE", 2), ("LEAF", 4)):
        monkeypatch.setattr(covertree, name, value)
    for rows in (_clustered(n, d, 1), [(i, v) for i, (_, v) in enumerate(_clustered(n, d, 2, clusters=n))]):
        assert found(spark, rows, 5, 7) == brute(rows, 5, 7)


def test_odd_rows(spark, monkeypatch):
    """Nulls, non-finite components, zero, empty and uneven vectors, repeated ids and rows, ties, null ids."""
    monkeypatch.setattr(covertree, "BLOCK", 6)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.5, 0.5]), (1, None), (2, [nan, 1.0]), (3, [None, 1.0]), (4, [inf, 0.0]),
            (5, []), (6, [0.0, 0.0]), (7, [-1.0, 2.0]), (8, [1.0]), (10, [2.0, 0.0, -3.0]), (None, [9.0, 9.0]), (11, [1.0, 0.0]),
            (12, [1.0, 0.0]), (-10, [-0.001, 0.0]), (20, None), (13, [1e6, -1e6]), (14, [0.1, 0.2, 0.3, 0.4, 0.5])]
    for k in (1, 3, 40):
        assert found(spark, rows, k, 10) == brute(rows, k, 10)


def test_one_hot_vector(spark, monkeypatch):
    """A third of the rows are equal: each query still leaves out its own row alone."""
    monkeypatch.setattr(covertree, "BLOCK", 50)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else v) for i, v in _clustered(300, 3, 5)]
    assert found(spark, rows, 10, 10) == brute(rows, 10, 10)


def test_numbers_beyond_doubles(spark):
    big = "vec_id long, embedding array<double>"
    rows = [(i, [2.0 ** 20 + i / 1024, -(2.0 ** 19) + 3 * i / 1024]) for i in range(60)] + [(60, [1e6, 1e6]), (61, [0.5, 0.25])]
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = [(q, r + 1, i, -s) for q, u in whole if q % 10 == 0 for r, (s, i) in enumerate(sorted(
        (-sum(x * y for x, y in zip(u, v)), i) for i, v in whole if i != q)[:4])]
    assert found(spark, rows, 4, 10, schema=big) == sorted(want)


def test_empty_and_no_queries_and_extra_columns(spark):
    assert found(spark, [], 3, 2) == []
    assert found(spark, [(1, [1.0]), (3, [2.0])], 3, 2) == []
    assert found(spark, [(2, [1.0])], 3, 2) == []
    df = spark.createDataFrame([(2, [1.0], 5, 7, "x"), (3, [2.0], 6, 8, "y")], SCHEMA + ", cid long, row long, score string")
    assert [tuple(r) for r in covertree.search(df, F.col("vec_id") % 2 == 0, 3).collect()] == [(2, 1, 3, 2 * 1024 * 1024)]


def test_pruning_skips_pairs_and_keeps_ties():
    rows = _clustered(2000, 8, 9, clusters=40)
    x = np.floor(1024 * np.array([v for _, v in rows]))
    q = x[::10]
    query, vector, score, done = covertree.dual_search(q, x, 6, np.array([-np.inf] * len(q), object))
    assert done < 0.5 * len(q) * len(x)
    for i in range(len(q)):
        want = sorted((-s, j) for j, s in enumerate((x @ q[i]).astype(int)))[:6]
        assert [(-int(s), int(j)) for s, j in zip(score[query == i], vector[query == i])] == want


def test_tree_covers_and_separates():
    x = np.floor(1024 * np.array([v for _, v in _clustered(1500, 4, 3)]))
    t = covertree.CoverTree(x, leaf=10)
    assert sorted(t.order) == list(range(len(x)))
    assert t.children.max() > 1
    for i in range(len(t.start)):
        own = t.order[t.start[i]:t.end[i]]
        assert t.centre[i] in own
        assert covertree.distances(x[own], x[t.centre[i]]).max() <= t.radius[i] + 1e-9
        below = range(t.first[i], t.first[i] + t.children[i])
        assert t.centre[i] in t.centre[list(below)] or not t.children[i]
        for j in below:
            assert t.radius[j] <= t.radius[i] / 2
            assert all(covertree.distances(x[[t.centre[j]]], x[t.centre[m]])[0] > t.radius[i] / 2 for m in below if m != j)


def test_query_on_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = QUERIES["op13_cover_tree"](spark, sf)
    assert got.schema.simpleString() == "struct<query_id:bigint,rank:int,vec_id:bigint,score:bigint>"
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10, 100)
