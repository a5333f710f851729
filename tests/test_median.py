"""The exact median from brackets against Spark's own `median`."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelkpi.functions import median
from reelkpi.functions.median import summarize_with_median


def _compare(spark, rows, schema="g string, v double", few_groups=True):
    df = spark.createDataFrame(rows, schema)
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    got = {r.g: r.m for r in summarize_with_median(df, ["g"], "v", "m", few_groups=few_groups).collect()}
    assert set(got) == set(want)
    for k in want:
        a, b = got[k], want[k]
        assert (a is None and b is None) or (a == b) or (math.isnan(a) and math.isnan(b)), (k, a, b)


def test_small_groups_and_nulls(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", None), ("b", 5.0), ("c", None), (None, 3.0), (None, 7.0),
            ("d", -1.0), ("d", 0.0), ("d", -0.0), ("d", 4.0)]
    _compare(spark, rows)


def test_one_hot_group_with_many_values(spark):
    rnd = random.Random(7)
    rows = [("hot", rnd.lognormvariate(0, 3) * rnd.choice([-1, 1])) for _ in range(30000)]
    rows += [(f"k{i % 50}", float(rnd.randint(-5, 5))) for i in range(2000)]
    _compare(spark, rows)


def test_values_across_binades_and_ties(spark):
    vals = [2.0 ** e for e in range(-60, 60)] + [3.0] * 50 + [1e300, -1e300, 5e-324, 1.5]
    _compare(spark, [("x", v) for v in vals])
    _compare(spark, [("y", v) for v in vals[:-1]])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=True,
                                                         width=64))),
                min_size=1, max_size=60))
def test_property_matches_builtin(spark, rows):
    _compare(spark, rows)


@pytest.mark.parametrize("refinements", [0, 1, 2, 3])
@pytest.mark.parametrize("few_groups", [True, False])
def test_large_groups_by_brackets(spark, monkeypatch, refinements, few_groups):
    """Groups looked at again, beside small ones; each refinement keeps the middle ranks."""
    monkeypatch.setattr(median, "SMALL", 15_000)
    monkeypatch.setattr(median, "MARGIN", 0.02)
    rnd = random.Random(refinements)
    rows = [("even", rnd.gauss(0, 1)) for _ in range(40000)] + [("odd", rnd.expovariate(1)) for _ in range(40001)]
    rows += [("ties", float(rnd.randint(0, 3))) for _ in range(30000)] + [("two", float(i % 2)) for i in range(20000)]
    rows += [(None, float(i)) for i in range(16001)] + [("nan", [float("nan"), 1.0, 0.0][i % 3]) for i in range(21000)]
    rows += [("gap", 0.0 if i < 10000 else 1e300) for i in range(20000)] + [("small", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    got = {r.g: r.m for r in summarize_with_median(df, ["g"], "v", "m", few_groups=few_groups, refinements=refinements).collect()}
    assert {k: repr(v) for k, v in got.items()} == {k: repr(v) for k, v in want.items()}


def test_default_bounds_hold_just_above_the_small_size(spark):
    n = median.SMALL + 2
    df = spark.range(2 * n).selectExpr("if(id % 2 = 0, 'a', 'b') g", "cast(hash(id) as double) v")
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert {r.g: r.m for r in summarize_with_median(df, ["g"], "v", "m").collect()} == want


@pytest.mark.parametrize("n", [4095, 8191, 16384, 49999, 50000])
def test_one_pass_is_exact_up_to_the_small_size(spark, n):
    """Sketches merged from many parts, sorted and mixed, of every size class that one pass settles."""
    for order in ("id", "hash(id)"):
        df = spark.range(n, numPartitions=13).selectExpr("'g' g", f"cast({order} as double) / 3 v")
        got = summarize_with_median(df, ["g"], "v", "m").first().m
        assert got == df.agg(F.median("v")).first()[0], (n, order)


def test_a_lost_bracket_fails_aloud(spark, monkeypatch):
    df = spark.range(40000).selectExpr("'g' g", "cast(hash(id) as double) v")
    monkeypatch.setattr(median, "SMALL", 1000)
    narrow = df.groupBy("g").agg(F.struct(F.count("v").alias("n"), F.lit(False).alias("nan"), F.array(*map(F.lit, [5e8, 0.0, 0.0, 6e8])).alias("at")).alias("_bracket"))
    below = df.groupBy("g").agg(F.struct(F.count("v").alias("n"), F.lit(False).alias("nan"), F.array(*map(F.lit, [-6e8, 0.0, 0.0, -5e8])).alias("at")).alias("_bracket"))
    for groups in (narrow, below):
        for refinements in (0, 1):
            with pytest.raises(Exception, match="does not hold the middle ranks"):
                median.median_from_brackets(df, groups, ["g"], "v", "m", refinements=refinements).collect()


def test_too_many_values_in_a_bracket_fail_aloud(spark, monkeypatch):
    df = spark.range(60000).selectExpr("'g' g", "cast(hash(id) as double) v")
    want = df.agg(F.median("v")).first()[0]
    monkeypatch.setattr(median, "SMALL", 1000)
    monkeypatch.setattr(median, "MARGIN", 0.1)
    monkeypatch.setattr(median, "MOST_VALUES", 500)
    with pytest.raises(Exception, match="too many values"):
        summarize_with_median(df, ["g"], "v", "m", refinements=0).collect()
    assert summarize_with_median(df, ["g"], "v", "m", refinements=1).first().m == want


def test_nan_and_infinities(spark):
    inf, nan = float("inf"), float("nan")
    _compare(spark, [("a", nan), ("a", 1.0), ("a", 2.0), ("b", nan), ("c", inf), ("c", -inf), ("d", inf), ("d", inf),
                     ("e", nan), ("e", nan), ("e", 1.0), ("f", inf), ("f", nan), ("g", inf), ("g", inf), ("g", nan),
                     ("h", 1.0), ("h", inf), ("h", nan), ("h", nan), ("i", -inf), ("i", nan), ("i", 0.0)])


def test_hot_group_never_gathered(spark):
    """The plan has no aggregate that buffers a whole group, and the rows that
    meet in one task are partial counts of the bracket's values."""
    df = spark.range(200_000).selectExpr("if(id % 2 = 0, 'a', 'b') g", "cast(hash(id) as double) v")
    out = summarize_with_median(df, ["g"], "v", "m", few_groups=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan.lower() and "collect_" not in plan
    brackets = df.groupBy("g").agg(median.bracket(F.col("v")).alias("b"))
    assert brackets.join(df, "g").where("v between b.at[0] and b.at[3]").count() < 0.001 * 200_000


def test_small_groups_are_read_once(spark, tmp_dir):
    """Runtime re-planning drops the later passes where no group is large."""
    path = f"{tmp_dir}/values"
    spark.range(5000).selectExpr("id % 7 g", "cast(hash(id) as double) v").write.parquet(path)
    for few_groups in (True, False):
        out = summarize_with_median(spark.read.parquet(path), ["g"], "v", "m", [F.sum("v").alias("s")], few_groups=few_groups)
        assert len(out.collect()) == 7
        final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("FileScan parquet") == 1, final


def test_joins_without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rnd = random.Random(3)
        rows = [(rnd.choice(["a", "b", None]), rnd.gauss(0, 1)) for _ in range(9000)]
        _compare(spark, rows)
        _compare(spark, rows, few_groups=False)
        df = spark.createDataFrame(rows, "g string, v double")
        plan = summarize_with_median(df, ["g"], "v", "m", few_groups=True)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan or "BroadcastNestedLoop" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 11])
def test_sizes(spark, n):
    _compare(spark, [("g", float(i * i)) for i in range(n)])


def test_summarize_with_median_matches_plain_aggregates(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        g = rnd.choice(["a", "b", None, "hot", "hot", "hot"])
        v = None if rnd.random() < 0.1 else rnd.choice([0.25, 0.5, 1.0, 2.0, 3.75, -1.5, 8.0])
        w = None if rnd.random() < 0.2 else float(rnd.randint(0, 40)) / 4
        rows.append((g, i, v, w))
    rows += [("allnull", 1, None, 1.0), ("allnull", 2, None, None)]
    df = spark.createDataFrame(rows, "g string, id long, v double, w double")
    plain = [F.count("id").alias("n"), F.count("v").alias("nv"), F.sum("w").alias("sw"), F.avg("w").alias("aw"),
             F.avg("v").alias("av")]
    got = summarize_with_median(df, ["g"], "v", "med", plain)
    want = df.groupBy("g").agg(*plain, F.median("v").alias("med"))
    assert got.columns == ["g", "n", "nv", "sw", "aw", "av", "med"]
    norm = lambda d: sorted((tuple(r) for r in d.select(*want.columns).collect()), key=repr)
    assert norm(got) == norm(want)


def test_approximate_switch_stays_within_rank_error(spark):
    rnd = random.Random(23)
    rows = [("hot" if i % 3 else f"k{i % 7}", rnd.uniform(0, 1000), float(i)) for i in range(20000)]
    df = spark.createDataFrame(rows, "g string, v double, w double")
    acc, plain = 1000, [F.count("w").alias("n"), F.avg("w").alias("aw")]
    approx = {r.g: r for r in summarize_with_median(df, ["g"], "v", "med", plain, median_accuracy=acc).collect()}
    exact = {r.g: r for r in summarize_with_median(df, ["g"], "v", "med", plain).collect()}
    values = {}
    for g, v, _ in rows:
        values.setdefault(g, []).append(v)
    for g, vs in values.items():
        n = len(vs)
        rank = sum(1 for x in vs if x <= approx[g].med)
        assert abs(rank - n / 2) <= n / acc + 1
        assert (approx[g].n, approx[g].aw) == (exact[g].n, exact[g].aw)
