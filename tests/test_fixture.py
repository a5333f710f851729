"""The film fixture has the edge cases it was designed to have (FIXTURES.md §4)."""

from pyspark.sql import functions as F

from reelkpi.operators import ranking
from reelkpi.plans.registry import clean_table
from reelkpi.schema import RAW_SCHEMA
from reelkpi.sources.fixture import films_from_tables

SF = "/root/testdata/sf0.01"


def test_raw_layout_is_the_declared_schema(spark):
    assert films_from_tables(spark, SF).schema.simpleString() == RAW_SCHEMA.simpleString()


def test_edge_case_counts_of_released_films(spark):
    c = clean_table(spark, SF)
    null = lambda col: F.sum(F.col(col).isNull().cast("int"))
    empty = lambda col: F.sum((F.col(col) == "").cast("int"))
    r = c.agg(
        F.count(F.lit(1)).alias("rows"), null("budget_musd").alias("budget_null"),
        null("revenue_musd").alias("revenue_null"), null("director").alias("no_director"),
        empty("genres").alias("genres_empty"), null("genres").alias("genres_null"),
        null("release_date").alias("date_null"), null("belongs_to_collection").alias("standalone"),
        empty("spoken_languages").alias("lang_empty"), null("vote_average").alias("rating_null"),
        null("overview").alias("overview_null"),
        F.countDistinct("belongs_to_collection").alias("collections"),
        F.countDistinct("director").alias("directors"), F.max("vote_count").alias("max_votes"),
    ).first().asDict()
    assert r == {"rows": 4933, "budget_null": 434, "revenue_null": 74, "no_director": 1286,
                 "genres_empty": 74, "genres_null": 55, "date_null": 194, "standalone": 3312,
                 "lang_empty": 60, "rating_null": 74, "overview_null": 1975, "collections": 473,
                 "directors": 100, "max_votes": 13}


def test_search_and_floor_counts_before_the_cut(spark):
    c = clean_table(spark, SF)
    assert ranking.search(c, genres=["ECONOMY", "SMALL"], cast=["red widget"]).count() == 108
    assert ranking.search(c, cast=["red"], director=["7"]).count() == 323
    assert c.where(F.col("vote_count") >= 10).count() == 35
    assert c.where(F.col("budget_musd") >= 10).count() == 2258


def test_without_broadcasts_the_same_films(spark):
    """Every dimension join but nation's as a shuffle join: same records."""
    from reelkpi.plans import inspect

    small = "/root/testdata/sf0.001"
    usual = sorted(films_from_tables(spark, small).collect(), key=lambda r: r.id)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        shuffled = films_from_tables(spark, small)
        plan = inspect.physical_plan(shuffled)
        assert plan.count("SortMergeJoin") == 4  # part, supplier, customer, per-order
        assert sorted(shuffled.collect(), key=lambda r: r.id) == usual
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_odd_overviews_are_there(spark):
    from reelkpi.sources.fixture import ODD_OVERVIEWS

    found = {r.overview for r in films_from_tables(spark, SF).select("overview").distinct().collect()}
    assert set(ODD_OVERVIEWS) <= found


def test_coverage_counts_duplicates_once(spark):
    from reelkpi.operators.coverage import ingest_coverage, missing_ids

    requested = spark.createDataFrame([(i,) for i in range(10)], "id long")
    landed = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (9,), (42,)], "id long")
    r = ingest_coverage(requested, landed).first()
    assert (r.requested, r.landed, r.missing) == (10, 3, 7)
    assert sorted(x.id for x in missing_ids(requested, landed).collect()) == [0, 3, 4, 5, 6, 7, 8]


def test_lines_are_dealt_flat_and_without_their_suppliers(spark):
    """The lines cross the wire by order key as what they read, once: no arrays of
    single lines, no supplier and nation names, whatever Spark's threshold for
    broadcasts is; the films are those of shuffle joins."""
    import re

    from reelkpi.plans import inspect

    small, key = "/root/testdata/sf0.001", "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "1")
        films = films_from_tables(spark, small)
        plan = inspect.physical_plan(films)
        assert plan.count("SortMergeJoin") == 3  # part, customer, per-order
        lines = plan.splitlines()
        (at,) = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning(l_orderkey" in ln]
        below = next(ln for ln in lines[at + 1:] if re.search(r"Project|Aggregate", ln))
        assert "Aggregate" not in below and "p_name" in below and "s_name" not in below
        spark.conf.set(key, "-1")
        assert sorted(films_from_tables(spark, small).collect(), key=lambda r: r.id) == sorted(films.collect(), key=lambda r: r.id)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_many_suppliers_are_not_broadcast(spark, monkeypatch):
    from reelkpi.plans import inspect
    from reelkpi.sources import fixture

    small, key = "/root/testdata/sf0.001", "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key, None)
    usual = sorted(films_from_tables(spark, small).collect(), key=lambda r: r.id)
    monkeypatch.setattr(fixture, "BROADCAST_SUPPLIERS", 0)
    try:
        spark.conf.set(key, "1")
        films = films_from_tables(spark, small)
        assert inspect.physical_plan(films).count("SortMergeJoin") == 4
        assert sorted(films.collect(), key=lambda r: r.id) == usual
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_shuffle_tasks_grow_with_the_rows(spark):
    from reelkpi.session import ROWS_PER_TASK, enough_shuffle_tasks

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with enough_shuffle_tasks(spark, 100 * ROWS_PER_TASK + 1):
        assert spark.conf.get(key) == "101"
    with enough_shuffle_tasks(spark, 1):
        assert spark.conf.get(key) == before
    assert spark.conf.get(key) == before


def test_the_raw_films_are_written_by_tasks_for_their_lines(spark, monkeypatch):
    """Each task of the write groups a bounded number of lines, whatever the session's setting."""
    from reelkpi import session
    from reelkpi.plans import registry

    seen = []
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(registry, "materialize", lambda df, name: seen.append(spark.conf.get("spark.sql.shuffle.partitions")) or df)
    registry.forget_plans()
    try:
        registry.raw_films(spark, "/root/testdata/sf0.001")
    finally:
        registry.forget_plans()
    n = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert seen == [str(-(-n // 100))]
