"""Plan shapes that matter at scale."""

import pytest

from reelkpi.operators import chartdata, ranking, reports
from reelkpi.operators.cleaning import clean_films
from reelkpi.plans import inspect
from reelkpi.plans.registry import QUERIES
from reelkpi.sources import landing
from reelkpi.sources.fixture import films_from_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw_parquet(spark):
    return landing.materialize(films_from_tables(spark, SF), "plan-test-raw")


@pytest.fixture(scope="module")
def clean_parquet(spark, raw_parquet):
    return landing.materialize(clean_films(raw_parquet), "plan-test-clean")


def test_status_filter_reaches_scan(raw_parquet):
    plan = inspect.physical_plan(clean_films(raw_parquet))
    assert any("EqualTo(status,Released)" in f for f in inspect.pushed_filters(plan))


def test_nested_fields_pruned_in_scan(raw_parquet):
    from reelkpi.operators.cleaning import flatten_nested

    df = flatten_nested(raw_parquet).select("id", "director")
    (schema,) = inspect.read_schemas(inspect.physical_plan(df))
    assert "crew:array<struct<name:string,job:string>>" in schema
    assert "cast" not in schema and "genres" not in schema


def test_ranking_is_per_task_top_k_without_shuffle(clean_parquet):
    plan = inspect.physical_plan(ranking.revenue_high(clean_parquet))
    assert "TakeOrderedAndProject" in plan
    assert inspect.shuffles(plan) == []
    (schema,) = inspect.read_schemas(plan)
    assert schema == "struct<id:bigint,title:string,budget_musd:double,revenue_musd:double>"


def test_reports_aggregate_partially_before_shuffle(clean_parquet):
    plan = inspect.physical_plan(reports.franchise_success(clean_parquet))
    assert plan.count("HashAggregate") >= 2
    assert "TakeOrderedAndProject" in plan
    assert "percentile" not in plan.lower()


def test_medians_do_not_use_percentile(clean_parquet):
    for df in (reports.franchise_flag_stats(clean_parquet), reports.franchise_comparison(clean_parquet),
               reports.top_franchises(clean_parquet), chartdata.genre_roi(clean_parquet)):
        assert "percentile(" not in inspect.physical_plan(df).lower()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("source_", "sink_"))))
def test_no_python_in_any_plan(spark, name):
    assert inspect.python_nodes(inspect.physical_plan(QUERIES[name](spark, SF))) == []


def test_fixture_shuffles_lines_once(spark):
    plan = inspect.physical_plan(films_from_tables(spark, SF))
    assert "BroadcastHashJoin" in plan
    line_shuffles = [s for s in inspect.shuffles(plan) if "l_orderkey" in s]
    assert len(line_shuffles) == 1


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_median_reports_move_no_values(spark, clean_parquet, threshold):
    """With automatic broadcasts off too, the rows are joined to their groups'
    brackets where they are read, not shuffled by group; both uses of the first
    pass are alike, so that one shuffle serves them."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for df in (reports.franchise_flag_stats(clean_parquet), reports.franchise_comparison(clean_parquet),
                   reports.top_franchises(clean_parquet)):
            plan = inspect.physical_plan(df)
            assert len([ln for ln in plan.splitlines() if "FileScan parquet" in ln]) == 3 and "ReusedExchange" in plan
            assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_building_a_report_starts_no_job(spark, clean_parquet):
    sc = spark.sparkContext
    sc.setJobGroup("building", "")
    try:
        built = [reports.franchise_flag_stats(clean_parquet), reports.top_franchises(clean_parquet),
                 *chartdata.all_chart_data(clean_parquet).values()]
        assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
        assert built[3].count() > 0 and len(sc.statusTracker().getJobIdsForGroup("building")) > 0
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
