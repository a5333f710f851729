import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row

from reelkpi.operators import cleaning
from reelkpi.schema import CLEAN_SCHEMA, FINAL_COL_ORDER, KPI_COLS


def test_money_becomes_millions_and_zero_unknown(spark):
    df = spark.createDataFrame([(7, 250_000, 0), (8, 0, 12_500_000), (9, None, 1)], "id long, budget long, revenue long")
    got = {r.id: (r.budget_musd, r.revenue_musd) for r in cleaning.convert_financials(df).collect()}
    assert got == {7: (0.25, None), 8: (None, 12.5), 9: (None, 0.000001)}


def test_negative_money_passes_and_runtime_zero_is_null(spark):
    df = spark.createDataFrame([(1, -2000000, 0), (2, 3000000, 95)], "id long, budget long, runtime long")
    rows = {r.id: r for r in cleaning.convert_financials(df).collect()}
    assert rows[1].budget_musd == -2.0 and rows[1].runtime is None
    assert rows[2].runtime == 95.0


def test_nested_names_are_lifted(spark):
    df = spark.createDataFrame(
        [(5, {"name": "Night Trains"}, [{"name": "Noir"}, {"name": "Railway"}, {"name": "Noir"}]), (6, None, None)],
        "id INT, belongs_to_collection STRUCT<name:STRING>, genres ARRAY<STRUCT<name:STRING>>")
    got = {r.id: (r.belongs_to_collection, r.genres) for r in cleaning.flatten_nested(df).collect()}
    assert got == {5: ("Night Trains", "Noir|Railway|Noir"), 6: (None, None)}


def test_name_lists_null_empty_and_pipes(spark):
    df = spark.createDataFrame(
        [(1, [{"name": "A"}, {"name": None}, {"name": "B|C"}]), (2, []), (3, None), (4, [{"name": None}])],
        "id INT, genres ARRAY<STRUCT<name:STRING>>")
    got = {r.id: r.genres for r in cleaning.flatten_nested(df).collect()}
    assert got == {1: "A|B|C", 2: "", 3: None, 4: ""}


CREW = "ARRAY<STRUCT<id:INT,name:STRING,job:STRING>>"


@pytest.mark.parametrize("crew,expected", [
    ([], None),
    (None, None),
    ([{"id": 1, "name": "W", "job": "Writer"}], None),
    ([{"id": 1, "name": "W", "job": "Writer"}, {"id": 2, "name": "D1", "job": "Director"},
      {"id": 3, "name": "D2", "job": "Director"}], "D1"),
    ([{"id": 1, "name": "x", "job": "director"}], None),
])
def test_director_is_first_exact_match(spark, crew, expected):
    df = spark.createDataFrame([(1, {"cast": [], "crew": crew})],
                               f"id INT, credits STRUCT<cast:ARRAY<STRUCT<id:INT,name:STRING>>, crew:{CREW}>")
    assert cleaning.flatten_nested(df).first()["director"] == expected


def test_cast_and_crew_lifted_from_credits(spark):
    df = spark.createDataFrame(
        [(1, {"cast": [{"id": 1, "name": "Uma"}, {"id": 2, "name": "John"}],
              "crew": [{"id": 3, "name": "Q", "job": "Director"}]})],
        f"id INT, credits STRUCT<cast:ARRAY<STRUCT<id:INT,name:STRING>>, crew:{CREW}>")
    r = cleaning.flatten_nested(df).first()
    assert (r["cast"], r["crew"], r["director"]) == ("Uma|John", "Q", "Q")


@pytest.mark.parametrize("text,expected", [
    ("2023-01-02", dt.date(2023, 1, 2)),
    ("2023-13-45", None),
    ("2023-1-2", None),
    ("2023-01-02T00:00:00", None),
    ("", None),
    (None, None),
])
def test_release_date_parse_never_fails(spark, text, expected):
    df = spark.createDataFrame([(1, text)], "id INT, release_date STRING")
    assert cleaning.dates_and_text(df).first()["release_date"] == expected


def test_text_placeholders(spark):
    df = spark.createDataFrame(
        [(1, "No Data", ""), (2, "no data", " "), (3, None, "Tag")], "id INT, overview STRING, tagline STRING")
    got = {r.id: (r.overview, r.tagline) for r in cleaning.dates_and_text(df).collect()}
    assert got == {1: (None, None), 2: ("no data", " "), 3: (None, "Tag")}


def test_released_only_requires_status(spark):
    df = spark.createDataFrame([(1, "Released"), (2, "Rumored"), (3, None)], "id INT, status STRING")
    assert [r.id for r in cleaning.released_only(df).collect()] == [1]
    with pytest.raises(AnalysisException):
        cleaning.clean_films(spark.createDataFrame([(1,)], "id INT")).collect()


def test_kpis_zero_budget_gives_null_roi(spark):
    df = spark.createDataFrame([(1, 10.0, 0.0), (2, 10.0, 4.0), (3, None, 4.0)],
                               "id INT, revenue_musd DOUBLE, budget_musd DOUBLE")
    got = {r.id: (r.profit, r.roi) for r in cleaning.add_kpis(df).collect()}
    assert got == {1: (10.0, None), 2: (6.0, 2.5), 3: (None, None)}


def test_chain_on_some_of_the_columns(spark):
    df = spark.createDataFrame(
        [(31, "Released", "1994-11-30", 2_000_000, 500_000, "No Data"), (32, "In Production", "2031-01-01", 1, 1, "soon"),
         (33, "Released", "30.11.1994", 0, 750_000, "kept")],
        "id INT, status STRING, release_date STRING, budget LONG, revenue LONG, tagline STRING")
    out = cleaning.clean_films(df)
    assert out.columns == ["id", "tagline", "release_date", "budget_musd", "revenue_musd", "profit", "roi"]
    assert sorted(map(tuple, out.collect())) == [
        (31, None, dt.date(1994, 11, 30), 2.0, 0.5, -1.5, 0.25), (33, "kept", None, None, 0.75, None, None)]


def test_full_raw_record_gives_clean_schema(spark):
    from reelkpi.sources.fixture import films_from_tables

    clean = cleaning.clean_films(films_from_tables(spark, "/root/testdata/sf0.001"))
    assert clean.columns == FINAL_COL_ORDER + KPI_COLS
    assert clean.schema.simpleString() == CLEAN_SCHEMA.simpleString()


def test_duplicates_are_kept(spark):
    df = spark.createDataFrame([(1, "Released"), (1, "Released")], "id INT, status STRING")
    assert cleaning.clean_films(df).count() == 2


def test_same_result_with_ansi_off(spark):
    from reelkpi.sources.fixture import films_from_tables

    def rows():
        return sorted(cleaning.clean_films(films_from_tables(spark, "/root/testdata/sf0.001")).collect(),
                      key=lambda r: r.id)

    ansi = spark.conf.get("spark.sql.ansi.enabled")
    on = rows()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        off = rows()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
    assert on == off


def test_row_shape_is_plain(spark):
    df = spark.createDataFrame([Row(id=1, status="Released", title="T")])
    assert cleaning.clean_films(df).columns == ["id", "title"]
