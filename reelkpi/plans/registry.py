"""Named queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query starts from the driver's tables in `sf_dir` and runs over all of
their rows. The raw film records derived from them (`films_from_tables`) are
written as Parquet below the shared checkpoint folder and read back (a lineage
cut, like a landed raw table), once per session, folder and state of the input
files: every query then starts from that table, cleaning is a narrow scan with
the released filter and column pruning pushed into it, and a report whose plan
reads the clean table twice (the medians) does not derive the films twice. The
source/sink queries also write files there and return a DataFrame that reads
them back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from reelkpi.operators import chartdata, coverage, ranking, reports
from reelkpi.operators.cleaning import (
    add_kpis,
    clean_films,
    convert_financials,
    dates_and_text,
    drop_irrelevant_columns,
    flatten_nested,
    preview,
    released_only,
    row_count,
)
from reelkpi.plans.oracle_sql import (
    BROKEN_EVERY,
    MISTYPED_EVERY,
    SEARCH2_CAST,
    SEARCH2_DIRECTOR,
    SEARCH_CAST,
    SEARCH_GENRES,
)
from reelkpi.session import enough_shuffle_tasks, scratch_path, session_key
from reelkpi.sources.fixture import films_from_tables
from reelkpi.sources.landing import (
    materialize,
    read_clean_csv,
    read_raw_json,
    rejects,
    write_clean_csv,
    write_lines,
    write_raw_json,
)
from reelkpi.sources.tables import read_table, table_state

Query = Callable[[SparkSession, str], DataFrame]

FLAT_NESTED_COLS = ["id", "belongs_to_collection", "genres", "production_countries",
                    "production_companies", "spoken_languages", "cast", "crew", "director"]


# Written tables and plans per (session, folder, kind), with the state of the
# input files that they were built from: changed inputs are read anew.
_plans: dict[tuple[str, str, str], tuple[tuple, object]] = {}
_INPUTS = ("orders", "lineitem", "part", "supplier", "nation", "customer")


def _plan(spark: SparkSession, sf_dir: str, kind: str, build: Callable):
    key, state = (session_key(spark), sf_dir, kind), table_state(spark, sf_dir, *_INPUTS)
    if key not in _plans or _plans[key][0] != state:
        _plans[key] = (state, build())
    return _plans[key][1]


def forget_plans(keep: tuple[str, ...] = ()) -> None:
    """Drop what is kept of written tables and files, but for the kinds in `keep`
    ("raw": the raw film table), to write them anew over unchanged inputs."""
    for key in [k for k in _plans if k[2] not in keep]:
        del _plans[key]


def raw_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        with enough_shuffle_tasks(spark, read_table(spark, sf_dir, "lineitem").count()):
            return materialize(films_from_tables(spark, sf_dir), "films-raw")
    return _plan(spark, sf_dir, "raw", build)


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_films(raw_films(spark, sf_dir))


def _scalar_columns(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in df.schema.fields
                       if not isinstance(f.dataType, (StructType, ArrayType))])


# --- cleaning steps ----------------------------------------------------------

def q_clean_drop_columns(spark, sf_dir):
    return _scalar_columns(drop_irrelevant_columns(raw_films(spark, sf_dir)))


def q_clean_flatten_nested(spark, sf_dir):
    return flatten_nested(drop_irrelevant_columns(raw_films(spark, sf_dir))).select(*FLAT_NESTED_COLS)


def q_clean_director(spark, sf_dir):
    return flatten_nested(raw_films(spark, sf_dir)).select("id", "director")


def q_clean_financials(spark, sf_dir):
    return convert_financials(raw_films(spark, sf_dir)).select("id", "budget_musd", "revenue_musd", "runtime")


def q_clean_dates_text(spark, sf_dir):
    return dates_and_text(raw_films(spark, sf_dir)).select("id", "release_date", "overview", "tagline")


def q_clean_released(spark, sf_dir):
    return released_only(raw_films(spark, sf_dir)).select("id", "title", "status")


def q_clean_kpis(spark, sf_dir):
    return add_kpis(convert_financials(raw_films(spark, sf_dir))).select("id", "profit", "roi")


def q_clean_pipeline(spark, sf_dir):
    return clean_table(spark, sf_dir)


def q_clean_row_count(spark, sf_dir):
    return row_count(clean_table(spark, sf_dir))


def q_clean_preview(spark, sf_dir):
    return preview(clean_table(spark, sf_dir))


# --- sources and sinks -------------------------------------------------------

# Each of these writes its files once per input state and reads them back.

#: JSON lines repeat every field name a record: plain, they take ten times the room of the films' Parquet.
LANDED_COMPRESSION = "gzip"

def _written(spark, sf_dir, kind: str, write: Callable[[str], None]) -> str:
    def build() -> str:
        path = scratch_path(spark, kind)
        write(path)
        return path
    return _plan(spark, sf_dir, kind, build)


def _landed_json(spark, sf_dir) -> str:
    return _written(spark, sf_dir, "landed-json", lambda path: write_raw_json(
        raw_films(spark, sf_dir), path, LANDED_COMPRESSION))


def q_source_raw_json(spark, sf_dir):
    return clean_films(read_raw_json(spark, _landed_json(spark, sf_dir)))


def q_sink_raw_json(spark, sf_dir):
    back = read_raw_json(spark, _landed_json(spark, sf_dir))
    return flatten_nested(back).select(
        "id", "title", "status", "release_date", "revenue", "budget", "runtime", "popularity",
        "vote_average", "vote_count", "imdb_id", "belongs_to_collection", "genres",
        "spoken_languages", "cast", "crew", "director")


def _landed_with_faults(spark, sf_dir) -> str:
    """All films as JSON lines, some cut off before their end, some with text as a number."""
    def write(path: str) -> None:
        films = raw_films(spark, sf_dir)
        line = (F.when(F.col("id") % BROKEN_EVERY == 0, F.expr("left(_line, length(_line) - 1)"))
                .when(F.col("id") % MISTYPED_EVERY == 0,
                      F.regexp_replace("_line", r'"vote_count":\d+', '"vote_count":"many"'))
                .otherwise(F.col("_line"))).alias("value")
        lines = films.select("id", F.to_json(F.struct(*films.columns)).alias("_line")).select(line)
        write_lines(lines, path, LANDED_COMPRESSION)
    return _written(spark, sf_dir, "landed-faults", write)


def q_ingest_rejects(spark, sf_dir):
    return rejects(read_raw_json(spark, _landed_with_faults(spark, sf_dir))).select("id", "reason")


def _csv_round_trip(header: bool) -> Query:
    """The clean table through CSV files; the hardest texts, with carriage returns, come first in each."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        hardest = F.coalesce(F.col("overview").contains("\r"), F.lit(False)).desc()
        path = _written(spark, sf_dir, f"clean-csv-{header}", lambda path: write_clean_csv(
            clean_table(spark, sf_dir).sortWithinPartitions(hardest, "id"), path, header=header))
        return read_clean_csv(spark, path, header=header)
    return run


def _requested_and_landed(spark, sf_dir):
    requested = read_table(spark, sf_dir, "orders", ["o_orderkey"])
    landed = read_table(spark, sf_dir, "lineitem", ["l_orderkey"])
    return requested, landed


def q_ingest_coverage(spark, sf_dir):
    return coverage.ingest_coverage(*_requested_and_landed(spark, sf_dir))


def q_ingest_missing(spark, sf_dir):
    return coverage.missing_ids(*_requested_and_landed(spark, sf_dir))


# --- rankings, searches, reports, charts ---------------------------------------

def _on_clean(fn: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(clean_table(spark, sf_dir))
    run.__name__ = f"q_{fn.__name__}"
    run.__doc__ = fn.__doc__
    return run


def _search_genre_cast(df):
    return ranking.best_rated_matching(df, SEARCH_GENRES, SEARCH_CAST)


def _search_cast_director(df):
    return ranking.shortest_matching(df, SEARCH2_CAST, SEARCH2_DIRECTOR)


def _roi_low_unfloored(df):
    return ranking.ranked(df, "roi", ascending=True, limit=5)


# Reports that can run on an already written clean table (see bench.py).
ON_CLEAN: dict[str, Callable[[DataFrame], DataFrame]] = {
    "rank_revenue_high": ranking.revenue_high,
    "rank_budget_high": ranking.budget_high,
    "rank_profit_high": ranking.profit_high,
    "rank_profit_low": ranking.profit_low,
    "rank_roi_high": ranking.roi_high,
    "rank_roi_low": ranking.roi_low,
    "rank_votes_high": ranking.votes_high,
    "rank_rating_high": ranking.rating_high,
    "rank_rating_low": ranking.rating_low,
    "rank_popularity_high": ranking.popularity_high,
    "search_genre_cast": _search_genre_cast,
    "search_cast_director": _search_cast_director,
    "rank_roi_low_unfloored": _roi_low_unfloored,
    "franchise_flag_stats": reports.franchise_flag_stats,
    "company_success": reports.company_success,
    "franchise_comparison": reports.franchise_comparison,
    "top_franchises": reports.top_franchises,
    "franchise_success": reports.franchise_success,
    "director_success": reports.director_success,
    "chart_yearly": chartdata.yearly_trends,
    "chart_genre_roi": chartdata.genre_roi,
    "chart_franchise": chartdata.franchise_means,
    "chart_scatter": chartdata.scatter,
}

QUERIES: dict[str, Query] = {
    "clean_drop_columns": q_clean_drop_columns,
    "clean_flatten_nested": q_clean_flatten_nested,
    "clean_director": q_clean_director,
    "clean_financials": q_clean_financials,
    "clean_dates_text": q_clean_dates_text,
    "clean_released": q_clean_released,
    "clean_kpis": q_clean_kpis,
    "clean_pipeline": q_clean_pipeline,
    "clean_row_count": q_clean_row_count,
    "clean_preview": q_clean_preview,
    "source_raw_json": q_source_raw_json,
    "sink_raw_json": q_sink_raw_json,
    "sink_clean_csv": _csv_round_trip(header=True),
    "sink_clean_csv_noheader": _csv_round_trip(header=False),
    "ingest_coverage": q_ingest_coverage,
    "ingest_missing": q_ingest_missing,
    "ingest_rejects": q_ingest_rejects,
    **{name: _on_clean(fn) for name, fn in ON_CLEAN.items()},
}
