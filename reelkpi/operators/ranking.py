"""Top-k rankings and text searches on the clean table.

`orderBy(...).limit(n)` plans as `TakeOrderedAndProject`: every task keeps its
own n best rows and one task merges n x tasks rows, so a ranking never
shuffles the table. Ties are broken by `id` so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIE_BREAK = "id"


def ranked(
    df: DataFrame,
    metric: str,
    ascending: bool = False,
    limit: int = 5,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows with a non-null `metric`, best `limit` by it (ties by id)."""
    m = F.col(metric)
    order = [m.asc() if ascending else m.desc()]
    if TIE_BREAK in df.columns and metric != TIE_BREAK:
        order.append(F.col(TIE_BREAK).asc())
    out = df.where(m.isNotNull()).orderBy(*order).limit(limit)
    return out.select(*columns) if columns else out


def contains_all(df: DataFrame, **needles: Sequence[str]) -> DataFrame:
    """Rows whose column `c` contains every string of `needles[c]` (case-sensitive
    substring, like `c LIKE '%s%'`); a null column never matches."""
    cond: Column | None = None
    for col_name, values in needles.items():
        for v in values:
            term = F.col(col_name).contains(F.lit(v))
            cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def search(
    df: DataFrame,
    genres: Sequence[str] = (),
    cast: Sequence[str] = (),
    director: Sequence[str] = (),
) -> DataFrame:
    """Films matching all given genre, cast and director substrings."""
    return contains_all(df, genres=genres, cast=cast, director=director)


# --- the concrete rankings (metric, direction, pre-filter, shown columns) -----

def revenue_high(df: DataFrame, n: int = 5) -> DataFrame:
    return ranked(df, "revenue_musd", False, n, ["title", "revenue_musd", "budget_musd"])


def budget_high(df: DataFrame, n: int = 5) -> DataFrame:
    return ranked(df, "budget_musd", False, n, ["title", "budget_musd", "revenue_musd"])


def profit_high(df: DataFrame, n: int = 5) -> DataFrame:
    return ranked(df, "profit", False, n, ["title", "profit", "budget_musd", "revenue_musd"])


def profit_low(df: DataFrame, n: int = 5) -> DataFrame:
    return ranked(df, "profit", True, n, ["title", "profit", "budget_musd", "revenue_musd"])


def roi_high(df: DataFrame, n: int = 5) -> DataFrame:
    return ranked(df, "roi", False, n, ["title", "roi", "revenue_musd"])


def roi_low(df: DataFrame, n: int = 5, min_budget_musd: float = 10) -> DataFrame:
    big = df.where(F.col("budget_musd") >= min_budget_musd)
    return ranked(big, "roi", True, n, ["title", "roi", "budget_musd", "revenue_musd"])


def votes_high(df: DataFrame, n: int = 5) -> DataFrame:
    return ranked(df, "vote_count", False, n, ["title", "vote_count"])


def rating_high(df: DataFrame, n: int = 5, min_votes: int = 10) -> DataFrame:
    voted = df.where(F.col("vote_count") >= min_votes)
    return ranked(voted, "vote_average", False, n, ["title", "vote_average", "vote_count"])


def rating_low(df: DataFrame, n: int = 5, min_votes: int = 10) -> DataFrame:
    voted = df.where(F.col("vote_count") >= min_votes)
    return ranked(voted, "vote_average", True, n, ["title", "vote_average", "vote_count"])


def popularity_high(df: DataFrame, n: int = 5) -> DataFrame:
    return ranked(df, "popularity", False, n, ["title", "popularity"])


def best_rated_matching(df: DataFrame, genres: Sequence[str], cast: Sequence[str], n: int = 5) -> DataFrame:
    """Search by genres and cast, best rated first."""
    return ranked(search(df, genres=genres, cast=cast), "vote_average", False, n,
                  ["title", "vote_average"])


def shortest_matching(df: DataFrame, cast: Sequence[str], director: Sequence[str], n: int = 5) -> DataFrame:
    """Search by cast and director, shortest runtime first."""
    return ranked(search(df, cast=cast, director=director), "runtime", True, n, ["title", "runtime"])
