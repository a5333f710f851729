"""Datasets behind the charts: yearly trend, ROI by genre, franchise means, scatter.

They stay DataFrames: the three aggregates are small by construction (one row
per year / genre / category), the scatter is as large as the clean table and
is meant to be written or sampled by the caller, never collected here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkpi.functions.columns import split_names
from reelkpi.functions.median import summarize_with_median
from reelkpi.operators.reports import FRANCHISE, STANDALONE

SCATTER_COLS = ["title", "budget_musd", "revenue_musd", "popularity", "vote_average"]


def yearly_trends(df: DataFrame) -> DataFrame:
    """V1: per release year (films without a date form the null year, listed first)."""
    return (
        df.withColumn("year", F.year("release_date"))
        .groupBy("year").agg(
            F.count("id").alias("movie_count"),
            F.avg("revenue_musd").alias("mean_revenue"),
            F.avg("budget_musd").alias("mean_budget"),
            F.avg("roi").alias("mean_roi"),
        )
        .orderBy(F.col("year").asc_nulls_first())
    )


def genre_roi(df: DataFrame, median_accuracy: int | None = None) -> DataFrame:
    """V2: median ROI per genre ('|'-split; '' genres form their own group).

    Nothing runs until the result is asked for; whether the brackets of large
    genres are broadcast is left to Spark's rule on their bytes."""
    exploded = df.select(F.explode(split_names("genres")).alias("genre"), "roi")
    out = summarize_with_median(exploded, ["genre"], "roi", "median_roi", median_accuracy=median_accuracy)
    return out.orderBy(F.col("median_roi").desc_nulls_last(), F.col("genre").asc())


def franchise_means(df: DataFrame) -> DataFrame:
    """V3: franchise vs standalone means (mean ROI here, not median)."""
    return (
        df.withColumn("type", F.when(F.col("belongs_to_collection").isNotNull(), F.lit(FRANCHISE))
                      .otherwise(F.lit(STANDALONE)))
        .groupBy("type").agg(
            F.avg("revenue_musd").alias("mean_revenue"),
            F.avg("budget_musd").alias("mean_budget"),
            F.avg("roi").alias("mean_roi"),
            F.avg("vote_average").alias("mean_rating"),
        )
    )


def scatter(df: DataFrame) -> DataFrame:
    """V4: per-film points for the budget/revenue and popularity/rating plots."""
    return df.select(*SCATTER_COLS)


def all_chart_data(df: DataFrame) -> dict[str, DataFrame]:
    """V5: the four chart datasets, lazily (nothing is collected)."""
    return {
        "yearly": yearly_trends(df),
        "genre": genre_roi(df),
        "scatter": scatter(df),
        "franchise": franchise_means(df),
    }
