"""Raw nested film records -> flat typed clean table.

Each step is a pure `DataFrame -> DataFrame` function that works on any frame
holding a subset of the raw columns (steps skip columns that are absent);
`clean_films` chains them. Every step is a projection except the released-only
filter, so the whole chain is one narrow stage: no shuffle, the filter and the
column pruning reach the scan, and it runs unchanged on a streaming source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkpi.functions.columns import (
    first_with_job,
    joined_names,
    millions,
    parsed_date,
    safe_ratio,
    without_placeholder,
    zero_to_null_double,
)
from reelkpi.schema import DROP_COLS, FINAL_COL_ORDER, KPI_COLS, NAME_LIST_COLS, RELEASED, TEXT_COLS


def drop_irrelevant_columns(df: DataFrame) -> DataFrame:
    """Drop the columns of `DROP_COLS` (absent names are ignored)."""
    return df.drop(*DROP_COLS)


def flatten_nested(df: DataFrame) -> DataFrame:
    """Collection struct -> its name; credits -> cast, crew, director;
    arrays of structs -> '|'-joined names."""
    cols = set(df.columns)
    out: dict = {}
    if "belongs_to_collection" in cols:
        out["belongs_to_collection"] = F.col("belongs_to_collection.name")
    if "credits" in cols:
        out["director"] = first_with_job(F.col("credits.crew"))
        out["cast"] = joined_names(F.col("credits.cast"))
        out["crew"] = joined_names(F.col("credits.crew"))
    for c in NAME_LIST_COLS:
        if c in cols and c not in out:
            out[c] = joined_names(c)
    return df.withColumns(out) if out else df


def convert_financials(df: DataFrame) -> DataFrame:
    """budget/revenue -> *_musd in millions (0 -> null); runtime 0 -> null, double."""
    out = {f"{c}_musd": millions(c) for c in ("budget", "revenue") if c in df.columns}
    if "runtime" in df.columns:
        out["runtime"] = zero_to_null_double("runtime")
    return df.withColumns(out) if out else df


def dates_and_text(df: DataFrame) -> DataFrame:
    """release_date -> date (bad text -> null); placeholder text -> null."""
    out = {}
    if "release_date" in df.columns:
        out["release_date"] = parsed_date("release_date")
    for c in TEXT_COLS:
        if c in df.columns:
            out[c] = without_placeholder(c)
    return df.withColumns(out) if out else df


def released_only(df: DataFrame) -> DataFrame:
    """Keep released films (null status is dropped; the column is required)."""
    return df.where(F.col("status") == RELEASED)


def add_kpis(df: DataFrame) -> DataFrame:
    """profit = revenue - budget, roi = revenue / budget (a multiple), in millions."""
    if "revenue_musd" in df.columns and "budget_musd" in df.columns:
        return df.withColumns({
            "profit": F.col("revenue_musd") - F.col("budget_musd"),
            "roi": safe_ratio("revenue_musd", "budget_musd"),
        })
    return df


def final_projection(df: DataFrame) -> DataFrame:
    """The present columns of the fixed order, then the KPI columns."""
    present = set(df.columns)
    return df.select(*[c for c in FINAL_COL_ORDER + KPI_COLS if c in present])


def clean_films(raw: DataFrame) -> DataFrame:
    """C14: the whole chain. The filter runs first (it only reads the raw
    `status`), which is what the optimizer would do anyway."""
    return (
        raw.transform(released_only)
        .transform(drop_irrelevant_columns)
        .transform(flatten_nested)
        .transform(convert_financials)
        .transform(dates_and_text)
        .transform(add_kpis)
        .transform(final_projection)
    )


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows as a one-row DataFrame (`rows`); counts per task, one merge."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


PREVIEW_COLS = ["title", "release_date", "revenue_musd", "roi"]


def preview(df: DataFrame, n: int = 5, columns: list[str] = PREVIEW_COLS) -> DataFrame:
    """The first `n` films by id, a few columns (a top-n, no full sort)."""
    return df.orderBy(F.col("id").asc()).limit(n).select(*columns)
