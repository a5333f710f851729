"""Exact grouped median that stays distributed when one group is huge.

`F.median` keeps every distinct value of a group in one task. Here a first
aggregate makes a quantile sketch of bounded size a group (partial per task).
A group of up to SMALL values is settled by it alone: a sketch of accuracy
ACCURACY keeps every value of up to ACCURACY / 2 apart, so the two middle ranks
are read off it. For larger groups it gives a bracket around the middle, and

* each of REFINEMENTS more passes counts the values below the bracket and takes
  GRID + 1 evenly spaced quantiles of those inside, of which the cells around
  the middle ranks become the next bracket;
* a last pass counts the distinct values in the bracket, and one task a group
  runs through them.

Only a group above SMALL is ever looked at again: where there is none, runtime
re-planning drops the later passes, because the brackets that they are joined
to are empty. The passes' rows are joined to brackets, never to each other, and
aggregate partially, so a hot group sends one row per task (and, last, per
distinct value of its bracket).

Bounds: the first bracket holds 2 * MARGIN of a group, the next ones 4 / GRID of
it or less each; that is about 130,000 of 10^12 values after one refinement.
A median is never wrong or missing in silence: if a bracket has lost a middle
rank, or the last one holds more than MOST_VALUES distinct values (raise
`refinements` for such groups), the query fails with a message.

For even sizes the result is Spark's interpolation `0.5 * lo + 0.5 * hi`. Nulls
are ignored, a group of nulls has a null median, and NaN sorts above every
number, as in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 120_000
#: Group sizes up to which the sketch alone settles the median (at most ACCURACY / 2).
SMALL = 50_000
#: Share of a group on either side of its middle in the first bracket: over 1 / ACCURACY and two ranks of SMALL.
MARGIN = 0.0001
#: The next upper fraction meets the upper middle rank of any even size up to SMALL.
UPPER = 0.5 + 0.25 / SMALL
#: Quantiles of a bracket, their sketch's accuracy, and passes that refine by them.
GRID, GRID_ACCURACY, REFINEMENTS = 1_000, 10_000, 1
INFINITY = float("inf")
#: Distinct values of one bracket that a task may see.
MOST_VALUES = 4_000_000


def bracket(v: Column) -> Column:
    """Aggregate: struct (n, nan, at) of the non-null values: the two middle ranks lie
    between at[0] and at[3], and are at[1] and at[2] if n is at most SMALL. The
    sketch takes NaN for infinity; nan says whether there is one."""
    at = F.percentile_approx(F.when(F.isnan(v), INFINITY).otherwise(v), [0.5 - MARGIN, 0.5, UPPER, 0.5 + MARGIN], ACCURACY)
    return F.struct(F.count(v).alias("n"), F.coalesce(F.bool_or(F.isnan(v)), F.lit(False)).alias("nan"), at.alias("at"))


# The later passes are written as SQL expressions, each one call to the JVM: they
# are built for every median, and mostly not run.

#: The two middle ranks of n values.
LOW, HIGH = "(n + 1) div 2", "n div 2 + 1"


def _between(lo: str, hi: str) -> str:
    return f"if({lo} = {hi}, {lo}, 0.5D * {lo} + 0.5D * {hi})"


def _fails(what: str) -> str:
    return f"cast(raise_error('exact median: {what}') as double)"


def _upper(end: str) -> str:
    """The upper end of a bracket; it takes in NaN where a sketch says infinity."""
    return f"if({end} = {INF}, cast('NaN' as double), {end})"


INF = "cast('Infinity' as double)"
#: Groups that the first pass does not settle: large ones, and those whose middle may be NaN or infinity.
UNSETTLED = f"(_bracket.n > {{small}} or _bracket.nan and _bracket.at[2] = {INF})"
LOST = _fails("a bracket does not hold the middle ranks")


def _joined(rows: DataFrame, side: DataFrame, names: Sequence[str]) -> DataFrame:
    """rows (_r0.., _v) beside the row (_k0.., n, lo, hi) of their group."""
    same = " and ".join(f"_r{i} <=> {n}" for i, n in enumerate(names))
    return rows.join(side, F.expr(f"{same} and _v <= hi"))


def _refined(rows: DataFrame, side: DataFrame, names: Sequence[str]) -> DataFrame:
    """side with each bracket cut down to the grid's cells around the middle ranks."""
    grid = " ".join(str(i / GRID) for i in range(GRID + 1))
    found = _joined(rows, side, names).groupBy(*names).agg(
        F.expr("any_value(n) as n"), F.expr("count_if(_v < lo) as _below"), F.expr("count_if(_v >= lo) as _inside"),
        F.expr(f"percentile_approx(case when isnan(_v) then {INF} when _v >= lo then _v end, cast(split('{grid}', ' ') as array<double>), {GRID_ACCURACY}) as _grid"))
    here = f"{LOW} > _below and {HIGH} <= _below + _inside"
    # a rank's cell of the grid; the ends lie two cells away from it
    cell = lambda rank: f"cast(floor(({rank} - _below) / greatest(_inside, 1) * {GRID}) as int)"
    lo, hi = f"greatest({cell(LOW)} - 1, 1)", f"greatest(least({cell(HIGH)} + 3, {GRID + 1}), 1)"
    return found.selectExpr(*names, "n", f"if({here}, _grid[{lo} - 1], {LOST}) as lo",
                            f"if({here}, {_upper(f'_grid[{hi} - 1]')}, {LOST}) as hi")


def _counted(rows: DataFrame, side: DataFrame, names: Sequence[str]) -> DataFrame:
    """(names, _middle): the medians of the groups in side, from counts of their brackets' values."""
    # one row per distinct value of the bracket, and one (null) for all values below it
    counts = (_joined(rows, side, names).groupBy(*names, F.expr("if(_v >= lo, _v, null) as _v"))
              .agg(F.expr("count(1) as _c"), F.expr("any_value(n) as n")))
    upto = f"(partition by {', '.join(names)} order by _v nulls first rows unbounded preceding)"
    ranked = counts.selectExpr(*names, "_v", "n", "_c", f"sum(_c) over {upto} as _last")
    at = lambda rank: f"max(if(_last - _c < {rank} and {rank} <= _last, _v, null))"
    picked = ranked.groupBy(*names).agg(F.expr(f"{at(LOW)} as _lo"), F.expr(f"{at(HIGH)} as _hi"), F.expr("count(1) as _values"))
    return picked.selectExpr(*names, f"""if(_values > {MOST_VALUES + 1}, {_fails("a bracket holds too many values, raise refinements")},
        {_between("_lo", "_hi")}) as _middle""")


def median_from_brackets(df: DataFrame, groups: DataFrame, keys: Sequence[str], value: str, alias: str,
                         few_groups: bool = False, candidates: DataFrame | None = None,
                         refinements: int | None = None) -> DataFrame:
    """The rows of `groups` with the exact median of `value` in place of `_bracket`.

    groups: one row per group (keys, `_bracket`, any other columns). Its large
    groups, or those of `candidates` (a superset, if given), are looked at again;
    `few_groups` broadcasts them, for a number that does not grow with the data.
    All columns of groups but the median come out as they went in."""
    carried = [c for c in groups.columns if c not in keys and c != "_bracket"]
    names = [f"_k{i}" for i in range(len(keys))]
    again = groups if candidates is None else candidates
    # the second condition is true of every row; it keeps all columns in this use of
    # the groups too, so that both uses share one first pass
    unsettled = UNSETTLED.format(small=SMALL)
    side = again.where(f"{unsettled} and xxhash64(*) >= {-(1 << 63) + 1}L - 1L").selectExpr(
        *[f"`{k}` as {n}" for k, n in zip(keys, names)], "_bracket.n as n", "_bracket.at[0] as lo",
        f"{_upper('_bracket.at[3]')} as hi")
    rows = df.selectExpr(*[f"`{k}` as _r{i}" for i, k in enumerate(keys)], f"cast(`{value}` as double) as _v")
    hint = F.broadcast if few_groups else (lambda x: x)
    for _ in range(REFINEMENTS if refinements is None else refinements):
        side = _refined(rows, hint(side), names)
    medians = hint(_counted(rows, hint(side), names))
    same = " and ".join(f"`{k}` <=> {n}" for k, n in zip(keys, names))
    return groups.join(medians, F.expr(same), "left").selectExpr(
        *[f"`{c}`" for c in (*keys, *carried)],
        f"if({unsettled}, coalesce(_middle, {LOST}), {_between('_bracket.at[1]', '_bracket.at[2]')}) as `{alias}`")


def summarize_with_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    median_alias: str,
    aggregates: Sequence[Column] = (),
    median_accuracy: int | None = None,
    few_groups: bool = False,
    refinements: int | None = None,
) -> DataFrame:
    """One row per group of `keys`: the aliased `aggregates` and the exact median of `value`.

    `few_groups` promises a number of groups that does not grow with the data,
    and broadcasts them to the later scans. With `median_accuracy` the median
    is instead `percentile_approx(value, 0.5, median_accuracy)` from the first
    pass alone: a value of the group whose rank is within n / accuracy of the
    middle, without interpolation.
    """
    v = F.col(value).cast("double")
    if median_accuracy is not None:
        return df.groupBy(*keys).agg(*aggregates, F.percentile_approx(v, 0.5, median_accuracy).alias(median_alias))
    groups = df.groupBy(*keys).agg(*aggregates, bracket(v).alias("_bracket"))
    return median_from_brackets(df, groups, keys, value, median_alias, few_groups, refinements=refinements)
