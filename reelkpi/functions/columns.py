"""Column expressions used by the cleaning steps and the reports.

All are built-in Catalyst expressions (no lambdas, no UDFs), so they stay in
whole-stage codegen and read only the nested fields they name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelkpi.schema import DIRECTOR_JOB, NAME_SEP, RELEASE_DATE_FORMAT, TEXT_PLACEHOLDERS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def joined_names(array_col: str | Column, sep: str = NAME_SEP) -> Column:
    """`name` fields of an array of structs joined by `sep`.

    Null names are skipped, an empty array gives '', a null array gives null.
    Reading `arr.name` (not a lambda) lets the scan prune the struct to `name`.
    """
    return F.array_join(_col(array_col).getField("name"), sep)


def first_with_job(crew_col: str | Column, job: str = DIRECTOR_JOB) -> Column:
    """Name of the first crew member whose job equals `job` exactly, else null."""
    crew = _col(crew_col)
    pos = F.array_position(crew.getField("job"), job).cast("int")
    return F.when(pos > 0, F.element_at(crew.getField("name"), pos))


def millions(money_col: str | Column) -> Column:
    """Money in millions as double; 0 means unknown and becomes null."""
    c = _col(money_col)
    return F.when(c != 0, c / F.lit(1_000_000)).cast("double")


def zero_to_null_double(c: str | Column) -> Column:
    """0 becomes null, anything else is cast to double."""
    c = _col(c)
    return F.when(c != 0, c.cast("double"))


def parsed_date(c: str | Column, fmt: str = RELEASE_DATE_FORMAT) -> Column:
    """Strict date parse; text that does not fit `fmt` gives null (never an error)."""
    return F.try_to_date(_col(c), fmt)


def without_placeholder(c: str | Column, placeholders: list[str] = TEXT_PLACEHOLDERS) -> Column:
    """Placeholder text (exact match) becomes null."""
    c = _col(c)
    return F.when(~c.isin(*placeholders), c)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, null when either is null or den is 0 (also with ANSI on)."""
    return F.try_divide(_col(num), _col(den))


def split_names(c: str | Column, sep: str = NAME_SEP) -> Column:
    """Split a joined name list; empty and trailing pieces are kept."""
    return F.split(_col(c), "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep)


def round2(c: str | Column) -> Column:
    """Round half up to two decimals (on the decimal text of the double)."""
    return F.round(_col(c), 2)
