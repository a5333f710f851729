"""Column expressions and aggregates that the built-in functions do not name directly."""

from reelkpi.functions.columns import (  # noqa: F401
    first_with_job,
    joined_names,
    millions,
    parsed_date,
    round2,
    safe_ratio,
    split_names,
    without_placeholder,
    zero_to_null_double,
)
from reelkpi.functions.median import bracket, median_from_brackets, summarize_with_median  # noqa: F401
