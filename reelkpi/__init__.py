"""reelkpi: film-performance analytics on Spark DataFrames.

Raw nested film records -> one flat clean table -> rankings, searches,
grouped reports and chart datasets. Every function takes and returns
DataFrames; the caller owns the SparkSession.
"""

from reelkpi.operators.cleaning import clean_films  # noqa: F401
from reelkpi.sources.fixture import films_from_tables  # noqa: F401

__version__ = "0.1.0"
