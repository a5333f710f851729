"""Record layouts of the film data: the nested raw record and the flat clean table.

Everything in this module is a fixed value that results depend on.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values (must stay as they are for equal results) -----------------

# Columns removed first by the cleaning chain.
DROP_COLS = ["adult", "imdb_id", "original_title", "video", "homepage"]

# Column order of the clean table; the two KPI columns follow it.
FINAL_COL_ORDER = [
    "id", "title", "tagline", "release_date", "genres", "belongs_to_collection",
    "original_language", "budget_musd", "revenue_musd", "production_companies",
    "production_countries", "vote_count", "vote_average", "popularity",
    "runtime", "overview", "spoken_languages", "poster_path", "cast", "crew", "director",
]
KPI_COLS = ["profit", "roi"]

# Arrays of structs that become one '|'-joined string of their `name` fields.
NAME_LIST_COLS = [
    "genres", "production_countries", "production_companies", "spoken_languages", "cast", "crew",
]

# Text values that mean "no value" in overview / tagline (exact, case-sensitive).
TEXT_PLACEHOLDERS = ["No Data", ""]
TEXT_COLS = ["overview", "tagline"]

# Only this status survives cleaning.
RELEASED = "Released"

# Crew job that marks the director.
DIRECTOR_JOB = "Director"

# Separator of joined name lists.
NAME_SEP = "|"

# Date layout of release_date in the raw record.
RELEASE_DATE_FORMAT = "yyyy-MM-dd"

# -----------------------------------------------------------------------------

GENRE = StructType([
    StructField("id", IntegerType(), True),
    StructField("name", StringType(), True),
])

COMPANY = StructType([
    StructField("name", StringType(), True),
    StructField("id", IntegerType(), True),
    StructField("logo_path", StringType(), True),
    StructField("origin_country", StringType(), True),
])

COUNTRY = StructType([
    StructField("iso_3166_1", StringType(), True),
    StructField("name", StringType(), True),
])

LANGUAGE = StructType([
    StructField("iso_639_1", StringType(), True),
    StructField("name", StringType(), True),
    StructField("english_name", StringType(), True),
])

COLLECTION = StructType([
    StructField("id", IntegerType(), True),
    StructField("name", StringType(), True),
    StructField("poster_path", StringType(), True),
    StructField("backdrop_path", StringType(), True),
])

CAST_MEMBER = StructType([
    StructField("id", IntegerType(), True),
    StructField("name", StringType(), True),
])

CREW_MEMBER = StructType([
    StructField("id", IntegerType(), True),
    StructField("name", StringType(), True),
    StructField("job", StringType(), True),
])

CREDITS = StructType([
    StructField("cast", ArrayType(CAST_MEMBER), True),
    StructField("crew", ArrayType(CREW_MEMBER), True),
])

# One film as delivered by the catalogue service; all fields nullable.
RAW_SCHEMA = StructType([
    StructField("id", LongType(), True),
    StructField("title", StringType(), True),
    StructField("overview", StringType(), True),
    StructField("tagline", StringType(), True),
    StructField("status", StringType(), True),
    StructField("release_date", StringType(), True),
    StructField("revenue", LongType(), True),
    StructField("budget", LongType(), True),
    StructField("runtime", LongType(), True),
    StructField("popularity", DoubleType(), True),
    StructField("vote_average", DoubleType(), True),
    StructField("vote_count", LongType(), True),
    StructField("original_language", StringType(), True),
    StructField("poster_path", StringType(), True),
    StructField("credits", CREDITS, True),
    StructField("belongs_to_collection", COLLECTION, True),
    StructField("genres", ArrayType(GENRE), True),
    StructField("production_companies", ArrayType(COMPANY), True),
    StructField("production_countries", ArrayType(COUNTRY), True),
    StructField("spoken_languages", ArrayType(LANGUAGE), True),
    StructField("adult", BooleanType(), True),
    StructField("imdb_id", StringType(), True),
    StructField("homepage", StringType(), True),
    StructField("video", BooleanType(), True),
    StructField("original_title", StringType(), True),
])

# The clean table produced from a full raw record.
CLEAN_SCHEMA = StructType([
    StructField("id", LongType(), True),
    StructField("title", StringType(), True),
    StructField("tagline", StringType(), True),
    StructField("release_date", DateType(), True),
    StructField("genres", StringType(), True),
    StructField("belongs_to_collection", StringType(), True),
    StructField("original_language", StringType(), True),
    StructField("budget_musd", DoubleType(), True),
    StructField("revenue_musd", DoubleType(), True),
    StructField("production_companies", StringType(), True),
    StructField("production_countries", StringType(), True),
    StructField("vote_count", LongType(), True),
    StructField("vote_average", DoubleType(), True),
    StructField("popularity", DoubleType(), True),
    StructField("runtime", DoubleType(), True),
    StructField("overview", StringType(), True),
    StructField("spoken_languages", StringType(), True),
    StructField("poster_path", StringType(), True),
    StructField("cast", StringType(), True),
    StructField("crew", StringType(), True),
    StructField("director", StringType(), True),
    StructField("profit", DoubleType(), True),
    StructField("roi", DoubleType(), True),
])
