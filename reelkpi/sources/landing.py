"""Landed raw records in, clean tables out.

* Raw film records land as JSON lines (one record per line, any number of
  files); they are read in parallel under the declared nested schema, never
  inferred (inference turns arrays of structs into maps or strings).
* The clean table goes out as CSV (the reference's export format) or Parquet
  (the format for anything read again: it keeps types, null vs '' and lets
  later scans prune columns and push filters).
* `materialize` writes a table below the cluster's shared checkpoint folder
  and reads it back: it cuts the lineage so a lost executor costs a re-read
  of files, not a re-run of the whole upstream plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reelkpi.schema import CLEAN_SCHEMA, RAW_SCHEMA
from reelkpi.session import scratch_path

CORRUPT_COL = "_corrupt_record"
RAW_OR_CORRUPT = StructType([*RAW_SCHEMA.fields, StructField(CORRUPT_COL, StringType(), True)])

#: Null marker in CSV files (keeps null apart from ''). Text that is the marker
#: itself, with any number of backslashes before it, gets one backslash more.
CSV_NULL = "\\N"
#: Rows in one CSV file: a file with line breaks in its values is read by one task.
CSV_FILE_ROWS = 200_000
#: Records in one compressed file of JSON lines, which is read by one task too.
JSON_FILE_ROWS = 200_000


def read_raw_json(spark: SparkSession, path: str, keep_corrupt: bool = True,
                  multi_line: bool = False) -> DataFrame:
    """Raw records from JSON-lines files under the declared schema.

    A line that is no JSON gives a record of nulls, a field whose JSON type does
    not fit becomes null; both keep their line in `_corrupt_record` (see
    `rejects`), which cleaning leaves out. Integer JSON numbers are accepted for
    double fields. `multi_line` reads files that each hold one (indented) JSON
    array of records, the layout of a single-file export; such a file is read by
    one task, so land large inputs as JSON lines (and pass `keep_corrupt=False`
    with it, or the whole file is copied into each bad record).
    """
    reader = spark.read.option("mode", "PERMISSIVE").option("multiLine", multi_line)
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    return reader.schema(RAW_OR_CORRUPT if keep_corrupt else RAW_SCHEMA).json(path)


def rejects(raw: DataFrame) -> DataFrame:
    """Records of `read_raw_json` (batch or stream) that the schema did not take
    whole: id as far as the line shows one, reason ('malformed': the line is no
    JSON record; 'mistyped': it is one, and some field did not fit and is null),
    and the line.
    Count them by reason (Spark does not run a plan over JSON files that needs
    nothing but the kept line)."""
    line = F.col(CORRUPT_COL)
    shown = F.regexp_extract(line, r'"id"\s*:\s*(-?\d+)', 1)
    is_record = F.coalesce(F.schema_of_variant(F.try_parse_json(line)).startswith("OBJECT"), F.lit(False))
    # a field that no plan reads is not parsed, so its faults would not be seen:
    # the second condition needs every field, and runs on rejected records only
    every_field = F.length(F.to_json(F.struct(*[F.col(f.name) for f in RAW_SCHEMA.fields]))) >= 0
    return raw.where(line.isNotNull() & every_field).select(
        F.coalesce("id", F.nullif(shown, F.lit("")).try_cast("bigint")).alias("id"),
        F.when(is_record, "mistyped").otherwise("malformed").alias("reason"), line.alias("line"))


def write_raw_json(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Raw records as JSON lines, one file per task (overwrites `path`).

    With a `compression` ("gzip", ...) the files take about a ninth of the disk;
    each is then read by one task, so they are cut at JSON_FILE_ROWS rows."""
    _compressed(df.write.mode("overwrite"), compression).json(path)


def write_lines(df: DataFrame, path: str, compression: str | None = None) -> None:
    """One text column as lines, as `write_raw_json` writes records (overwrites `path`)."""
    _compressed(df.write.mode("overwrite"), compression).text(path)


def _compressed(writer: DataFrameWriter, compression: str | None) -> DataFrameWriter:
    if compression is None:
        return writer
    return writer.option("compression", compression).option("maxRecordsPerFile", JSON_FILE_ROWS)


def _csv_options(io, header: bool, null_marker: str):
    # spaces, quotes and line breaks inside values stay as they are; with the record
    # separator named, the reader does not take the first line break it meets for it
    return (io.option("header", header).option("nullValue", null_marker).option("quoteAll", True).option("lineSep", "\n")
            .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def _strings(df: DataFrame, change) -> DataFrame:
    return df.withColumns({f.name: change(F.col(f"`{f.name}`")) for f in df.schema.fields
                           if isinstance(f.dataType, StringType)})


def write_clean_csv(df: DataFrame, path: str, header: bool = True, null_marker: str = CSV_NULL) -> None:
    """Clean table as CSV files (overwrites `path`), every character kept.

    `null_marker=""` writes nulls as empty fields, for programs that expect
    that; null and '' are then the same on reading."""
    def marked(c: Column) -> Column:
        return F.when(c.rlike(r"^\\+N$"), F.concat(F.lit("\\"), c)).otherwise(c)

    out = _strings(df, marked) if null_marker == CSV_NULL else df
    _csv_options(out.write.mode("overwrite"), header, null_marker).option("maxRecordsPerFile", CSV_FILE_ROWS).csv(path)


def read_clean_csv(spark: SparkSession, path: str, header: bool = True, null_marker: str = CSV_NULL) -> DataFrame:
    """Clean table back from CSV under the clean schema (no inference). Values
    may hold line breaks, so each file is read by one task."""
    reader: DataFrameReader = _csv_options(spark.read.schema(CLEAN_SCHEMA), header, null_marker)
    df = reader.option("multiLine", True).csv(path)

    def unmarked(c: Column) -> Column:
        return F.when(c.rlike(r"^\\\\+N$"), F.substring(c, 2, 1 << 30)).otherwise(c)

    return _strings(df, unmarked) if null_marker == CSV_NULL else df


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write `df` as Parquet (below the shared checkpoint folder unless `path`
    is given) and return a DataFrame reading it back."""
    spark = df.sparkSession
    target = path or scratch_path(spark, name)
    write_parquet(df, target)
    return spark.read.parquet(target)
