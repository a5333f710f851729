"""Incremental cleaning of raw records as they land.

The fetch step of the pipeline drops raw JSON files into a landing folder.
Cleaning is row-wise (projections and one filter, no state), so the same
`clean_films` chain runs on a file stream: each new file is read under the
declared schema, cleaned and appended to a Parquet table. The checkpoint lies
beside the output unless given, so a query started again over the same output
finds it and neither skips nor repeats a file. `start_reject_stream` keeps the
records that the schema did not take whole in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from reelkpi.operators.cleaning import clean_films
from reelkpi.sources.landing import CORRUPT_COL, RAW_OR_CORRUPT, rejects


def landed_records(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of raw records from JSON-lines files in `landing_dir`,
    with the lines that did not fit the schema in `_corrupt_record`."""
    reader = (spark.readStream.schema(RAW_OR_CORRUPT).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COL))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing_dir)


def checkpoint_of(output_dir: str) -> str:
    """The checkpoint folder that belongs to an output folder."""
    return f"{output_dir.rstrip('/')}.checkpoint"


def _start(df: DataFrame, output_dir: str, checkpoint: str | None, available_now: bool,
           processing_time: str | None) -> StreamingQuery:
    writer = (df.writeStream.format("parquet").outputMode("append").option("path", output_dir)
              .option("checkpointLocation", checkpoint or checkpoint_of(output_dir)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_clean_stream(
    spark: SparkSession,
    landing_dir: str,
    output_dir: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Clean every landed file into `output_dir` (Parquet, append).

    `available_now` processes what is there and stops (a batch-like run that
    can be repeated), in batches of `max_files_per_trigger` files; otherwise the
    query keeps running on `processing_time`.
    """
    return _start(clean_films(landed_records(spark, landing_dir, max_files_per_trigger)), output_dir, checkpoint,
                  available_now, processing_time)


def start_reject_stream(
    spark: SparkSession,
    landing_dir: str,
    output_dir: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Append id, reason and line of every rejected record to `output_dir` (Parquet)."""
    return _start(rejects(landed_records(spark, landing_dir, max_files_per_trigger)), output_dir, checkpoint,
                  available_now, processing_time)
