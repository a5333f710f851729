"""Ingest coverage: which requested film ids actually landed.

The fetch step of a catalogue pipeline reports "fetched N of M" and the ids it
skipped. Here both sides are tables: the requested ids and the ids of landed
records. Landed ids are de-duplicated with a partial aggregate (so repeated
records of one id cost one row per task), then matched to the requested ids
with one shuffle join; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _landed(landed_ids: DataFrame) -> DataFrame:
    return landed_ids.select(F.col(landed_ids.columns[0]).alias("_landed_id")).distinct()


def ingest_coverage(requested_ids: DataFrame, landed_ids: DataFrame) -> DataFrame:
    """One row: requested, landed (requested ids with a record), missing."""
    req = requested_ids.select(F.col(requested_ids.columns[0]).alias("_req_id"))
    matched = req.join(_landed(landed_ids), F.col("_req_id") == F.col("_landed_id"), "left")
    return matched.agg(
        F.count(F.lit(1)).alias("requested"),
        F.count("_landed_id").alias("landed"),
    ).withColumn("missing", F.col("requested") - F.col("landed"))


def missing_ids(requested_ids: DataFrame, landed_ids: DataFrame) -> DataFrame:
    """Requested ids without a landed record (column `id`)."""
    req = requested_ids.select(F.col(requested_ids.columns[0]).alias("id"))
    return req.join(_landed(landed_ids), F.col("id") == F.col("_landed_id"), "left_anti")
