"""Readers for the driver's parquet tables (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet table, projected to `columns` up front so the scan reads only those."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def table_state(spark: SparkSession, sf_dir: str, *names: str) -> tuple:
    """(path, length, modification time) of every file of the tables: changes
    when a table is rewritten or grows. Reads listings only."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    found = []
    for name in names:
        top = hadoop(table_path(sf_dir, name))
        files = top.getFileSystem(conf).listFiles(top, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))
