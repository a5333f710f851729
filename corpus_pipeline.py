"""The corpus pipeline: documents -> STAGES -> packed sequences.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which `run` writes as Parquet and reads again as the next
stage's docs. A stage works on every row its predecessor kept, and all but the
last return the columns of documents. Nulls, empty and very long texts, ties,
repeated rows, empty tables and extra columns are as the operators define them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelkpi.llm import packing, quality, simhash, suffixdedup
from reelkpi.llm.common import table, written
from reelkpi.llm.registry import WORDS, fold

#: Learnt scores, fingerprints and the tokenizers library's ids have no SQL form.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. Labels of the
    held-out fold are not learnt, as in the classifier's own query."""
    learn = F.coalesce(fold("doc_id", 3) != 1, F.lit(False))
    return quality.accepted(docs, table(spark, sf_dir, "labels"), learn)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group of SimHash near-duplicates."""
    return simhash.one_of_each(docs, simhash.SHINGLE, simhash.DISTANCE)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of 200-byte strings that start anywhere
    else too; n_chars follows the text that is left."""
    rows = suffixdedup.left_over(docs, suffixdedup.SIZE)
    return rows.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, as pieces of sequences of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path(WORDS), end_id=1)


STAGES = [("quality", good_quality), ("near-duplicates", near_duplicates), ("repeated-passages", repeated_passages),
          ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
