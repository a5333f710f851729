"""Packing: concatenate all documents and cut the row of ids into fixed windows.

Pass 1 tokenises each input partition once and writes its documents with their
place in the partition; the partition totals are summed to give each partition
the ids before it. Pass 2 gives every document its global offset and cuts it at
the window bounds: one boundary record (piece) for each window it lies in. No
document is shuffled, no task sees more than its own partition, and only one
row per input partition meets in one task.

Defined results: a null or empty text is its end id alone; repeated rows and
repeated ids are documents of their own; a null id stays null; an empty table
gives no piece; extra columns are left out. A text of any length is one row of
ids in pass 1 and is cut like any other. The order of the documents is the
order of the input partitions and the rows in them. All sequences hold exactly
`window` ids but the last, which holds the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkpi.llm.common import keyed_texts, partition_bases, text_slices, written
from reelkpi.llm.wordtokens import word_encoder

WINDOW = 2048
TOKENS_SCHEMA = "doc_id long, part int, before long, doc_tokens long, ids binary"


def tokenized(df: DataFrame, tokenizer_path: str, end_id: int,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pass 1: one row per document with its ids (little-endian unsigned 32-bit,
    the end id last), its partition, and the ids before it in that partition."""

    def run(batches):
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        encoder, end = word_encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for first, texts in text_slices(batch):
                ids = [x + end for x in encoder.encode(texts)]
                counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                starts = before + np.cumsum(counts) - counts
                before += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(np.full(len(texts), part, np.int32)),
                     pa.array(starts), pa.array(counts), pa.array(ids, pa.binary())],
                    ["doc_id", "part", "before", "doc_tokens", "ids"])

    return keyed_texts(df, id_col, text_col).mapInArrow(run, TOKENS_SCHEMA)


def cut(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pass 2: the pieces of tokenised documents (written rows of `tokenized`)."""
    # one row per input partition, so broadcast whatever the amount of data
    bases = F.broadcast(partition_bases(tokens, "part", "doc_tokens"))
    placed = tokens.join(bases, "part").withColumn("at", F.col("base") + F.col("before"))
    pieces = placed.select("doc_id", "doc_tokens", F.expr(f"""
        explode(transform(sequence(at div {window}, (at + doc_tokens - 1) div {window}), s -> named_struct(
            'sequence_id', s,
            'start', greatest(s * {window} - at, 0L),
            'offset', greatest(at - s * {window}, 0L),
            'ids', substring(ids,
                cast(greatest(s * {window} - at, 0L) * 4 + 1 as int),
                cast((least(at + doc_tokens, (s + 1) * {window}) - greatest(at, s * {window})) * 4 as int)))))
        """).alias("p"))
    return pieces.select(
        "doc_id", "p.start", (F.octet_length("p.ids") / 4).cast("long").alias("length"), "doc_tokens",
        "p.sequence_id", "p.offset", "p.ids")


def pack(df: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: doc_id, start (ids of the document before the
    piece), length, doc_tokens, sequence_id, offset (in the sequence), ids."""
    return cut(written(tokenized(df, tokenizer_path, end_id, id_col, text_col), "packing-tokens"), window)


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, n_ids, ids. A group is at most one
    window of ids."""
    return (pieces.groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", F.expr("reduce(p.ids, cast('' as binary), (a, x) -> concat(a, x))").alias("ids"))
            .select("sequence_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), "ids"))
