"""Helpers shared by the operators: reading, written tables, worker-side state."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelkpi.session import scratch_path, shared_root

#: Bytes of text that a worker holds as Python objects at a time.
SLICE_BYTES = 1 << 20


def ship() -> None:
    """Pickle this package's functions by value: executors need not import it."""
    cloudpickle.register_pickle_by_value(sys.modules[__package__])


ship()


#: Rows that Spark hands to a Python worker at once: texts can be long.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of Arrow batches for this session; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """`df` written as Parquet below the shared folder (in folders by the values of
    column `by`) and read back.

    This cuts the lineage: a lost executor costs a re-read of files, and what
    tasks numbered (partition, position) stays as it was written.
    """
    spark = df.sparkSession
    small_batches(spark)
    target = scratch_path(spark, name)
    out = df.write.option("compression", "zstd")
    (out.partitionBy(by) if by else out).parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def dropped(*tables: DataFrame, part: str = "") -> None:
    """Delete the files of tables that `written` made and nobody reads any more, or
    of one part ("column=value"); only folders below the shared one are touched."""
    for df in tables:
        spark = df.sparkSession
        root = shared_root(spark).split("://")[-1].removeprefix("file:")
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if f"{root}/" in f"{folder}/" and folder.endswith(part):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def worker_state(key: str, make):
    """An object kept for the life of a Python worker process (loaded vocabularies,
    bounded caches), so that the many tasks of a worker share it."""
    store = sys.__dict__.setdefault("_reelkpi_worker_state", {})
    if key not in store:
        store[key] = make()
    return store[key]


def text_slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) for runs of rows of at most SLICE_BYTES of text, at
    least one row each; a null text is the empty text."""
    col = batch.column(batch.schema.get_field_index(column))
    start, held, texts = 0, 0, []
    for i in range(len(col)):
        text = col[i].as_py() or ""
        if texts and held + len(text) > SLICE_BYTES:
            yield start, texts
            start, held, texts = i, 0, []
        texts.append(text)
        held += len(text)
    if texts:
        yield start, texts


def keyed_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under its own names; extra columns,
    whatever their names, are left out."""
    small_batches(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))


def partition_bases(df: DataFrame, part: str, amount: str) -> DataFrame:
    """(part, base): the total `amount` of all earlier parts, one row per part.

    The first pass adds up inside the parts (partial aggregates, one row per
    part and task); the running sum sees one row per input partition only, a
    count that Spark's own driver tracks, and never a row of data.
    """
    from pyspark.sql import Window

    totals = df.groupBy(part).agg(F.sum(amount).alias("_total"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("base"))


SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32
#: An odd number and its inverse modulo 2^64, for sums over a run of bytes.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n or more powers of BASE and INVERSE, kept by the worker."""
    held = worker_state("powers", list)
    if not held or len(held[0]) < n:
        held.clear()
        for base in (BASE, INVERSE):
            p = np.full(max(n, 1 << 17) * 5 // 4, base, np.uint64)
            p[0] = 1
            held.append(np.multiply.accumulate(p))
    return held[0], held[1]


def run_hashes(data: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
    """A 64-bit hash (unsigned) of each run data[start:end]; equal for equal runs."""
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * inverse[:len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * power[starts]


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes with all bits depending on all bits (a bijection)."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Places:
    """The place of a key in an array of distinct keys (open addressing, in numpy)."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.bits = np.zeros(0, np.int64), 4
        self.table = np.full(1 << self.bits, -1, np.int32)
        self.add(keys)

    def add(self, keys: np.ndarray) -> None:
        """More keys, distinct and not there yet; their places follow the others'."""
        before = len(self.keys)
        self.keys = np.concatenate([self.keys, np.ascontiguousarray(keys, dtype=np.int64)])
        if 2 * len(self.keys) > len(self.table):
            self.bits = int(4 * len(self.keys)).bit_length()
            self.table, before = np.full(1 << self.bits, -1, np.int32), 0
        left = np.arange(before, len(self.keys))
        at = self._slots(self.keys[before:])
        while len(left):  # all keys step on together until each has a slot of its own
            free = np.flatnonzero(self.table[at] == -1)
            _, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.table[at[placed]] = left[placed]
            left, at = np.delete(left, placed), np.delete(at, placed)
            at = (at + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(BASE)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys, -1 where a key is not there."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        keys = np.ascontiguousarray(keys, dtype=np.int64)
        at = self._slots(keys)
        out = self.table[at].astype(np.int64)
        todo = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            out[todo] = self.table[at[todo]]
            todo = todo[(out[todo] >= 0) & (self.keys[out[todo]] != keys[todo])]
        return out


def word_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """63-bit keys of all words (runs of bytes but 9-13 and 32, A-Z made small)
    of the texts, one text after the other, and the number of words of each."""
    parts = [t.encode("utf-8") for t in texts]
    raw = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
    solid = ~SPACES[raw]
    edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    edges = np.concatenate([[0], edges]) if len(solid) and solid[0] else edges
    starts, ends = edges[::2], edges[1::2]
    keys = (mixed(run_hashes(SMALL[raw], starts, ends)) >> np.uint64(1)).astype(np.int64)
    bounds = np.searchsorted(starts, np.cumsum([0, *[len(p) + 1 for p in parts]]))
    return keys, np.diff(bounds)
