"""Token totals kept up to date by signed changes.

A change is one row: source, lang, tokenizer (its version), documents and
tokens, both signed. An insert counts +1 and +n, a delete -1 and -n, a revised
count 0 and new - old (`inserts`, `deletes`, `revisions`). Totals are additive,
so a batch of any size is summed first (partial aggregates: a hot source costs
one row a task) and only the sums are stored.

Store (a folder that all executors share):
  deltas/<batch id>/     the sums of one batch; its _SUCCESS file is the commit
  snapshots/<n>/         the sums of many batches; batches/<n>/ names them
A batch id is committed once: a later commit of the same id changes nothing,
and a batch whose write broke off has no _SUCCESS, is not read, and is written
anew. `compact` folds the committed deltas into the next snapshot; readers take
the last finished snapshot and the deltas it does not name, so a compaction
that broke off, or runs beside a reader, changes no total.

Defined results: null source, lang or tokenizer is a key like any other; null
documents or tokens count 0; keys whose documents and tokens are both 0 have
no row; an empty batch is a commit without rows; a store without batches has no
totals; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"


def _signed(rows: DataFrame, documents: int, tokens: Column, tokenizer: Column | str) -> DataFrame:
    version = F.lit(tokenizer) if isinstance(tokenizer, str) else tokenizer
    return rows.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       version.cast("string").alias("tokenizer"), F.lit(documents).cast("long").alias("documents"),
                       tokens.cast("long").alias("tokens"))


def inserts(rows: DataFrame, tokens: Column, tokenizer: Column | str) -> DataFrame:
    return _signed(rows, 1, tokens, tokenizer)


def deletes(rows: DataFrame, tokens: Column, tokenizer: Column | str) -> DataFrame:
    return _signed(rows, -1, -tokens, tokenizer)


def revisions(rows: DataFrame, old: Column, new: Column, tokenizer: Column | str) -> DataFrame:
    return _signed(rows, 0, new - old, tokenizer)


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*KEYS).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
                                        for c in ("documents", "tokens")])


class Rollup:
    """The totals in one store."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _finished(self, kind: str) -> list[str]:
        """Names of the finished writes of a kind (folders with _SUCCESS): metadata only."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        top = hadoop(f"{self.path}/{kind}")
        fs = top.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.exists(top):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(top)]
        return sorted(n for n in names if fs.exists(hadoop(f"{self.path}/{kind}/{n}/_SUCCESS")))

    def _read(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)

    def _folded(self) -> tuple[int, set[str]]:
        """The last finished snapshot's number (0: none) and the batches in it."""
        done = [int(n) for n in set(self._finished("snapshots")) & set(self._finished("batches"))]
        last = max(done, default=0)
        names = self.spark.read.text(f"{self.path}/batches/{last:012d}").collect() if last else []
        return last, {r.value for r in names}

    def committed(self) -> set[str]:
        return set(self._finished("deltas")) | self._folded()[1]

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch; False (and nothing done) if this id was committed before."""
        if not batch_id or "/" in batch_id or batch_id[0] in "._":
            raise ValueError(f"not a batch id: {batch_id!r}")
        if batch_id in self.committed():
            return False
        _summed(changes).write.mode("overwrite").parquet(f"{self.path}/deltas/{batch_id}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents, tokens of all committed batches."""
        last, folded = self._folded()
        paths = [f"{self.path}/deltas/{n}" for n in self._finished("deltas") if n not in folded]
        if last:
            paths.append(f"{self.path}/snapshots/{last:012d}")
        return _summed(self._read(*paths)).where("documents <> 0 or tokens <> 0")

    def compact(self) -> int:
        """Fold all committed batches into the next snapshot; its number. The
        snapshot counts once its list of batches is finished too."""
        last, folded = self._folded()
        names = sorted(folded | set(self._finished("deltas")))
        if len(names) == len(folded):
            return last
        self.totals().write.mode("overwrite").parquet(f"{self.path}/snapshots/{last + 1:012d}")
        (self.spark.createDataFrame([(n,) for n in names], "value string").coalesce(1)
         .write.mode("overwrite").text(f"{self.path}/batches/{last + 1:012d}"))
        return last + 1

    def follow(self, changes: DataFrame, checkpoint: str, name: str = "stream"):
        """Commit a stream of changes: each micro-batch under its own number, so
        a micro-batch that Spark runs again after a failure counts once."""
        return (changes.writeStream.option("checkpointLocation", checkpoint)
                .foreachBatch(lambda df, n: self.commit(f"{name}-{n:012d}", df))
                .trigger(availableNow=True).start())
