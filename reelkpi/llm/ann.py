"""Nearest vectors by largest inner product: multiprobe p-stable hashing.

Reduction: with M the greatest norm, x -> (x / M, sqrt(1 - |x|^2 / M^2)) and
q -> (q / |q|, 0) make the largest inner product the least Euclidean distance.

Index: TABLES tables of k hash functions floor((a . (x - mean) / spread + b) / WIDTH)
with Gaussian a, spread the deviation of a . x, and b uniform; the outer slots
are open. k follows the logarithm of the number of rows, so that a bucket holds
about ROWS_A_BUCKET of them. Every row is in every table.

Search: a query scores every slot of every function by the chance that a near
row falls into it over the share of all rows that do, and visits the buckets
of a table whose product of these ratios is at least a threshold: that is the
order of estimated success for each row read, followed down to the threshold
(branch and bound over the functions, no limit on their number). The candidates
of all tables are merged and ranked by exact inner products in double precision.

Fitting: mean, spreads and shares come from a sample of at most SAMPLE rows;
slope, deviation and threshold from the true neighbours, among all rows, of at
most TUNING queries, so that RECALL of these are reached. Both are bounded
parameters; index and search cover all rows.

Scale: equal vectors are one class (only its k + 1 least ids can be among
anyone's k nearest; the window keeps that many before it shuffles), so copies
cost nothing. Buckets go to groups of about GROUP_ROWS rows by hash; a bucket
of more than SPLIT rows is split by a salt and its probes sent to every part.
A group returns at most k + 1 classes a query. A query that found too few rows
is run against all rows, in blocks.

Defined results: vectors that are null, zero, hold null or non-finite
components, or are not of the commonest length take no part; a null id takes no
part; rows with one id but different vectors are rows of their own, each a
candidate (also of the others) and each with a list of its own if it is a query;
equal rows (id and vector) are one; ties go to smaller ids;
a query with fewer candidates than k gets all of them; without queries or rows
there is no row; extra columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelkpi.llm.common import written

TABLES, WIDTH, SLOTS = 8, 2.0, 3
ROWS_A_BUCKET, GROUP_ROWS, SPLIT = 1024, 1 << 16, 8192
SAMPLE, TUNING, RECALL = 4096, 128, 0.96
FOUND = "qid string, best array<struct<score: double, cid: string>>"


def classes(df: DataFrame, k: int, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """(members, classes): vec_id and class of every distinct row that takes part; cid,
    the k + 1 least ids and the vector of every class of equal vectors."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))
    fine = (F.col("vec_id").isNotNull() & F.exists("v", lambda x: x != 0)
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.where(fine)
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("v") == (common["d"] if common else 0))
    # -0.0 and 0.0 are equal components; the class name is a digest of all of them
    plain = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0).cast("float")).otherwise(x))
    rows = rows.withColumn("v", plain.cast(dict(rows.dtypes)["v"]))
    name = F.concat(F.hex(F.xxhash64("v")), F.hex(F.xxhash64(F.lit(1), F.reverse("v"))))
    once = rows.select("vec_id", name.alias("cid"), "v").groupBy("vec_id", "cid").agg(F.any_value("v").alias("v"))
    members = written(once, "ann-members")
    rank = Window.partitionBy("cid").orderBy("vec_id")
    least = members.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= k + 1)
    grouped = least.groupBy("cid").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"),
                                       F.max(F.when(F.col("r") == 1, F.col("v"))).alias("v"))
    return members.select("vec_id", "cid"), written(grouped, "ann-classes")


def _vectors(column) -> np.ndarray:
    """Rows of a list column as a double matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _normal(x: np.ndarray) -> np.ndarray:
    """Normal distribution function (to about 1e-7, Abramowitz and Stegun 7.1.26)."""
    t = 1 / (1 + 0.3275911 * np.abs(x) / np.sqrt(2))
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return 0.5 * (1 + np.sign(x) * (1 - poly * np.exp(-x * x / 2)))


@dataclass
class Index:
    """The fitted functions. Arrays over functions have TABLES * k entries."""

    greatest: float
    a: np.ndarray
    b: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    k: int
    share: np.ndarray  # (functions, SLOTS): log share of all rows in each slot
    slope: float = 1.0
    deviation: float = 1.0
    threshold: float = -np.inf

    def rows(self, x: np.ndarray) -> np.ndarray:
        rest = 1 - (x * x).sum(axis=1) / self.greatest ** 2
        return self._z(np.column_stack([x / self.greatest, np.sqrt(np.maximum(rest, 0))]))

    def queries(self, q: np.ndarray) -> np.ndarray:
        return self._z(np.column_stack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros(len(q))]))

    def _z(self, x):
        return ((x - self.mean) @ self.a) / self.spread

    def slots(self, z: np.ndarray) -> np.ndarray:
        return np.clip(np.floor((z + self.b) / WIDTH), -1, SLOTS - 2).astype(np.int64) + 1

    def codes(self, z: np.ndarray) -> np.ndarray:
        """(rows, TABLES) bucket numbers."""
        return self.slots(z).reshape(len(z), TABLES, self.k) @ (SLOTS ** np.arange(self.k))

    def gains(self, z: np.ndarray) -> np.ndarray:
        """(queries, functions, SLOTS): log of near rows' chance over all rows' share."""
        edges = np.arange(SLOTS - 1)[:, None] * WIDTH - self.b
        below = _normal((edges[None] - self.slope * z[:, None, :]) / self.deviation)
        ends = np.concatenate([np.zeros_like(below[:, :1]), below, np.ones_like(below[:, :1])], axis=1)
        chance = np.diff(ends, axis=1).transpose(0, 2, 1)
        return np.log(np.maximum(chance, 1e-12)) - self.share

    def probes(self, gain: np.ndarray) -> list[np.ndarray]:
        """Buckets of each table to visit, best first; gain: one query's (functions, SLOTS)."""
        out = []
        for g in gain.reshape(TABLES, self.k, SLOTS):
            rest = np.concatenate([np.cumsum(g.max(axis=1)[::-1])[::-1][1:], [0.0]])
            code, score = np.zeros(1, np.int64), np.zeros(1)
            for i in range(self.k):
                score = (score[:, None] + g[i]).ravel()
                code = (code[:, None] + np.arange(SLOTS) * SLOTS ** i).ravel()
                keep = score + rest[i] >= self.threshold
                code, score = code[keep], score[keep]
            out.append(code[np.argsort(-score, kind="stable")])
        return out


def best(q: np.ndarray, x: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the `keep` rows of largest inner product with each
    query, and of more at a tie with the last. The product of matrices only
    chooses; the scores are sums in one fixed order, equal for equal vectors."""
    rough = q @ x.T
    if len(x) > keep:
        least = np.partition(rough, len(x) - keep, axis=1)[:, len(x) - keep]
        slack = 1e-9 * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
        of, at = np.nonzero(rough >= (least - slack)[:, None])
    else:
        of, at = np.divmod(np.arange(rough.size), max(1, len(x)))
    return of, at, (x[at] * q[of]).sum(axis=1)


def merge(of: np.ndarray, name: np.ndarray, score: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The `keep` best distinct names of each query, and more at a tie with the last; sorted."""
    order = np.lexsort((name, -score, of))
    of, name, score = of[order], name[order], score[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (name[1:] != name[:-1]) | (score[1:] != score[:-1])
    of, name, score = of[new], name[new], score[new]
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    rank = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
    last = np.repeat(score[np.minimum(first + keep - 1, np.append(first[1:], len(of)) - 1)], np.diff(np.append(first, len(of))))
    stay = (rank < keep) | (score >= last)
    return of[stay], name[stay], score[stay]


def _found(queries: pa.Array, of: np.ndarray, names: pa.Array, name: np.ndarray, score: np.ndarray) -> pa.Table:
    """One row for each query with a list of (score, cid); sorted input."""
    starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    pairs = pa.StructArray.from_arrays([pa.array(score, pa.float64()), names.take(pa.array(name, pa.int64()))],
                                       ["score", "cid"])
    offsets = pa.array(np.append(starts, len(of)).astype(np.int32))
    return pa.table({"qid": queries.take(pa.array(of[starts], pa.int64())), "best": pa.ListArray.from_arrays(offsets, pairs)})


def _strings(column) -> pa.Array:
    return column.combine_chunks().cast(pa.string()) if isinstance(column, pa.ChunkedArray) else column


def exact(queries: DataFrame, base: DataFrame, keep: int, n_queries: int, n_base: int) -> DataFrame:
    """(qid, best) of queries (cid, v) against all classes (cid, v), in blocks:
    every block of queries meets every block of rows in a task of its own."""
    q_blocks, b_blocks = max(1, -(-n_queries // 1024)), max(1, -(-n_base // 16384))
    left = base.select((F.pmod(F.xxhash64("cid"), F.lit(b_blocks))).cast("int").alias("bb"), "cid", "v",
                       F.explode(F.array(*map(F.lit, range(q_blocks)))).alias("qb"))
    right = queries.select((F.pmod(F.xxhash64("cid"), F.lit(q_blocks))).cast("int").alias("qb"), "cid", "v",
                           F.explode(F.sequence(F.lit(0), F.lit(b_blocks - 1))).alias("bb"))

    def run(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        of, at, score = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if rows.num_rows and wanted.num_rows:
            of, at, score = best(_vectors(wanted["v"]), _vectors(rows["v"]), keep)
        of, at, score = merge(of, at, score, keep)
        return _found(_strings(wanted["cid"]), of, _strings(rows["cid"]), at, score)

    return left.groupBy("bb", "qb").cogroup(right.groupBy("bb", "qb")).applyInArrow(run, FOUND)


def _ranked(found: DataFrame, base: DataFrame, keep: int) -> DataFrame:
    """(qid, ids): the `keep` best (score, id, class) of each query over all its lists."""
    each = found.select("qid", F.explode("best").alias("b")).select("qid", "b.score", "b.cid").distinct()
    ids = each.join(base.select("cid", "ids"), "cid")
    # a group of at most (lists of the query) * keep classes; equal scores by least id
    rank = Window.partitionBy("qid").orderBy(F.desc("score"), F.col("ids")[0], "cid")
    top = ids.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= keep)
    pairs = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("less"), i.alias("vec_id"), F.col("cid").alias("cid")))
    return top.groupBy("qid").agg(F.slice(F.sort_array(F.flatten(F.collect_list(pairs))), 1, keep).alias("ids"))


def fit(base: DataFrame, queries: DataFrame, keep: int, n: int, recall: float = RECALL, seed: int = 11) -> Index:
    """Functions and threshold from bounded samples; see the module's text."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    greatest = base.agg(F.max(norm)).first()[0]
    order = F.xxhash64("cid", F.lit(3)), "cid"
    sample = _vectors(base.orderBy(*order).select("v").limit(SAMPLE).toArrow()["v"])
    d = sample.shape[1] + 1
    k = max(1, round(np.log2(max(n, 1) / ROWS_A_BUCKET) / 1.2)) if n > ROWS_A_BUCKET else 1
    rng = np.random.default_rng(seed)
    index = Index(greatest, rng.normal(size=(d, TABLES * k)), rng.uniform(0, WIDTH, TABLES * k), np.zeros(d),
                  np.ones(TABLES * k), k, np.zeros((TABLES * k, SLOTS)))
    lifted = np.column_stack([sample / greatest, np.sqrt(np.maximum(0, 1 - (sample ** 2).sum(axis=1) / greatest ** 2))])
    index.mean = lifted.mean(axis=0)
    index.spread = np.maximum((lifted @ index.a).std(axis=0), 1e-9)
    slots = index.slots(index.rows(sample))
    counts = np.stack([(slots == s).sum(axis=0) for s in range(SLOTS)], axis=1)
    index.share = np.log((counts + 0.5) / (len(sample) + 0.5 * SLOTS))
    # the true neighbours of some queries, among all rows
    tuning = queries.orderBy(F.xxhash64("cid", F.lit(4)), "cid").limit(TUNING)
    tuning = written(tuning, "ann-tuning")
    truth = exact(tuning, base, keep, TUNING, n).select("qid", F.explode("best").alias("b")).select("qid", "b.*")
    rank = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
    truth = truth.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= keep).where("qid <> cid")
    pairs = truth.join(base.select("cid", F.col("v").alias("x")), "cid").join(
        tuning.select(F.col("cid").alias("qid"), "v"), "qid").select("v", "x").toArrow()
    if pairs.num_rows:
        zq, zx = index.queries(_vectors(pairs["v"])), index.rows(_vectors(pairs["x"]))
        index.slope = float((zq * zx).sum() / max((zq * zq).sum(), 1e-9))
        index.deviation = max(float((zx - index.slope * zq).std()), 1e-3)
        gain = np.take_along_axis(index.gains(zq), index.slots(zx)[:, :, None], axis=2)[:, :, 0]
        reached = gain.reshape(len(zq), TABLES, k).sum(axis=2).max(axis=1)
        index.threshold = float(np.quantile(reached, 1 - recall)) - 1e-6
    return index


def search(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           recall: float = RECALL) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of every row
    for which `is_query` (a condition on vec_id) holds, the row itself left out."""
    spark = df.sparkSession
    members, base = classes(df, k, id_col, vector_col)
    asked = members.where(is_query)
    queries = written(base.join(asked.select("cid").distinct(), "cid", "left_semi").select("cid", "v"), "ann-queries")
    n, n_queries, keep = base.count(), queries.count(), k + 1
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = fit(base, queries, keep, n, recall)
    groups = max(1, -(-n * TABLES // GROUP_ROWS))

    def to_buckets(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                codes = index.codes(index.rows(_vectors(part.column(1))))
                rows = pa.array(np.repeat(np.arange(part.num_rows), TABLES))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(TABLES, dtype=np.int32), part.num_rows)), pa.array(codes.ravel()),
                     part.column(0).take(rows), part.column(1).take(rows)], ["t", "code", "cid", "v"])

    def to_probes(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                gains = index.gains(index.queries(_vectors(part.column(1))))
                visits = [index.probes(g) for g in gains]
                each = [(i, t, c) for i, v in enumerate(visits) for t, c in enumerate(v)]
                counts = [len(c) for _, _, c in each]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([t for _, t, _ in each], counts).astype(np.int32)),
                     pa.array(np.concatenate([c for _, _, c in each]).astype(np.int64)),
                     part.column(0).take(pa.array(np.repeat([i for i, _, _ in each], counts).astype(np.int64)))],
                    ["t", "code", "qid"])

    kind = dict(base.dtypes)["v"]
    rows = base.select("cid", "v").mapInArrow(to_buckets, f"t int, code long, cid string, v {kind}")
    sizes = written(base.select("cid", "v").mapInArrow(to_buckets, f"t int, code long, cid string, v {kind}")
                    .groupBy("t", "code").count().withColumn("parts", F.ceil(F.col("count") / SPLIT).cast("int")),
                    "ann-buckets")
    split = sizes.where("parts > 1").select("t", "code", "parts")
    group = F.pmod(F.xxhash64("t", "code", "part"), F.lit(groups)).alias("g")
    placed = (rows.join(split, ["t", "code"], "left")
              .withColumn("part", F.pmod(F.xxhash64("cid"), F.coalesce("parts", F.lit(1))).cast("int"))
              .select(group, "t", "code", "cid", "v"))
    probes = (queries.mapInArrow(to_probes, "t int, code long, qid string").join(sizes, ["t", "code"])
              .select("qid", "t", "code", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
              .select("qid", group, "t", "code"))
    visits = probes.groupBy("g", "qid").agg(F.collect_set(F.struct("t", "code")).alias("buckets"))
    visits = visits.join(queries.select(F.col("cid").alias("qid"), "v"), "qid")

    def rerank(rows: pa.Table, visits: pa.Table) -> pa.Table:
        held = [[], [], []]
        if rows.num_rows and visits.num_rows:
            x, q = _vectors(rows["v"]), _vectors(visits["v"])
            named = _strings(rows["cid"]).dictionary_encode()
            names, name_of = named.dictionary, named.indices.to_numpy()
            key = rows["code"].to_numpy() * TABLES + rows["t"].to_numpy()
            order = np.argsort(key, kind="stable")
            keys, starts = np.unique(key[order], return_index=True)
            ends = np.append(starts[1:], len(order))
            lists = visits["buckets"].combine_chunks()
            flat = lists.flatten()
            wanted = (flat.field("code").to_numpy(zero_copy_only=False) * TABLES
                      + flat.field("t").to_numpy(zero_copy_only=False))
            of = np.repeat(np.arange(len(q)), np.diff(lists.offsets.to_numpy()))
            by_bucket = np.argsort(wanted, kind="stable")
            bounds = np.flatnonzero(np.diff(wanted[by_bucket], prepend=-1))
            size = 0
            for a, b in zip(bounds, [*bounds[1:], len(by_bucket)]):
                place = int(np.searchsorted(keys, wanted[by_bucket[a]]))
                if place == len(keys) or keys[place] != wanted[by_bucket[a]]:
                    continue
                at = order[starts[place]:ends[place]]
                for c in range(a, b, 512):
                    who = of[by_bucket[c:min(b, c + 512)]]
                    i, j, score = best(q[who], x[at], keep)
                    for column, part in zip(held, (who[i], name_of[at[j]].astype(np.int64), score)):
                        column.append(part)
                    size += len(i)
                if size > 1 << 21:
                    held = [[c] for c in merge(*map(np.concatenate, held), keep)]
                    size = len(held[0][0])
        if not held[0]:
            empty = np.zeros(0, np.int64)
            return _found(_strings(visits["qid"]), empty, _strings(rows["cid"]), empty, np.zeros(0))
        of, name, score = merge(*map(np.concatenate, held), keep)
        return _found(_strings(visits["qid"]), of, names, name, score)

    found = written(placed.groupBy("g").cogroup(visits.groupBy("g")).applyInArrow(rerank, FOUND), "ann-found")
    ranked = written(_ranked(found, base, keep), "ann-ranked")
    # queries that found fewer than they could: against all rows
    need = min(keep, base.agg(F.sum(F.size("ids"))).first()[0])
    few = written(queries.join(ranked.where(F.size("ids") >= need), queries.cid == F.col("qid"), "left_anti"), "ann-few")
    if (n_few := few.count()):
        again = _ranked(exact(few, base, keep, n_few, n), base, keep)
        ranked = ranked.where(F.size("ids") >= need).unionByName(again)
    own = asked.join(ranked, asked.cid == ranked.qid).select(
        F.col("vec_id").alias("query_id"),
        F.slice(F.filter("ids", lambda x: (x["vec_id"] != F.col("vec_id")) | (x["cid"] != F.col("cid"))), 1, k).alias("ids"))
    return own.select("query_id", F.posexplode("ids").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.less")).alias("score"))
