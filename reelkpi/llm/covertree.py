"""Exact top-k by inner product: dual-tree search over cover trees.

Vectors are whole numbers, so that scores are exact. Top of the tree: up to
PIVOTS vectors of a bounded sample, each far from the others, are the cells'
centres; every vector lies below its nearest one, and the cell's radius covers
all of them. Below, a cell is dealt into blocks of about BLOCK vectors, and a
block has a cover tree: the children of a node are a net of its vectors at half
its radius (farthest first: the centres lie more than that apart, all vectors
lie within it of one, and the node's centre is one of them). A node is a leaf
when it is small, or when its net would not thin it out.

Queries are indexed together in the same way: groups of about GROUP queries of
a cell, with a tree each. Group and block are walked side by side. For nodes
with centres a, b and covering radii r, s no product exceeds
a.b + r|b| + s|a| + r s; a pair of nodes whose bound is below the worst k-th
score of the group's queries is dropped. The same bound, of group and cell,
decides where a group goes at all, in rounds: to the cell of highest bound, the
next ROUNDS[0], and all others, so that its worst k-th score is known early.

Scale: equal vectors are one class, of which only the k + 1 least ids can be
among anyone's k best (the window keeps that many before it shuffles). Rows of
a hot class or cell are dealt to blocks by hash. A block meets at most about
SLICE groups a task; more get copies of it. Only cells' totals (at most PIVOTS
for each power of two of the vectors' length) come to the driver. Partial
results hold what reaches the k-th score known before the round, at most k + 1
a block, and are cut to k + 1 a query before they shuffle.

Defined results: a vector that is null, or holds a null or non-finite component,
takes no part, nor does a null id; a zero or empty vector does. A shorter vector
counts as padded by zeros. Rows that repeat an id are rows of their own; a query
leaves out its own row only. Ties go to smaller ids. A query with fewer
candidates than k gets them all. No queries or rows: no result. Components
beyond 64 bits count as the greatest such number; a score beyond 64 bits fails
with an error, one beyond 50 bits is computed in Python's numbers. Extra columns
are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelkpi.llm.common import small_batches, written

SAMPLE, PIVOTS, BLOCK, GROUP, SLICE, LEAF = 4096, 256, 4096, 256, 64, 64
#: Cells that a group has been to after each round but the last.
ROUNDS = (1, 16)
#: Bounds in floating point are raised by this share.
SLACK = 1e-9
MEMBERS = "array<struct<vec_id: long, row: long>>"


def whole(x: Column, scale: int) -> Column:
    """The vector of floor(scale * component), components as double."""
    return F.transform(x, lambda c: F.floor(c.cast("double") * scale))


def classes(df: DataFrame, queries: Column, k: int, id_col: str, vector_col: str, scale: int) -> tuple[DataFrame, DataFrame]:
    """(classes, owners): each distinct vector with cid and its k + 1 least
    members; and each query row with the cid of its vector."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))
    fine = F.col("vec_id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(fine).select("vec_id", F.coalesce(queries, F.lit(False)).alias("asks"), whole(F.col("v"), scale).alias("v"))
    # the name of a vector: 128 bits of it
    name = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), F.reverse("v")).alias("h2")]
    rows = written(rows.select("vec_id", F.monotonically_increasing_id().alias("row"), "asks", *name, "v"), "covertree-rows")
    rank = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id", "row"))
    least = rows.drop("asks").withColumn("_rank", rank).where(F.col("_rank") <= k + 1)
    grouped = least.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("vec_id", "row"))).alias("ids"),
                                            F.max(F.when(F.col("_rank") == 1, F.col("v"))).alias("v"))
    known = written(grouped.withColumn("cid", F.col("ids")[0]["row"]), "covertree-classes")
    owners = rows.where("asks").select("vec_id", "row", "h1", "h2").join(known.select("h1", "h2", "cid"), ["h1", "h2"])
    return known.select("cid", "ids", "v"), written(owners.select("vec_id", "row", "cid"), "covertree-owners")


def matrix(column) -> np.ndarray:
    """Rows of a list column, padded by zeros, as a matrix of numbers that are
    exact in all products: doubles where they are small enough, else Python's."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray) or not len(column):
        return np.zeros((0, 0))
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    most = max(int(flat.max(initial=0)), -int(flat.min(initial=0)))
    return out.astype(np.float64) if most * most * max(1, out.shape[1]) < 1 << 50 else out.astype(object)


def common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices over the components that both have, in numbers exact for their products."""
    if a.dtype != b.dtype:
        a, b = a.astype(object), b.astype(object)
        if len(a) and len(b):  # doubles hold whole numbers here
            to_int = np.frompyfunc(int, 1, 1)
            a, b = to_int(a) if a.size else a, to_int(b) if b.size else b
    d = min(a.shape[1], b.shape[1])
    return a[:, :d], b[:, :d]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = common(a, b)
    if not a.shape[1]:
        return np.zeros((len(a), len(b)))
    return a @ b.T


def norms(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return np.sqrt((x * x).sum(axis=1))


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances of rows x (doubles) from one vector of the same length."""
    y = x - c
    return np.sqrt(np.einsum("ij,ij->i", y, y))


def farthest_first(x: np.ndarray, first: int, most: int, radius: float) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(centres, nearest, distance): rows chosen, each the farthest from those
    before, until all lie within `radius` of one, or one more than `most` are chosen."""
    centres, nearest = [first], np.zeros(len(x), np.int64)
    distance = distances(x, x[first])
    while len(centres) <= most and distance.max() > radius:
        centres.append(int(distance.argmax()))
        own = distances(x, x[centres[-1]])
        closer = own < distance
        nearest[closer], distance[closer] = len(centres) - 1, own[closer]
    return centres, nearest, distance


class CoverTree:
    """Nodes in arrays: the vectors of node i are order[start[i]:end[i]], its
    centre the vector centre[i], its children first[i]:first[i] + children[i]."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        x = x.astype(np.float64)
        order = np.arange(len(x))
        middle = int(distances(x, x.mean(axis=0)).argmin())
        nodes = [[0, len(x), middle, float(distances(x, x[middle]).max()), 0, 0]]
        at = 0
        while at < len(nodes):
            start, end, centre, radius, _, _ = node = nodes[at]
            at += 1
            if end - start <= leaf or radius == 0:
                continue
            own = order[start:end].copy()
            most = (end - start) // 8
            centres, nearest, distance = farthest_first(x[own], int(np.flatnonzero(own == centre)[0]), most, radius / 2)
            if len(centres) > most:
                continue  # a net at half the radius would not thin it out
            by = np.argsort(nearest, kind="stable")
            order[start:end] = own[by]
            bounds = start + np.searchsorted(nearest[by], np.arange(len(centres) + 1))
            node[4:] = len(nodes), len(centres)
            farthest = np.zeros(len(centres))
            np.maximum.at(farthest, nearest, distance)
            nodes += [[int(bounds[i]), int(bounds[i + 1]), int(own[c]), float(farthest[i]), 0, 0] for i, c in enumerate(centres)]
        self.order = order
        self.start, self.end, self.centre, self.radius, self.first, self.children = (np.array(c) for c in zip(*nodes))


def dual_search(q: np.ndarray, x: np.ndarray, k: int, worst: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, vector, score) of the k highest scores of each query of at least
    `worst`, ties to lower rows of x, and the number of products computed."""
    exact = q.dtype == x.dtype and q.dtype != object
    qt, xt = CoverTree(q), CoverTree(x)
    qn, xn = norms(q), norms(x)
    n, number = len(x), np.int64 if exact else object
    # a score and the place of its vector in one number: higher is better
    low = -(1 << 62) if exact else -(1 << 200)
    best = np.full((len(q), k), low, number)
    kth = np.array([low // n if w == -np.inf else int(w) for w in worst], number)
    tie = np.arange(n - 1, -1, -1).astype(number)
    if not exact:
        tie = np.array([int(t) for t in tie], object)
    done = 0

    def bounds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ca, cb = qt.centre[a], xt.centre[b]
        ra, rb, na, nb = qt.radius[a][:, None], xt.radius[b][None], qn[ca][:, None], xn[cb][None]
        over = products(q[ca], x[cb]).astype(np.float64) + ra * nb + rb * na + ra * rb
        return over + SLACK * (1 + na * nb + ra * nb + rb * na + ra * rb)

    def floor(a: int) -> float:
        return float(kth[qt.order[qt.start[a]:qt.end[a]]].min())

    stack = [(np.inf, 0, 0)]
    while stack:
        bound, a, b = stack.pop()
        if bound < floor(a):
            continue
        if not qt.children[a] and not xt.children[b]:
            own, of = qt.order[qt.start[a]:qt.end[a]], xt.order[xt.start[b]:xt.end[b]]
            scores = products(q[own], x[of])
            done += scores.size
            some = np.flatnonzero((scores >= kth[own][:, None]).any(axis=1))
            own = own[some]
            keys = (scores[some].astype(number) if exact else np.frompyfunc(int, 1, 1)(scores[some])) * n + tie[of]
            keys = np.concatenate([best[own], keys], axis=1)
            if len(own):
                keys = -np.sort(-keys, axis=1)[:, :k] if not exact else -np.partition(-keys, k - 1, axis=1)[:, :k]
                best[own] = keys
                kth[own] = np.maximum(kth[own], keys.min(axis=1) // n)
            continue
        below = lambda t, i: np.arange(t.first[i], t.first[i] + t.children[i]) if t.children[i] else np.array([i])
        some, others = below(qt, a), below(xt, b)
        over = bounds(some, others)
        keep = over >= np.array([floor(i) for i in some])[:, None]
        at = np.argwhere(keep)
        at = at[np.argsort(over[keep], kind="stable")]  # the highest bound is popped first
        stack += [(over[i, j], int(some[i]), int(others[j])) for i, j in at]
    best = -np.sort(-best, axis=1)
    score = best // n
    hit = (best > low) & (score >= np.array([low if w == -np.inf else int(w) for w in worst], number)[:, None])
    rows, _ = np.nonzero(hit)
    return rows, n - 1 - (best[hit] % n).astype(np.int64), score[hit], done


def _pivots(known: DataFrame, blocks: int) -> list[np.ndarray]:
    """Centres of the cells, far apart, out of a bounded sample of the vectors."""
    sample = known.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).select("v").toArrow()["v"]
    x = matrix(sample).astype(np.float64)
    if not len(x):
        return []
    chosen, _, _ = farthest_first(x, 0, min(PIVOTS, blocks) - 1, 0.0)
    return [x[i] for i in chosen[:min(PIVOTS, blocks)]]


def _placed(known: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """The classes with their cell, the distance from its centre and its norm.
    Cells are numbered by nearest pivot and the power of two of the length."""
    centres = np.array(pivots)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(batch.schema.get_field_index("v"))
            sizes = np.diff(column.offsets.to_numpy())
            kinds = np.array([int(s).bit_length() for s in sizes])
            cell, distance = np.zeros(len(sizes), np.int64), np.zeros(len(sizes))
            for kind in np.unique(kinds):
                own = np.flatnonzero(kinds == kind)
                x = matrix(column.take(pa.array(own))).astype(np.float64)
                d = max(x.shape[1], centres.shape[1])
                x, c = (np.pad(m, ((0, 0), (0, d - m.shape[1]))) for m in (x, centres))
                squares = np.maximum((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * (x @ c.T), 0)
                cell[own] = kind * PIVOTS + squares.argmin(axis=1)
                y = x - c[squares.argmin(axis=1)]
                distance[own] = np.sqrt((y * y).sum(axis=1)) * (1 + SLACK)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(distance)], [*batch.schema.names, "cell", "distance"])

    schema = f"cid long, ids {MEMBERS}, v array<long>, cell long, distance double"
    return written(known.select("cid", "ids", "v").mapInArrow(run, schema), "covertree-placed")


def _dealt(rows: DataFrame, counts: dict[int, int], size: int, name: str) -> DataFrame:
    """rows with `name`: the cell and a part of it by hash, of about `size` rows."""
    cells = rows.sparkSession.createDataFrame([(c, -(-n // size)) for c, n in sorted(counts.items())], "cell long, parts long")
    part = F.pmod(F.xxhash64(F.lit(name), "cid"), F.col("parts"))
    return rows.join(F.broadcast(cells), "cell").withColumn(name, F.col("cell") * F.lit(1 << 40) + part).drop("parts")


def _trees(placed: DataFrame, counts: dict[int, int]) -> DataFrame:
    """One row a block: its vectors and their members, least id first (ties go to lower rows)."""
    rows = _dealt(placed, counts, BLOCK, "block")
    item = F.struct(F.col("ids")[0]["vec_id"].alias("least"), F.col("ids")[0]["row"].alias("row"), "ids", "v")
    packed = rows.groupBy("block").agg(F.sort_array(F.collect_list(item)).alias("x"))
    return written(packed.select("block", F.col("x.ids").alias("ids"), F.col("x.v").alias("v")), "covertree-blocks")


ASKS = "block long, slice int, cid array<long>, q array<array<long>>, worst array<long>"
FOUND = f"cid long, score long, ids {MEMBERS}"


def _asks(groups: DataFrame, cells: list[tuple], centres: list[np.ndarray], slices: int, low: int, high: int) -> DataFrame:
    """A row for each block that a group goes to in a round: those of the cells
    from the low-th to the high-th by bound that its worst score does not rule out."""
    number, parts, radius = (np.array([c[i] for c in cells]) for i in range(3))
    c = np.array([centres[n % PIVOTS] for n in number])

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("cid").combine_chunks()
        q = matrix(group["v"]).astype(np.float64)
        d = max(q.shape[1], c.shape[1])
        q, x = (np.pad(m, ((0, 0), (0, d - m.shape[1]))) for m in (q, c))
        middle = q.mean(axis=0, keepdims=True)
        own, size, far = distances(q, middle[0]).max(), norms(middle)[0], norms(x)
        over = (middle @ x.T)[0] + own * far + radius * size + own * radius
        over += SLACK * (1 + size * far + own * far + radius * size + own * radius)
        order = np.lexsort((number, -over))[low:high]
        worst = group["worst"].to_numpy()
        least = float(worst.min()) if not np.isnan(worst.astype(float)).any() else -np.inf
        to = [int(number[i]) * (1 << 40) + p for i in order if over[i] >= least for p in range(int(parts[i]))]
        key = int(group["grp"][0].as_py())
        where = ((key * 0x9E3779B97F4A7C15) % (1 << 64) >> 32) % slices
        repeat = lambda column: pa.array([column.to_pylist()] * len(to), pa.list_(column.type))
        return pa.table({"block": pa.array(to, pa.int64()), "slice": pa.array([where] * len(to), pa.int32()),
                         "cid": repeat(group["cid"]), "q": repeat(group["v"]), "worst": repeat(group["worst"])})

    return groups.groupBy("grp").applyInArrow(run, ASKS)


def _search(asks: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """(cid, score, ids): what each block has for the queries that come to it."""
    needed = asks.select(F.col("block").alias("at"), F.col("slice").alias("of")).distinct()
    copies = trees.join(needed, F.col("block") == F.col("at")).select("at", "of", "ids", "v")

    def run(asked: pa.Table, block: pa.Table) -> pa.Table:
        x, ids = matrix(block["v"].combine_chunks().flatten()), block["ids"].combine_chunks().flatten()
        out = []
        for i in range(asked.num_rows):
            q = matrix(asked["q"][i].values)
            a, b = common(q, x)
            worst = np.array([-np.inf if w is None else w for w in asked["worst"][i].as_py()], object)
            rows, found, score, _ = dual_search(a, b, k, worst)
            out.append(pa.table({"cid": asked["cid"][i].values.take(pa.array(rows)), "score": pa.array([int(s) for s in score], pa.int64()),
                                 "ids": ids.take(pa.array(found))}))
        return pa.concat_tables(out)

    return asks.groupBy("block", "slice").cogroup(copies.groupBy("at", "of")).applyInArrow(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first k of each query: by score, then by least id."""
    order = Window.partitionBy("cid").orderBy(F.desc("score"), F.col("ids")[0])
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


def search(df: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where `queries` (a condition
    on vec_id) holds, the k other rows of highest integer inner product."""
    spark = df.sparkSession
    small_batches(spark)
    known, owners = classes(df, queries, k, id_col, vector_col, scale)
    n = known.count()
    pivots = _pivots(known, -(-n // BLOCK))
    schema = "query_id long, rank int, vec_id long, score long"
    if not pivots:
        return spark.createDataFrame([], schema)
    placed = _placed(known, pivots)
    totals = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()
    counts = {r["cell"]: r["n"] for r in totals}
    cells = sorted((r["cell"], -(-r["n"] // BLOCK), r["radius"]) for r in totals)
    trees = _trees(placed, counts)
    asking = placed.join(owners.select("cid").distinct(), "cid").select("cid", "v", "cell")
    of_cell = {r["cell"]: r["count"] for r in asking.groupBy("cell").count().collect()}
    if not of_cell:
        return spark.createDataFrame([], schema)
    groups = written(_dealt(asking, of_cell, GROUP, "grp").drop("cell"), "covertree-queries")
    slices = -(-sum(-(-c // GROUP) for c in of_cell.values()) // SLICE)
    best = None
    for turn, (low, high) in enumerate(zip((0, *ROUNDS), (*ROUNDS, len(cells)))):
        if low >= len(cells):
            break
        if best is None:
            state = groups.withColumn("worst", F.lit(None).cast("long"))
        else:
            kth = best.groupBy("cid").agg(F.count("*").alias("n"), F.min("score").alias("worst")).where(F.col("n") == k + 1)
            state = groups.join(kth.drop("n"), "cid", "left")
        # one more than k: a query's own class is among them
        asks = written(_asks(state, cells, pivots, slices, low, high), f"covertree-asks{turn}")
        found = _search(asks, trees, k + 1)
        best = written(_best(found if best is None else best.unionByName(found), k + 1), f"covertree-best{turn}")
    lists = best.groupBy("cid").agg(F.collect_list(F.struct((-F.col("score")).alias("below"), "ids")).alias("lists"))
    # (-score, vec_id, row) of all members, in order
    pairs = F.flatten(F.transform("lists", lambda c: F.transform(c["ids"], lambda i: F.struct(
        c["below"].alias("below"), i["vec_id"].alias("vec_id"), i["row"].alias("row")))))
    ranked = owners.withColumnRenamed("vec_id", "query_id").join(lists.select("cid", F.sort_array(pairs).alias("all")), "cid")
    others = F.slice(F.filter("all", lambda m: m["row"] != F.col("row")), 1, k)
    out = ranked.select("query_id", F.posexplode(others).alias("at", "m"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("m.vec_id").alias("vec_id"), (-F.col("m.below")).alias("score"))
