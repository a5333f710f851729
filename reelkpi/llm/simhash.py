"""SimHash near-duplicates by deletion-variant signatures.

Every text has a 64-bit fingerprint: the majority, bit by bit, over the XXH64
of its word shingles. Two fingerprints within `distance` bits are linked, and
linked fingerprints form components.

Search: the 64 bits are cut into ceil((distance + 1) / 2) segments, so few that
of two linked fingerprints one segment differs by at most one bit. Every
fingerprint is indexed under each of its segments with one bit left out (a
wildcard in each place in turn); equal variants meet in an equality join and
are verified on all 64 bits.

Scale: rows with one fingerprint are one node (a group of copies of any size
costs one row after the partial aggregate). Variants go to tasks by a hash of
their value, many to a group. Within one variant's bucket the links are found
without listing all pairs: a node that is reached takes its linked nodes out of
the bucket (breadth-first), so a bucket gives a spanning forest of its links,
at most one edge a node, and a dense bucket costs about as many comparisons as
it has nodes. A variant that holds more than `big` nodes is dealt out again by
parts of the other bits, one of which must be equal in two linked nodes, so no
link is lost. Components come from joins (see `components`).

Defined results: a null, empty or blank text has fingerprint zero, linked like
any other; a text of fewer words than a shingle is one shingle; repeated rows
have one component; a null id takes part and is never the smallest unless all
ids of a component are null, whose id is then null; an empty table gives no
row; extra columns are left out.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkpi.llm.common import keyed_texts, text_slices, written
from reelkpi.llm.components import components

SHINGLE, DISTANCE = 3, 3
#: Nodes of one variant that one task compares; more are dealt out again.
BIG = 1 << 17
#: Times that big buckets are dealt out again.
RETAKES = 3
#: Index rows (64 a node) of a group of buckets.
GROUP_ROWS = 200_000


def fingerprint(text: str, words: int = SHINGLE) -> int:
    """The 64 bits of one text, as a signed integer."""
    import xxhash

    w = text.encode("utf-8").lower().split()  # bytes: only A-Z, and white space 9-13 and 32
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))]
    h = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64, len(shingles))
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 15):
        part = h[at:at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(total * 2 > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(df: DataFrame, words: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, bits): the fingerprint of every row."""

    def run(batches):
        for batch in batches:
            for first, texts in text_slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)),
                     pa.array([fingerprint(t, words) for t in texts], pa.int64())], ["doc_id", "bits"])

    return keyed_texts(df, id_col, text_col).mapInArrow(run, "doc_id long, bits long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of segments of which one differs by at most one bit."""
    n = distance // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return list(zip(cuts[:-1], [b - a for a, b in zip(cuts[:-1], cuts[1:])]))


def variants(nodes: DataFrame, distance: int) -> DataFrame:
    """(place, value, bits): each node under its segments with one bit left out.

    `place` numbers the bit that is left out; `value` is the rest of the segment."""
    keys = []
    for first, size in segments(distance):
        mask = ((1 << size) - 1) << first
        for bit in range(first, first + size):
            keep = mask & ~(1 << bit)
            signed = keep - (1 << 64) if keep >> 63 else keep
            keys.append(F.struct(F.lit(bit).alias("place"), F.col("bits").bitwiseAND(F.lit(signed)).alias("value")))
    return nodes.select(F.explode(F.array(*keys)).alias("k"), "bits").select("k.place", "k.value", "bits")


def _linked(bits: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among one bucket's distinct nodes."""
    left, u, v = np.unique(bits), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= distance
            if near.any():
                found = left[near]
                u.append(np.full(len(found), x)), v.append(found)
                queue.extend(found)
                left = left[~near]
    empty = bits[:0]
    return np.concatenate([empty, *u]), np.concatenate([empty, *v])


def bucket_links(place: np.ndarray, value: np.ndarray, bits: np.ndarray, distance: int) -> tuple:
    """Links within the buckets (equal place and value) of one task's rows."""
    order = np.lexsort((bits, value, place))
    place, value, bits = place[order], value[order], bits[order]
    new = np.concatenate([[True], (np.diff(place) != 0) | (np.diff(value) != 0)]) if len(bits) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(bits)))
    us, vs = [], []
    small = sizes[np.cumsum(new) - 1] <= 8 if len(bits) else new  # rows of small buckets: neighbours by shifts
    bucket = np.cumsum(new)
    for shift in range(1, 8):
        if len(bits) <= shift:
            break
        at = np.flatnonzero(small[:-shift] & (bucket[:-shift] == bucket[shift:]))
        at = at[np.bitwise_count(bits[at] ^ bits[at + shift]) <= distance]
        us.append(bits[at]), vs.append(bits[at + shift])
    for s, n in zip(starts[sizes > 8], sizes[sizes > 8]):
        u, v = _linked(bits[s:s + n], distance)
        us.append(u), vs.append(v)
    if not us:
        return bits[:0], bits[:0]
    pairs = np.unique(np.stack([np.concatenate(us), np.concatenate(vs)], axis=1), axis=0)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _parts(used: int, distance: int) -> list[int]:
    """Masks of distance + 1 parts of the bits that are not used: two linked nodes are equal in one."""
    free = [b for b in range(64) if not used >> b & 1]
    n = distance + 1
    return [sum(1 << b for b in free[len(free) * i // n:len(free) * (i + 1) // n]) for i in range(n)]


def buckets(nodes: DataFrame, distance: int = DISTANCE, big: int = BIG) -> DataFrame:
    """(place, value, bits): the nodes under their variants, those of big buckets
    under further parts of the bits that the bucket does not fix, until they are
    small or RETAKES times; two linked nodes meet in some bucket."""
    left, out, used = variants(nodes, distance), [], []
    for first, size in segments(distance):
        used.append(((1 << size) - 1) << first)
    fixed = F.lit(None).cast("long")
    for (first, _), mask in zip(segments(distance), used):
        fixed = F.when(F.col("place") >= first, F.lit(_signed(mask))).otherwise(fixed)
    left = left.withColumn("used", fixed)
    for turn in range(RETAKES):
        sizes = written(left.groupBy("place", "value").count().where(F.col("count") > big), f"simhash-big{turn}")
        if sizes.isEmpty():
            break
        out.append(left.join(sizes, ["place", "value"], "left_anti").select("place", "value", "bits"))
        cuts = {mask: _parts(mask, distance) for mask in used}
        table = F.create_map(*[x for mask, parts in cuts.items() for x in (
            F.lit(_signed(mask)), F.array(*[F.lit(_signed(p)) for p in parts]))])
        again = left.join(sizes.select("place", "value"), ["place", "value"]).withColumn("part", F.explode(table[F.col("used")]))
        left = written(again.select("place", F.xxhash64("value", "part", F.col("bits").bitwiseAND(F.col("part"))).alias("value"), "bits",
                                    F.col("used").bitwiseOR(F.col("part")).alias("used")), f"simhash-again{turn}")
        used = [mask | p for mask, parts in cuts.items() for p in parts]
    return reduce(DataFrame.unionByName, [*out, left.select("place", "value", "bits")])


def links(nodes: DataFrame, distance: int = DISTANCE, big: int = BIG) -> DataFrame:
    """(u, v): links whose components are those of all pairs within `distance` bits.

    nodes: distinct `bits`."""
    # a node becomes 64 index rows: deal out as many tasks as groups of them
    groups = max(1, -(-nodes.count() * 64 // GROUP_ROWS))
    dealt = buckets(nodes.repartition(groups, "bits"), distance, big).select(
        F.pmod(F.xxhash64("place", "value"), F.lit(groups)).alias("g"),  # many buckets to a group
        "place", "value", "bits")

    def run(group: pa.Table) -> pa.Table:
        place, value, bits = (group.column(c).to_numpy() for c in ("place", "value", "bits"))
        # unsigned: bitwise_count takes the absolute value of signed numbers
        u, v = bucket_links(place, value, bits.view(np.uint64), distance)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return dealt.groupBy("g").applyInArrow(run, "u long, v long").distinct()


def roots(rows: DataFrame, distance: int) -> DataFrame:
    """(bits, root): the component of every fingerprint of the written `rows`, named by one of its fingerprints."""
    nodes = written(rows.select("bits").distinct(), "simhash-nodes")
    found = components(links(nodes, distance))
    return nodes.join(found, nodes.bits == found.node, "left").select("bits", F.coalesce("root", "bits").alias("root"))


def near_duplicates(df: DataFrame, words: int = SHINGLE, distance: int = DISTANCE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, bits (the fingerprint, signed) and component_id (least doc_id reachable) of every row."""
    rows = written(fingerprints(df, words, id_col, text_col), "simhash-fingerprints")
    least = rows.groupBy("bits").agg(F.min("doc_id").alias("least"))
    placed = written(least.join(roots(rows, distance), "bits"), "simhash-placed")
    of_root = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_bits = placed.join(of_root, "root").select("bits", "component_id")
    return rows.join(of_bits, "bits").select("doc_id", "bits", "component_id")


def one_of_each(df: DataFrame, words: int = SHINGLE, distance: int = DISTANCE,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df, all columns, that stay when each component keeps one: the
    row of least id (null ids last), of equal ids the first in the input's order."""
    names = [f"_c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    text, key = names[df.columns.index(text_col)], names[df.columns.index(id_col)]
    at = names.index(text)

    def run(batches):
        from pyspark import TaskContext

        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, texts in text_slices(batch, names[at]):
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(first, n) for c in batch.columns], pa.array(np.full(n, part, np.int32)),
                     pa.array(np.arange(row, row + n)), pa.array([fingerprint(t, words) for t in texts], pa.int64())],
                    [*names, "part", "row", "bits"])
                row += n

    schema = ", ".join([*[f"{c} {t}" for c, t in plain.dtypes], "part int, row long, bits long"])
    rows = written(plain.mapInArrow(run, schema), "simhash-rows")
    first = F.min(F.struct(F.col(key).isNull(), F.col(key), "part", "row")).alias("first")
    # the first row of each fingerprint, then of each component: one row a fingerprint is joined
    of_bits = rows.groupBy("bits").agg(first)
    chosen = of_bits.join(roots(rows, distance), "bits").groupBy("root").agg(F.min("first").alias("first"))
    stay = chosen.select("first.part", "first.row")
    return rows.join(stay, ["part", "row"], "left_semi").select(*names).toDF(*df.columns)
