"""Suffix-array deduplication: every byte covered by a `size`-byte string that
starts anywhere else too is removed.

Collections. Documents are too long to be sorted column by column whole, so the
strings that can be equal are first brought together and lined up. In each
window of `size` bytes the `GRAM`-byte string of least hash (the leftmost such)
is its anchor; equal windows have equal anchors at equal offsets. All windows
of one anchor lie in one segment, text[a : b + size]. Anchors that occur once
are done. The segments of an anchor that occurs twice or more are a collection,
lined up at the anchor; equal segments enter once, with their number.

Column-wise construction, for many collections side by side in one task: from
the last column to the first, one symbol of every segment is inserted. The
segments' order by their suffixes from the next column, and the Burrows-Wheeler
symbols of that order, are known; a stable sort of these symbols within each
collection gives the order one column on, and the common prefix of neighbours
is one more than the least common prefix over the stretch between them (none
where a segment has ended). After a column, neighbours with a common prefix of
`size` or more mark the windows that start there as repeated, and so does a
segment's number above one. Only one column's order, symbols and prefixes are
held beside the segments, which come sequentially from the shuffle's files.

Scale: texts cross the network compressed, once to cut segments and once to be
cut themselves; anchors and places are narrow rows with partial counts. A task
holds about GROUP_SEGMENTS distinct segments. An anchor with more than HOT of
them is split without loss: a window has at least half of its other bytes on
one side of the anchor, so its segments meet again by the anchor with what
follows, and by the anchor with what comes before. Where that leaves more than
HOT together (a passage of many documents, near whose end the bytes on one side
are all equal), its windows are counted one by one, by partial sums.

Defined results: a null or empty text has no bytes and no spans; a text shorter
than `size` stays; equal rows (repeated or with other ids) remove all of each
other if they are `size` bytes or longer, as the contract's "anywhere else"
says; overlaps within a text count; null ids stay; an empty table gives no row;
extra columns are left out unless named in `keep`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkpi.llm.common import mixed, run_hashes, text_slices, written

SIZE, GRAM = 200, 64
HOT, GROUP_SEGMENTS = 50_000, 100_000
#: Windows that are searched for anchors at a time.
STRETCH = 1 << 20
#: A byte that no UTF-8 text holds: beyond a segment's end.
GONE = 0xFF


def anchors(raw: np.ndarray, size: int = SIZE, gram: int = GRAM, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first, last): the anchors of a text, and the first and last
    window start that each is the anchor of. Anchors of a stretch's edge may
    come twice, each with its part of the windows."""
    found, width = [], size - gram + 1  # grams in a window
    for begin in range(0, max(0, len(raw) - size + 1), stretch):
        part = raw[begin:begin + stretch + size - 1]
        h = mixed(run_hashes(part, slice(0, len(part) - gram + 1), slice(gram, len(part) + 1)))
        # places in the low bits: of equal hashes the leftmost is least
        ranked = (h & ~np.uint64((1 << 21) - 1)) | np.arange(len(h), dtype=np.uint64)
        rows = -(-len(ranked) // width)
        padded = np.full(rows * width, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:len(ranked)] = ranked
        padded = padded.reshape(rows, width)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = len(ranked) - width + 1
        least = np.minimum(behind[:windows], ahead[width - 1:width - 1 + windows])
        place = (least & np.uint64((1 << 21) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], windows) - 1
        found.append((h[place[first]].view(np.int64), place[first] + begin, first + begin, last + begin))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found))


def _packed(text: str) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(text.encode("utf-8"))


def _bytes(packed: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(packed)


def _at_most_twice(values: np.ndarray) -> np.ndarray:
    distinct, n = np.unique(values, return_counts=True)
    return np.concatenate([distinct, distinct[n > 1]])


def texts_with_anchors(df: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...], size: int) -> DataFrame:
    """Written rows (row, doc_id, kept columns, packed text, anchors): row numbers
    the input's rows, anchors are the hashes of the text's anchors, those that
    it holds more than once twice."""
    columns = [F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
               *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)]]
    read = df.select(*columns)
    types = dict(read.dtypes)
    kept = [f"_k{i}" for i in range(len(keep))]

    def run(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, texts in text_slices(batch):
                n = len(texts)
                each = [_at_most_twice(anchors(np.frombuffer(t.encode("utf-8"), np.uint8), size)[0]) for t in texts]
                offsets = np.concatenate([[0], np.cumsum([len(h) for h in each])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), batch.column(0).slice(first, n),
                     *[c.slice(first, n) for c in batch.columns[2:]], pa.array([_packed(t) for t in texts], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(each)))],
                    ["row", "doc_id", *kept, "packed", "anchors"])
                row += n

    schema = ", ".join(["row long, doc_id long", *[f"{k} {types[k]}" for k in kept], "packed binary, anchors array<long>"])
    return written(read.mapInArrow(run, schema), "suffixdedup-texts")


SEGMENTS = "row long, place long, lead int, windows int, hash long, segment binary, bytes binary"


def segments(texts: DataFrame, size: int) -> DataFrame:
    """Written rows, one for each segment of a repeated anchor: its text's row,
    the anchor's place, bytes before the anchor, number of windows, anchor hash,
    digest of the bytes, and the bytes where this task meets them first."""
    held = texts.select("row", F.explode("anchors").alias("hash"))
    repeated = held.groupBy("hash").count().where("count > 1").select("hash")
    wanted = held.join(repeated, "hash").groupBy("row").agg(F.collect_list("hash").alias("hashes"))
    rows = texts.select("row", "packed").join(wanted, "row")

    def run(batches):
        import xxhash

        seen = set()
        for batch in batches:
            for i in range(batch.num_rows):
                data = _bytes(batch.column(1)[i].as_py())
                hashes, place, first, last = anchors(np.frombuffer(data, np.uint8), size)
                at = np.flatnonzero(np.isin(hashes, batch.column(2)[i].values.to_numpy()))
                spans = [data[a:b + size] for a, b in zip(first[at].tolist(), last[at].tolist())]
                # the digest covers the bytes and where the anchor lies in them
                lead = place[at] - first[at]
                names = [xxhash.xxh3_128_digest(s, seed=k) for s, k in zip(spans, lead.tolist())]
                new = []
                for name, span in zip(names, spans):
                    new.append(None if name in seen else span)
                    seen.add(name)
                if len(seen) > 200_000:
                    seen.clear()
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column(0)[i].as_py(), np.int64)), pa.array(place[at]),
                     pa.array(lead.astype(np.int32)), pa.array((last[at] - first[at] + 1).astype(np.int32)),
                     pa.array(hashes[at]), pa.array(names, pa.binary()), pa.array(new, pa.binary())],
                    ["row", "place", "lead", "windows", "hash", "segment", "bytes"])

    return written(rows.mapInArrow(run, SEGMENTS), "suffixdedup-segments")


def sort_columns(collection: np.ndarray, columns: np.ndarray, size: int, starts: int) -> np.ndarray:
    """(segments, starts) True where the `size` bytes from a column on also start
    at that column in another segment of the collection.

    columns: one row per column, a byte per segment, GONE outside the segment;
    collection: ascending numbers, one per segment."""
    m = len(collection)
    repeated = np.zeros((starts, m), bool)
    order = np.arange(m)
    edge = np.concatenate([[True], collection[1:] != collection[:-1]]) if m else np.zeros(0, bool)
    base = collection.astype(np.int64) << 8
    prefix = np.zeros(m, np.int16)  # common prefix of the suffix at each place with the one before it
    for c in range(len(columns) - 1, -1, -1):
        symbol = columns[c][order]  # the Burrows-Wheeler symbols of the order so far
        step = np.argsort(base + symbol, kind="stable")  # places keep their collection, so base is in order
        symbol = symbol[step]
        same = np.zeros(m, bool)
        same[1:] = (symbol[1:] == symbol[:-1]) & ~edge[1:] & (symbol[1:] != GONE)
        fresh = np.zeros(m, np.int16)
        at = np.flatnonzero(same)
        if len(at):
            low, high = step[at - 1], step[at]
            near = high == low + 1
            fresh[at[near]] = prefix[high[near]]
            far = np.flatnonzero(~near)
            if len(far):  # the least prefix over the stretch between the two
                spans = np.stack([low[far] + 1, high[far] + 1], axis=1).ravel()
                ext = np.append(prefix, np.int16(0))
                fresh[at[far]] = np.minimum.reduceat(ext, spans)[::2]
            fresh[at] = np.minimum(fresh[at] + 1, size)
        order, prefix = order[step], fresh
        if c < starts:
            full = prefix >= size
            hit = full.copy()
            hit[:-1] |= full[1:]
            repeated[c, order[hit]] = True
    return repeated.T


def collections(distinct: DataFrame, gram: int, size: int, hot: int) -> tuple[DataFrame, DataFrame | None]:
    """(sorted, counted): the distinct segments with their `collection`. An anchor with
    more than `hot` segments is split by the bytes on one side of it; what is still
    above `hot` after that is counted window by window (None if there is none)."""
    sizes = distinct.groupBy("hash").count()
    other = (size - gram) // 2  # bytes that every window has before the anchor or after it
    big = written(sizes.where(F.col("count") > hot).select("hash"), "suffixdedup-hot")
    rows = distinct.withColumn("side", F.lit(0)).withColumn("collection", F.col("hash"))
    if big.isEmpty():
        return rows, None
    after = F.expr(f"substring(bytes, lead + {gram} + 1, {other})")
    before = F.expr(f"substring(bytes, lead - {other} + 1, {other})")
    split = rows.join(big, "hash").withColumn("to", F.explode(F.array(
        F.when(F.octet_length(after) == other, F.struct(F.lit(1).alias("side"), F.xxhash64("hash", F.lit("after"), after).alias("collection"))),
        F.when(F.col("lead") >= other, F.struct(F.lit(-1).alias("side"), F.xxhash64("hash", F.lit("before"), before).alias("collection"))))))
    split = split.where("to is not null").withColumn("side", F.col("to.side")).withColumn("collection", F.col("to.collection")).select(rows.columns)
    still = written(split.groupBy("collection").count().where(F.col("count") > hot).select("collection"), "suffixdedup-still-hot")
    fine = rows.join(big, "hash", "left_anti").select(rows.columns).unionByName(split.join(still, "collection", "left_anti").select(rows.columns))
    return fine, split.join(still, "collection").select(rows.columns)


#: Parts in which the places of one window meet its count.
WINDOW_PARTS = 16


def counted_windows(rows: DataFrame, size: int, gram: int) -> DataFrame:
    """(segment, mask) of the collections that are too big to be sorted in one task:
    a window of one side, named by a digest of its bytes, is repeated if its
    collection's segments hold it twice or more. Counts are summed partially."""
    starts, other = size - gram + 1, (size - gram) // 2

    def run(batches):
        import xxhash

        for batch in batches:
            column = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
            for i in range(batch.num_rows):
                lead, windows, side = (column[c][i].as_py() for c in ("lead", "windows", "side"))
                data, last = column["bytes"][i].as_py(), min(windows - 1, lead)
                own = range(0, min(last, lead - other) + 1) if side < 0 else range(max(0, lead - other), last + 1)
                m = len(own)
                repeat = lambda c: pa.array([column[c][i].as_py()] * m, column[c].type)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [repeat("collection"), repeat("segment"), repeat("n"),
                     pa.array([xxhash.xxh3_128_digest(data[s:s + size], seed=lead - s) for s in own], pa.binary()),
                     pa.array([starts - 1 - lead + s for s in own], pa.int32())], ["collection", "segment", "n", "window", "at"])

    each = rows.select("collection", "segment", "n", "bytes", "lead", "windows", "side").mapInArrow(
        run, "collection long, segment binary, n long, window binary, at int")
    twice = each.groupBy("collection", "window").agg(F.sum("n").alias("n")).where("n > 1").select(
        F.col("collection").alias("of"), F.col("window").alias("w"), F.explode(F.array(*map(F.lit, range(WINDOW_PARTS)))).alias("part"))
    part = F.pmod(F.xxhash64("segment"), F.lit(WINDOW_PARTS)).cast("int")
    hits = each.join(twice, (F.col("collection") == F.col("of")) & (F.col("window") == F.col("w")) & (part == F.col("part")))
    marked = hits.groupBy("segment").agg(F.collect_set("at").alias("at"))  # at most one for each start

    def pack(batches):
        for batch in batches:
            masks = np.zeros((batch.num_rows, starts), bool)
            for i, at in enumerate(batch.column(1)):
                masks[i, at.values.to_numpy()] = True
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in np.packbits(masks, axis=1)], pa.binary())],
                                             ["segment", "mask"])

    return marked.mapInArrow(pack, "segment binary, mask binary")


def repeated_windows(found: DataFrame, size: int, gram: int = GRAM, hot: int = HOT,
                     group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """(segment, mask): which windows of a distinct segment start somewhere else
    too, a bit for each; a segment may have several masks, whose union counts."""
    distinct = written(found.groupBy("segment").agg(
        F.count("*").alias("n"), F.any_value("bytes", F.lit(True)).alias("bytes"), F.any_value("hash").alias("hash"),
        F.any_value("lead").alias("lead"), F.any_value("windows").alias("windows")), "suffixdedup-distinct")
    both, counted = collections(distinct, gram, size, hot)
    groups = max(1, -(-distinct.count() // group_segments))
    group = F.pmod(F.xxhash64("collection"), F.lit(groups))
    starts = size - gram + 1  # columns at which a window can start; the anchor stands at the last

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("collection")
        lead, n = rows["lead"].to_numpy(), rows["n"].to_numpy()
        windows, data = rows["windows"].to_numpy(), rows["bytes"].combine_chunks()
        m = rows.num_rows
        _, collection = np.unique(rows["collection"].to_numpy(), return_inverse=True)
        width = starts - 1 + size
        offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + m + 1].astype(np.int64)
        lengths = np.diff(offsets)
        flat = np.frombuffer(data.buffers()[2], np.uint8) if m and lengths.sum() else np.zeros(0, np.uint8)
        columns = np.full((width, m), GONE, np.uint8)
        for begin in range(0, m, 4096):  # lay the segments down a few thousand at a time
            s = slice(begin, min(m, begin + 4096))
            which = np.repeat(np.arange(s.start, s.stop), lengths[s])
            inside = np.arange(len(which)) - np.repeat(offsets[s] - offsets[s.start], lengths[s])
            columns[inside + (starts - 1 - lead[which]), which] = flat[offsets[s.start]:offsets[s.stop]]
        hit = sort_columns(collection, columns, size, starts)
        own = (np.arange(starts) >= (starts - 1 - lead)[:, None]) & (
            np.arange(starts) < (starts - 1 - lead + windows)[:, None])
        hit = own & (hit | (n > 1)[:, None])
        some = np.flatnonzero(hit.any(axis=1))
        masks = [x.tobytes() for x in np.packbits(hit[some], axis=1)]
        return pa.table({"segment": rows["segment"].take(pa.array(some)), "mask": pa.array(masks, pa.binary())})

    masks = (both.select(group.alias("g"), "collection", "segment", "n", "bytes", "lead", "windows")
             .groupBy("g").applyInArrow(run, "segment binary, mask binary"))
    return masks if counted is None else masks.unionByName(counted_windows(counted, size, gram))


def _cut(df: DataFrame, size: int, id_col: str, text_col: str, keep: tuple[str, ...], hot: int,
         group_segments: int, as_text: bool = False) -> DataFrame:
    """Rows (doc_id, carried columns _k0 ..., n_bytes, spans, kept). With
    `as_text` kept is text; characters of which a part was removed go."""
    if size < 2 * GRAM:
        raise ValueError(f"size must be at least {2 * GRAM} bytes")
    texts = texts_with_anchors(df, id_col, text_col, keep, size)
    found = segments(texts, size)
    masks = repeated_windows(found.select("segment", "bytes", "hash", "lead", "windows"), size, GRAM, hot, group_segments)
    starts = size - GRAM + 1
    marked = (found.select("row", "place", "segment").join(masks, "segment")
              .groupBy("row").agg(F.collect_list(F.struct("place", "mask")).alias("marks")))
    kept = [f"_k{i}" for i in range(len(keep))]
    columns = ["doc_id", *kept, "packed", "marks"]
    rows = texts.drop("anchors").join(marked, "row", "left").select(*columns)
    types = dict(rows.dtypes)

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                n_bytes, spans, left = [], [], []
                packed, marks = part.column(len(columns) - 2), part.column(len(columns) - 1)
                for i in range(part.num_rows):
                    data = _bytes(packed[i].as_py())
                    n_bytes.append(len(data))
                    if not marks[i].is_valid or not len(marks[i]):
                        spans.append([]), left.append(data)
                        continue
                    own = marks[i].values
                    place = own.field("place").to_numpy()
                    mask = np.frombuffer(b"".join(own.field("mask").to_pylist()), np.uint8).reshape(len(place), -1)
                    which, column = np.nonzero(np.unpackbits(mask, axis=1)[:, :starts])
                    first = place[which] - (starts - 1) + column
                    cover = np.zeros(len(data) + 1, np.int64)
                    np.add.at(cover, first, 1), np.add.at(cover, first + size, -1)
                    gone = np.cumsum(cover[:-1]) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
                    left.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:1 + len(kept)], pa.array(n_bytes, pa.int64()), pa.array(spans, kind),
                     pa.array([x.decode("utf-8", "ignore") for x in left]) if as_text else pa.array(left, pa.binary())],
                    ["doc_id", *kept, "n_bytes", "spans", "kept"])

    schema = ", ".join(["doc_id long", *[f"{k} {types[k]}" for k in kept],
                        "n_bytes long, spans array<struct<start: long, end: long>>, kept " + ("string" if as_text else "binary")])
    return rows.mapInArrow(run, schema)


def deduplicate(df: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text",
                keep: tuple[str, ...] = (), hot: int = HOT, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """doc_id, n_bytes, spans (removed runs: start, end), kept (the bytes left)
    and the `keep` columns of every row."""
    rows = _cut(df, size, id_col, text_col, keep, hot, group_segments)
    return rows.select("doc_id", "n_bytes", "spans", "kept", *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)])


def left_over(df: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df, all columns, with what is left of their texts."""
    others = tuple(c for c in df.columns if c not in (id_col, text_col))
    rows = _cut(df, size, id_col, text_col, others, HOT, GROUP_SEGMENTS, as_text=True)
    place = {c: f"_k{i}" for i, c in enumerate(others)} | {id_col: "doc_id", text_col: "kept"}
    return rows.select(*[F.col(place[c]).alias(c) for c in df.columns])
