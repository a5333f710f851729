"""Phrase collocations from an FM-index per shard over word ids.

Index. Each task cuts the texts it reads into shards of one language and about
SHARD words, by itself. A shard numbers its words, separates pieces by 0, sorts
its suffixes by their first `most` words, and keeps the Burrows-Wheeler
transform. That order is deep enough: up to `most` words, the suffixes that
begin with a phrase are an interval, and the LF step (the place of a symbol
among its equals, in order) carries the interval of x to that of c x.

Enumeration is by extension of all intervals of a depth at once. Left: the LF
step from every row of the interval of x shows the words c before x and their
counts, as runs of rows. Right: the row that the step arrives at lies within
the interval of the phrase without its last word. So each phrase is met as the
left extension of one known interval and the right extension of another; only
phrases of which both are frequent are followed.

Rounds. Words and pairs of all shards are summed first, in lists of keys dealt
by ranges; each shard gets its frequent pairs back and extends those to `most`
words; the phrases' counts are summed across shards. A phrase of a frequent
count has frequent pairs only, so nothing is lost. Scores, covering by longer
phrases and ranks are joins and windows over the frequent phrases alone.

Scale: texts are read once and not shuffled; the index is (4 bytes a word,
compressed) shuffled once to meet its frequent pairs. A common phrase costs an
entry a shard. A group of keys holds about RANGE words' worth of lists. Ranking
keeps `top` rows a language and task before it shuffles. Words and pairs are
known by 63 bits of hash; longer phrases by the array of their words' keys.

Defined results: a null language is 'und'; null, empty and blank texts have no
words; repeated rows count as often as they occur; rows with a null id count;
languages without candidates give no row, an empty table none; ties as ranked
(score, count, phrase in byte order); extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelkpi.llm.common import BASE, SMALL, mixed, run_hashes, small_batches, written

LEAST, MOST, TOP, COVER = 30, 4, 2000, 80
SCALE = 2_000_000
#: Words of a shard, and of the texts whose lists meet in one group.
SHARD, RANGE = 1 << 20, 1 << 22

#: What a byte is: 0 of a word, 1 a space between words, 2 the end of a piece.
KIND = np.zeros(256, np.uint8)
KIND[[9, 32]] = 1
KIND[[10, 11, 12, 13, *b".,;:!?"]] = 2


def _numbered(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(ids, keys, words): the texts' words as numbers from 1 between zeros (0 also
    between pieces), and the key and spelling of each."""
    raw = SMALL[np.frombuffer(b"\n".join([b"", *parts, b""]), np.uint8)]
    kind = KIND[raw]
    solid = kind == 0
    edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    hashes = (mixed(run_hashes(raw, starts, ends)) >> np.uint64(1)).astype(np.int64)
    keys, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    breaks = np.concatenate([np.zeros(min(1, len(piece)), np.int64), np.cumsum(piece[1:] != piece[:-1])])
    ids = np.zeros(len(starts) + (int(breaks[-1]) if len(breaks) else 0) + 2, np.int32)
    ids[np.arange(len(starts)) + breaks + 1] = number + 1
    text = raw.tobytes()
    return ids, keys, [text[s:e].decode("utf-8") for s, e in zip(starts[first].tolist(), ends[first].tolist())]


def transform(ids: np.ndarray, depth: int) -> np.ndarray:
    """The symbols before the suffixes of ids (taken as a circle) in the order of
    their first `depth` symbols or more, equal ones in the order of the text."""
    rank, width = ids.astype(np.int64), 1
    while 2 * width < depth:
        rank = np.unique(rank * (rank.max() + 1) + np.roll(rank, -width), return_inverse=True)[1]
        width *= 2
    step = min(width, depth - width)
    order = np.argsort(rank * (rank.max() + 1) + np.roll(rank, -step), kind="stable") if step else np.argsort(rank, kind="stable")
    return ids[order - 1]


class Index:
    """An FM-index: symbols before each suffix, first symbols, and LF steps."""

    def __init__(self, bwt: np.ndarray):
        order = np.argsort(bwt, kind="stable")
        self.before, self.first = bwt, bwt[order]
        self.step = np.empty(len(bwt), np.int64)
        self.step[order] = np.arange(len(bwt))

    def extend(self, phrase: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """From the phrase (number, or -1) that each row begins with, all phrases one
        word longer whose first and last parts are such: the phrase of each row (or
        -1), and of each phrase its first part, its last part and its count."""
        rows = np.flatnonzero((phrase >= 0) & (self.before > 0))
        to = self.step[rows]
        fine = phrase[to] >= 0
        rows, to = rows[fine], to[fine]
        by = np.argsort(to)
        to, last = to[by], phrase[rows[by]]
        head = phrase[to]
        new = np.ones(len(to), bool)
        new[1:] = (head[1:] != head[:-1]) | (last[1:] != last[:-1])
        at = np.flatnonzero(new)
        longer = np.full(len(phrase), -1, np.int64)
        longer[to] = np.cumsum(new) - 1
        return longer, head[at], last[at], np.diff(np.append(at, len(to)))

    def words(self) -> np.ndarray:
        """The one-word phrase (its number less 1) of each row, -1 for a separator."""
        return self.first.astype(np.int64) - 1


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (mixed(a.view(np.uint64) * np.uint64(BASE) + b.view(np.uint64)) >> np.uint64(1)).astype(np.int64)


INDEX = "shard long, lang string, n long, bwt binary, keys binary, words array<string>"


def index(docs: DataFrame, most: int) -> DataFrame:
    """One row a shard: its language, number of words, transform and dictionary."""

    def run(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def row(lang):
            ids, keys, words = _numbered(held.pop(lang))
            size.pop(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([lang], pa.string()), pa.array([int((ids > 0).sum())]), pa.array([transform(ids, most).tobytes()]),
                 pa.array([keys.tobytes()]), pa.array([words], pa.list_(pa.string()))], [c.split()[0] for c in INDEX.split(", ")])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, text = lang.as_py(), (text.as_py() or "").encode("utf-8")
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 1
                # some six bytes to a word; a task holds a few shards' texts at a time
                while size.get(lang, 0) > 6 * SHARD or sum(size.values()) > 24 * SHARD:
                    yield row(max(size, key=size.get))
                    shard += 1
        for lang in sorted(held):
            yield row(lang)
            shard += 1

    return docs.mapInArrow(run, INDEX)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


LISTS = "shard long, lang string, pairs boolean, part long, key array<long>, n array<int>"
SUMS = "shard long, lang string, pairs boolean, key array<long>, n array<long>"


def frequent(indexes: DataFrame, parts: dict[str, int], least: int) -> DataFrame:
    """Rows of SUMS: all frequent words and their counts (shard null), and for each
    shard those of its pairs that are frequent across shards."""

    def lists(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                shard, lang, bwt, keys = (batch.column(i)[at] for i in range(4))
                ranges = parts[lang.as_py()]
                own = Index(np.frombuffer(bwt.as_py(), np.int32))
                keys = np.frombuffer(keys.as_py(), np.int64)
                counts = np.bincount(own.first, minlength=len(keys) + 1)[1:]
                _, head, last, n = own.extend(own.words())
                for pairs, key, count in ((False, keys, counts), (True, pair_keys(keys[head], keys[last]), n)):
                    order = np.argsort(key)
                    key, count = key[order], count[order]
                    part = ((key >> 43) * ranges) >> 20
                    cut = np.searchsorted(part, np.arange(ranges + 1))
                    some = np.flatnonzero(np.diff(cut))
                    if not len(some):
                        continue
                    bounds = np.append(cut[some], len(key))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard.as_py()] * len(some), pa.int64()), pa.array([lang.as_py()] * len(some), pa.string()),
                         pa.array([pairs] * len(some)), pa.array(some), _lists(key, bounds), _lists(count.astype(np.int32), bounds)],
                        [c.split()[0] for c in LISTS.split(", ")])

    def add(group: pa.Table) -> pa.Table:
        lang, pairs = group["lang"][0].as_py(), group["pairs"][0].as_py()
        key, n = (group[c].combine_chunks().flatten().to_numpy() for c in ("key", "n"))
        keys, number = np.unique(key, return_inverse=True)
        total = np.bincount(number, n).astype(np.int64)
        often = total >= least
        if not pairs:
            return pa.table({"shard": pa.nulls(1, pa.int64()), "lang": [lang], "pairs": [False],
                             "key": pa.array([keys[often]], pa.list_(pa.int64())), "n": pa.array([total[often]], pa.list_(pa.int64()))})
        cut = np.cumsum([0, *[len(x) for x in group["key"]]])
        keep = often[number]
        cut = np.concatenate([[0], np.cumsum(keep)])[cut]
        rows = group.num_rows
        return pa.table({"shard": group["shard"], "lang": [lang] * rows, "pairs": [True] * rows,
                         "key": _lists(key[keep], cut), "n": pa.nulls(rows, pa.list_(pa.int64()))})

    rows = indexes.select("shard", "lang", "bwt", "keys").mapInArrow(lists, LISTS)
    return rows.groupBy("lang", "pairs", "part").applyInArrow(add, SUMS)


FOUND = "lang string, size int, part long, words array<long>, n array<long>, spelled array<string>"
PHRASES = "lang string, words array<long>, f long, spelled string"


def phrases(indexes: DataFrame, pairs: DataFrame, parts: dict[str, int], most: int, least: int) -> DataFrame:
    """Rows of PHRASES: the phrases of 2 to `most` words that are frequent across
    shards with their counts, and (f null) the words of frequent pairs spelled."""

    def extend(own: pa.Table, known: pa.Table) -> pa.Table:
        out = []

        def add(lang: str, words: np.ndarray, n: np.ndarray, spelled: pa.Array) -> None:
            """One list for each range of the phrases' hashes."""
            size, hashed = words.shape[1], words[:, 0]
            for i in range(1, size):
                hashed = pair_keys(np.ascontiguousarray(hashed), np.ascontiguousarray(words[:, i]))
            part = ((hashed >> 43) * parts[lang]) >> 20
            by = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[by], np.arange(parts[lang] + 1))
            some = np.flatnonzero(np.diff(cut))
            bounds = np.append(cut[some], len(by))
            spelled = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), spelled.take(pa.array(by))) if size == 1 else pa.nulls(len(some), pa.list_(pa.string()))
            out.append(pa.table({"lang": pa.array([lang] * len(some), pa.string()), "size": pa.array(np.full(len(some), size, np.int32)), "part": some,
                                 "words": _lists(words[by].ravel(), bounds * size), "n": _lists(n[by].astype(np.int64), bounds), "spelled": spelled}))

        often = np.sort(known["key"].combine_chunks().flatten().to_numpy()) if known.num_rows else np.zeros(0, np.int64)
        for at in range(own.num_rows if len(often) else 0):
            lang, here = own["lang"][at].as_py(), Index(np.frombuffer(own["bwt"][at].as_py(), np.int32))
            keys = np.frombuffer(own["keys"][at].as_py(), np.int64)
            rows, head, last, n = here.extend(here.words())
            key = pair_keys(keys[head], keys[last])
            fine = often[np.minimum(np.searchsorted(often, key), len(often) - 1)] == key
            number = np.where(fine, np.cumsum(fine) - 1, -1)
            rows = np.where(rows >= 0, number[rows], -1) if len(number) else rows
            words, n = np.stack([head, last], axis=1)[fine], n[fine]
            used = np.unique(words)
            add(lang, keys[used][:, None], np.zeros(len(used)), own["words"][at].values.take(pa.array(used)))
            while len(words):
                add(lang, keys[words], n, None)
                if words.shape[1] == most:
                    break
                rows, head, last, n = here.extend(rows)
                words = np.concatenate([words[head], words[last][:, -1:]], axis=1)
        names = [c.split()[0] for c in FOUND.split(", ")]
        types = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
        return pa.concat_tables(out) if out else pa.schema(list(zip(names, types))).empty_table()

    def add_up(group: pa.Table) -> pa.Table:
        lang, size = group["lang"][0].as_py(), group["size"][0].as_py()
        words = group["words"].combine_chunks().flatten().to_numpy().reshape(-1, size)
        n = group["n"].combine_chunks().flatten().to_numpy()
        by = np.lexsort(words.T)
        words = words[by]
        new = np.flatnonzero(np.concatenate([np.ones(min(1, len(words)), bool), (words[1:] != words[:-1]).any(axis=1)]))
        total = np.add.reduceat(n[by], new) if len(new) else n[:0]
        if size == 1:
            spelled = group["spelled"].combine_chunks().flatten().take(pa.array(by[new]))
            return pa.table({"lang": pa.array([lang] * len(new), pa.string()), "words": _lists(words[new].ravel(), np.arange(len(new) + 1)),
                             "f": pa.nulls(len(new), pa.int64()), "spelled": spelled})
        new, total = new[total >= least], total[total >= least]
        return pa.table({"lang": pa.array([lang] * len(new), pa.string()), "words": _lists(words[new].ravel(), np.arange(len(new) + 1) * size),
                         "f": total, "spelled": pa.nulls(len(new), pa.string())})

    lists = indexes.groupBy("shard").cogroup(pairs.groupBy("shard")).applyInArrow(extend, FOUND)
    return lists.groupBy("lang", "size", "part").applyInArrow(add_up, PHRASES)


def collocations(df: DataFrame, least: int = LEAST, most: int = MOST, top: int = TOP, cover: int = COVER,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of 2 to
    `most` words that occur `least` times, by the score of their weakest cut,
    floor(SCALE * a / (l + r)), without those that a longer one covers: one that
    holds them and occurs in `cover` percent of the cases."""
    if most < 2 or least < 1:
        raise ValueError("phrases have two words or more and occur once or more")
    small_batches(df.sparkSession)
    docs = df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))
    indexes = written(index(docs, most), "collocations-index")
    totals = written(indexes.groupBy("lang").agg(F.sum("n").alias("n")), "collocations-totals")
    # one number a language: how finely its keys are dealt
    parts = {r["lang"]: 1 + r["n"] // RANGE for r in totals.collect()}
    sums = written(frequent(indexes, parts, least), "collocations-frequent")
    found = written(phrases(indexes, sums.where("pairs").select("shard", "key"), parts, most, least), "collocations-phrases")
    candidates = found.where("f is not null").select("lang", "words", "f")

    words = sums.where("not pairs").select("lang", F.explode(F.arrays_zip("key", "n")).alias("x")).select(
        "lang", F.array("x.key").alias("words"), F.col("x.n").alias("f"))
    known = candidates.where(F.size("words") < most).unionByName(words) if most > 2 else words
    cuts = candidates.select("lang", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("words", 1, F.col("k"))).withColumn(
        "right", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("words").alias(side), F.col("f").alias(name)), ["lang", side])
    # products may pass 64 bits
    score = F.expr(f"cast(cast({SCALE} as decimal(18,0)) * cast(a as decimal(20,0)) div cast(l + r as decimal(20,0)) as long)")
    scored = cuts.withColumn("score", score).groupBy("lang", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = candidates.where(F.size("words") > 2).select(
        "lang", "f", F.col("words").alias("whole"), F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("size"))
    inner = inner.select("lang", "f", "whole", "size", F.explode(F.sequence(F.lit(1), F.size("whole") - F.col("size") + 1)).alias("from"))
    longest = inner.select("lang", "f", F.slice("whole", F.col("from"), F.col("size")).alias("words")).groupBy("lang", "words").agg(F.max("f").alias("longer"))
    hundred = F.lit(100).cast("decimal(18,0)")
    covered = F.coalesce(hundred * F.col("longer").cast("decimal(20,0)") >= F.lit(cover).cast("decimal(18,0)") * F.col("a").cast("decimal(20,0)"), F.lit(False))
    kept = scored.join(longest, ["lang", "words"], "left").where(~covered).select("lang", "words", "a", "cut")

    # rows that cannot be among the first are left out before they are spelled
    near = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a")))
    kept = kept.withColumn("_near", near).where(F.col("_near") <= top).drop("_near")
    spelled = found.where("f is null").select("lang", F.col("words")[0].alias("key"), "spelled")
    placed = kept.select("lang", "words", "a", "cut", F.posexplode("words").alias("at", "key")).join(spelled, ["lang", "key"])
    named = placed.groupBy("lang", "words", "a", "cut").agg(F.array_sort(F.collect_list(F.struct("at", "spelled"))).alias("parts"))
    named = named.withColumn("phrase", F.array_join(F.transform("parts", lambda p: p["spelled"]), " "))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    first = named.withColumn("rank", rank).where(F.col("rank") <= top).join(totals, "lang")
    return first.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
