"""Language-model scores by a probabilistic suffix tree over words.

Symbols are words (A-Z lower-cased) and an end of text, which is also the
context of a text's first word. A state is a context of up to `depth` words;
its next-symbol distribution holds the symbols that follow it often enough.

Growing the tree: the strings of two words and more are counted exactly in the
training texts, and those that occur LEAST_COUNT times are kept, whatever their
share of the corpus. A context becomes a state only if the next symbols diverge
from those of its suffix state: N(s) * KL must exceed half the 95 % quantile of
chi-square with as many degrees as it has symbols. What the tree does not keep
of a context counts as one symbol more.

Smoothing: P(w | s) = max(n(s w) - DISCOUNT, 0) / n(s) + rest(s) P(w | suffix
state), down to the root, (c + 1) / (N + V + 1); each distribution sums to 1
over the V known symbols and one unknown. A text's score is the sum of log10
P(w | longest state that ends before w) over its words and its end.

Scoring: that sum is one over the strings that occur in the text. A string s w
adds log P(w | s) - log rest(s) - log P(w | suffix of s), a state adds log
rest(s); strings that add nothing are not kept. Up to the longest string that
the tree holds the terms cancel but for its own log P; beyond it only the rests
of longer states are left.

Scale: nothing of the tree is sent to all tasks or to the driver; it grows with
the corpus. The texts are cut into words once: a task takes BLOCK words at a time, and
each block is kept as numbers of words by frequency in the training texts, with the
order of its strings read from the last pair back, so that no later pass cuts, looks up or sorts again.
Words that occur once share a number, as no string with them is kept. Words
and pairs, with their states, are tables joined by shuffle. For longer contexts
positions cross the network, not strings: a block deals its positions by ranges
of the hash of the two words before, so that all longer contexts that end in
that pair meet in one group with whatever follows them, like a branch of a
suffix tree; there they are counted, tested and scored at once, and no string or
state is kept or sent. What such a group needs from outside is P(w | the word
before) of the pairs in which its kept strings end; it asks for them in a pass
of its own. To a range a block is a small trie, read from the last word back:
pairs, the words before each, the words before those, and how often (also of the
training texts) and in which texts each branch ends there, compressed. A pair or
passage that a block repeats is there once. What comes back of scores is one sum
a range and text of a block. The ranges grow with the bytes of text; those of
pairs' scores and of longer contexts are gone through in rounds, each a pass
over the blocks, and tables of which nothing is needed any more are deleted, so
that the disk holds a part at a time. A round has the strings of a
share of the words before the last, whose places a block keeps apart, so that a pass
sorts, hashes and ships no others. A text of any length is cut into blocks.

Defined results: a null, empty or blank text is its end alone; a row whose id
is null teaches nothing and is not held out; repeated rows count as often as
they occur and each gets its row; without training rows N = V = 0 and every
token has probability 1; an empty table gives no row; extra columns are left out.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelkpi.llm.common import BASE, dropped, keyed_texts, mixed, text_slices, word_keys, written

#: A string needs LEAST_COUNT occurrences, and no share of the corpus.
DEPTH, LEAST_SHARE, LEAST_COUNT, DISCOUNT = 3, 0.0, 2, 0.75
#: Words that a task holds before it passes them on.
BLOCK = 1 << 20
#: Bytes of text for each range of keys.
RANGE_BYTES = 8 << 20
#: Rounds in which the ranges of pairs' scores and of longer contexts are gone through.
ROUNDS = 2
#: Spreads numbers of words over the rounds; their product fits a long.
PART = 0x5F356495
#: Blocks to a file, and bytes that a task reads at a time: a block has some megabytes.
BLOCK_FILE, BATCH_BYTES = 8, 16 << 20
#: Numbers of an array that are worked on at once.
STEP = 1 << 13
#: Texts of a block at most: their numbers have 16 bits.
BLOCK_TEXTS = 1 << 15
#: The key of the end of a text; words and strings have keys of 63 hashed bits.
END = (1 << 63) - 1
#: The number of no word, and of words not in the training texts; that of all words that occur there once:
#: no string with one of them reaches LEAST_COUNT.
NONE, ONCE = 0, 1


def _sequences(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the texts one after the other, each between two ends (the first
    as context only), and the number of keys of each text."""
    words, counts = word_keys(texts)
    out = np.full(len(words) + 2 * len(texts), END, np.int64)
    out[np.arange(len(words)) + 2 * np.repeat(np.arange(len(texts)), counts) + 1] = words
    return out, counts + 2


def joined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The keys of strings, from those of their contexts and last words."""
    out = np.empty(len(word), np.uint64)
    for a in range(0, len(word), STEP):  # few at a time, so that nothing leaves the cache
        own = context[a:a + STEP].view(np.uint64) * np.uint64(BASE) + word[a:a + STEP].view(np.uint64)
        out[a:a + STEP] = mixed(own) >> np.uint64(1)
    return out.view(np.int64)


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> 43) * ranges) >> 20


def _range_column(key: str, ranges: int) -> Column:
    return F.shiftright(F.shiftright(key, 43) * F.lit(ranges).cast("long"), 20)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def _runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the end."""
    return np.append(np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]])), len(values))


def _batches_of_bytes(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches for this session; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key).rstrip("bB")
    if not (before.isdigit() and int(before) <= BATCH_BYTES):
        spark.conf.set(key, str(BATCH_BYTES))


def _kept(df: DataFrame, name: str, file_rows: int | None = None) -> DataFrame:
    """`written`, with the shuffle files of the query removed when it has ended."""
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if file_rows:
        settings["spark.sql.files.maxRecordsPerFile"] = str(file_rows)
    conf = df.sparkSession.conf
    before = {key: conf.get(key, None) for key in settings}
    for key, value in settings.items():
        conf.set(key, value)
    try:
        return written(df, name)
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


class Block:
    """Words of texts, and pieces of long ones, of up to BLOCK words: keys (those that
    are context only too), places in their texts, and the texts' numbers in the block."""

    def __init__(self):
        self.keys, self.place, self.token, self.row = [], [], [], []
        self.size = self.texts = 0

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(x) for x in (self.keys, self.place, self.token, self.row))


def blocks(batches, depth: int):
    """(block, heads) of a task's texts: heads (slice of rows, texts, first row of the
    slice, piece) in the order of the block's text numbers."""
    block, heads = Block(), []
    for batch in batches:
        for first, texts in text_slices(batch):
            keys, sizes = _sequences(texts)
            begin = np.cumsum(sizes) - sizes
            at = 0
            while at < len(texts):
                room = BLOCK - block.size
                # texts that fit whole, or a piece of one that no block takes whole
                fit = int(np.searchsorted(begin[at:] + sizes[at:] - begin[at], room, "right"))
                fit = min(fit, BLOCK_TEXTS - block.texts)
                if not fit and block.size:
                    yield block, heads
                    block, heads = Block(), []
                    continue
                if fit:
                    own = slice(int(begin[at]), int(begin[at + fit - 1] + sizes[at + fit - 1]))
                    pieces = [(own, np.arange(own.start, own.stop) - np.repeat(begin[at:at + fit], sizes[at:at + fit]),
                               np.repeat(np.arange(fit), sizes[at:at + fit]), fit, 0)]
                else:
                    end, fit = int(sizes[at]), 1
                    pieces = []
                    for piece, low in enumerate(range(0, end, BLOCK)):
                        start = max(0, low - depth)
                        own = slice(int(begin[at]) + start, int(begin[at]) + min(end, low + BLOCK))
                        place = np.arange(start, min(end, low + BLOCK))
                        pieces.append((own, np.where(place < low, -1 - place, place), np.zeros(len(place), np.int64), 1, piece))
                for k, (own, place, row, count, piece) in enumerate(pieces):
                    if k:
                        yield block, heads
                        block, heads = Block(), []
                    block.keys.append(keys[own])
                    # a place below 0 is context from before the piece
                    block.token.append(place > 0)
                    block.place.append(np.where(place < 0, -1 - place, place))
                    block.row.append((row + block.texts).astype(np.uint16))
                    heads.append((batch, texts[at:at + count], first + at, piece))
                    block.size += len(place)
                    block.texts += count
                at += fit
    if block.size:
        yield block, heads


def _bytes(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def _of_bytes(column: pa.ChunkedArray, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), dtype) for x in column]


def _planes(a: np.ndarray) -> list[np.ndarray]:
    """Small numbers (below 2^32) as planes of their bytes, lowest first, as many as the greatest needs."""
    width = max(1, -(-int(a.max(initial=0)).bit_length() // 8))
    return [(a >> 8 * k if k else a).astype(np.uint8) for k in range(width)]


def _joined_planes(parts: list[list[np.ndarray]]) -> bytes:
    """Arrays, each as its planes, compressed as one."""
    head = np.array([x for planes in parts for x in (len(planes[0]), len(planes))], np.uint32)
    raw = b"".join([head, *(p for planes in parts for p in planes)])
    return np.uint32(len(raw)).tobytes() + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays of small numbers (below 2^32), as planes of as many bytes as the greatest needs, compressed."""
    return _joined_planes([_planes(a) for a in arrays])


def unpacked(data: bytes, count: int, *dtypes) -> list[np.ndarray | None]:
    """The arrays of `packed`, of one type or each of its own, which holds their numbers; None leaves one out."""
    size = int(np.frombuffer(data[:4], np.uint32)[0])
    raw = np.frombuffer(pa.Codec("zstd").decompress(memoryview(data)[4:], size, asbytes=True), np.uint8)
    at, out = 8 * count, []
    for i, (n, width) in enumerate(raw[:at].view(np.uint32).reshape(-1, 2).tolist()):
        dtype = (dtypes or (np.int64,))[i if len(dtypes) > 1 else 0]
        if dtype:
            a = raw[at:at + n].astype(np.uint32 if width > 2 else np.uint16 if width > 1 else dtype)
            for k in range(1, width):
                a |= raw[at + k * n:at + (k + 1) * n].astype(a.dtype) << a.dtype.type(8 * k)
            out.append(a.astype(dtype, copy=False))
        else:
            out.append(None)
        at += n * width
    return out


def gathered(tries: pa.ChunkedArray, count: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The arrays of packed tries one after the other, and how long each trie's last is."""
    found = [unpacked(x.as_py(), count, np.uint32) for x in tries]
    out = [np.concatenate([f[k] for f in found]) for k in range(count)]
    return out, np.array([len(f[-1]) for f in found])


def _sorted_places(keys: np.ndarray) -> np.ndarray:
    """The order of keys from 0, equal ones as they come. Keys with their places in the low bits are sorted,
    which takes a fraction of argsort's time; where a key has too many bits, those that share the high ones
    are put in order after that."""
    keys = keys.astype(np.int64, copy=False)
    bits = len(keys).bit_length()
    low = int(keys.min(initial=END))
    shift = max(0, max(0, int(keys.max(initial=0)) - low).bit_length() + bits - 63)
    own = ((keys - low) >> shift) << bits
    own |= np.arange(len(keys))
    own.sort()
    order = own & ((1 << bits) - 1)
    if shift:
        found = keys[order]
        wrong = np.flatnonzero(found[1:] < found[:-1])
        if len(wrong):
            own >>= bits
            at = np.flatnonzero(np.isin(own, own[wrong]))
            order[at] = order[at][np.argsort(found[at], kind="stable")]
    return order


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys from 0, ascending, and the place of each key among them."""
    order = _sorted_places(keys)
    own = keys[order]
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    code = np.empty(len(own), np.int64)
    code[order] = np.cumsum(new) - 1
    return own[new], code


def _order(columns: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    """The order of rows by columns of numbers below sizes, several to a sort key where they
    fit beside a row's place; the last key is sorted by first."""
    keys, room, most = [], 1, 1 << 63 - len(columns[0]).bit_length()
    for c, n in zip(columns, sizes):
        if keys and room * n <= most:
            keys[-1] = keys[-1] * n + c
            room *= n
        else:
            keys.append(c)
            room = n
    order = _sorted_places(keys[-1])
    for key in keys[-2::-1]:
        order = order[_sorted_places(key[order])]
    return order


HEADS = "doc_id array<long>, piece array<int>, n_tokens array<long>, digest array<binary>"
CUT = f"block long, keys binary, n binary, data binary, taught binary, {HEADS}"
BLOCKS = f"block long, data binary, taught binary, {HEADS}, places array<binary>"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _heads(block: Block, heads: list) -> list[pa.Array]:
    """The block's texts: id, piece, number of tokens in it and digest of the whole text."""
    import xxhash

    _, _, token, row = block.arrays()
    ids = pa.concat_arrays([b.column(0).slice(first, len(texts)).cast(pa.int64()) for b, texts, first, _ in heads])
    pieces = np.concatenate([np.full(len(texts), piece, np.int32) for _, texts, _, piece in heads])
    digests = [xxhash.xxh3_128_digest(t.encode("utf-8")) for _, texts, _, _ in heads for t in texts]
    whole = np.array([0, len(ids)])
    return [pa.ListArray.from_arrays(pa.array(whole.astype(np.int32)), ids), _lists(pieces, whole),
            _lists(np.bincount(row[token], minlength=len(ids)).astype(np.int64), whole),
            pa.ListArray.from_arrays(pa.array(whole.astype(np.int32)), pa.array(digests, pa.binary()))]


def cut_texts(docs: DataFrame, depth: int) -> DataFrame:
    """The texts of docs (doc_id, text, learn) as rows of CUT, a block each: the keys of its words,
    ascending, and how often each occurs in its training texts; the words' places among
    the keys, places in their texts up to depth, whether they are tokens or context
    only, and the texts' numbers; which texts are training texts."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for block, heads in blocks(batches, depth):
            keys, place, token, row = block.arrays()
            known, code = _distinct(keys)
            taught = np.concatenate([b.column(2).slice(first, len(texts)).to_numpy(zero_copy_only=False)
                                     for b, texts, first, _ in heads]).astype(bool)
            n = np.bincount(code[token & taught[row]], minlength=len(known))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), _bytes([known]), _bytes([n.astype(np.uint32)]),
                 pa.array([packed([code, np.minimum(place, depth), token, row])], pa.binary()), _bytes([taught]),
                 *_heads(block, heads)], _names(CUT))
            number += 1

    return docs.select("doc_id", "text", "learn").mapInArrow(run, CUT)


def number_words(cut: DataFrame, ranges: int) -> DataFrame:
    """Rows (range, block, numbers, n, total, distinct): the words of a range of keys get
    numbers by frequency in the training texts. With a block, the numbers of its words
    in the range, by key; without, the numbers of all that occur more than once, how often they
    do, how often all words of the range do and how many there are."""

    def ask(batches):
        for batch in batches:
            for block, keys, n in zip(batch["block"].to_pylist(), _of_bytes(batch["keys"], np.int64), _of_bytes(batch["n"], np.uint32)):
                at = np.searchsorted(_range_of(keys, ranges), np.arange(ranges + 1))
                some = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(np.full(len(some), block)), _bytes([keys[at[r]:at[r + 1]] for r in some]),
                     _bytes([n[at[r]:at[r + 1]] for r in some])], ["range", "block", "keys", "n"])

    def number(group: pa.Table) -> pa.Table:
        asked = _of_bytes(group["keys"], np.int64)
        key, of = _distinct(np.concatenate(asked))
        n = np.bincount(of, np.concatenate(_of_bytes(group["n"], np.uint32)), len(key)).astype(np.int64)
        own = group["range"][0].as_py()
        by = np.argsort(-n, kind="stable")
        by = by[n[by] > 1]
        numbers = np.where(n > 0, ONCE, NONE)
        numbers[by] = 2 + own + np.arange(len(by)) * ranges
        cut = np.cumsum([0, *map(len, asked)])
        flat = numbers[of]
        told = [flat[a:b] for a, b in zip(cut[:-1], cut[1:])]
        rows = len(told)
        empty = np.zeros(0, np.int64)
        return pa.table({
            "range": pa.array(np.full(rows + 1, own)), "block": pa.array([*group["block"].to_pylist(), None], pa.int64()),
            "numbers": _bytes([*told, numbers[by]]), "n": _bytes([empty] * rows + [n[by]]),
            "total": np.append(np.zeros(rows, np.int64), n.sum()), "distinct": np.append(np.zeros(rows, np.int64), (n > 0).sum())})

    return (cut.select("block", "keys", "n").mapInArrow(ask, "range long, block long, keys binary, n binary")
            .groupBy("range").applyInArrow(number, "range long, block long, numbers binary, n binary, total long, distinct long"))


def words_of(numbered: DataFrame) -> DataFrame:
    """(word, n): the numbers of the words that occur in the training texts, those that occur once as one."""

    def run(batches):
        for batch in batches:
            for word, n in zip(_of_bytes(batch["numbers"], np.int64), _of_bytes(batch["n"], np.int64)):
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n)], ["word", "n"])

    many = numbered.where("block is null").select("numbers", "n").mapInArrow(run, "word long, n long")
    return many.unionByName(many.sparkSession.range(1).select(F.lit(ONCE).cast("long").alias("word"), F.lit(1).cast("long").alias("n")))


def _part(word, rounds: int):
    """The round of strings, of an array or column of the words before their last."""
    if isinstance(word, Column):
        return F.shiftright(word * F.lit(PART), 20) % rounds
    return (word * PART >> 20) % rounds


def numbered_texts(cut: DataFrame, numbered: DataFrame, depth: int) -> DataFrame:
    """Rows of BLOCKS: words by number, and for each round the places of the tokens whose word
    before occurs more than once and is of that round, in order: by that word, the token, the
    word before the two, and so on."""

    def run(told: pa.Table, own: pa.Table) -> pa.Table:
        told = told.sort_by("range")
        number = np.concatenate([*_of_bytes(told["numbers"], np.int64), np.zeros(0, np.int64)])
        code, place, token, row = unpacked(own["data"][0].as_py(), 4)
        word = number[code]
        # places among the block's numbers, by round, are smaller than the numbers; 0 for what no string has
        distinct, near = _distinct(number)
        part = _part(distinct, ROUNDS)
        by = np.argsort(part, kind="stable")
        nth = np.empty(len(distinct), np.int64)
        nth[by] = np.arange(1, len(distinct) + 1)
        nth[distinct <= ONCE] = 0
        near = nth[near][code]
        at = np.flatnonzero(token)
        at = at[near[at - 1] > 0]
        column = [near[at], near[at - 1]] + [np.where(place[at] >= j, near[np.maximum(at - j, 0)], 0) for j in range(2, depth + 1)]
        order = _order([column[1], column[0], *column[2:]], [len(distinct) + 1] * (depth + 1))
        at = at[order]
        ends = np.cumsum([0, *np.bincount(part, minlength=ROUNDS)]) + 1
        cut = np.searchsorted(column[1][order], ends)
        data = pa.array([packed([word, place, token, row])], pa.binary())
        places = pa.array([[packed([at[a:b]]) for a, b in zip(cut[:-1], cut[1:])]], pa.list_(pa.binary()))
        return own.drop_columns(["data"]).append_column("data", data).append_column("places", places).select(_names(BLOCKS))

    told = numbered.where("block is not null").select("block", "range", "numbers")
    own = cut.select("block", "data", "taught", *_names(HEADS))
    return told.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(run, BLOCKS)


def _slices(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of slices one after the other, and where each begins among them, with the end."""
    cut = np.concatenate([[0], np.cumsum(sizes)])
    return np.repeat(starts - cut[:-1], sizes) + np.arange(cut[-1]), cut


def tries(data: bytes, places: bytes, taught: np.ndarray, depth: int, ranges: int, score: bool = False):
    """(range, trie) of one round: the strings that end at a block's words,
    by last pair, then the word before, and so on, as numbers of words, 0 for none.
    Dealt by the last pair, or, beyond pairs, by the two words before the last (where
    there are two). Level by level: pairs as two arrays, then words and how many a
    parent has; how often each branch occurs; to score, also how often in taught
    texts (beyond pairs), and the texts in which it does. What cannot occur twice in the training
    texts, as one of its words does not, is left out; not to score, also all other texts."""
    word, place, _, row = unpacked(data, 4, np.int32, np.uint8, None, np.uint16)
    at = unpacked(places, 1, np.int32)[0]
    word[word <= ONCE] = NONE
    before = []
    for j in range(2, depth + 1):
        before.append(np.zeros_like(word))
        before[-1][j:] = word[:-j]
        before[-1][place < j] = NONE
    # which tokens take part is told by all of them first, in their order
    there = np.ones(len(word), bool) if depth > 1 and score else word > NONE
    if depth > 1:
        there &= before[0] > NONE
    if not score:
        there &= taught[row]
    at = at[there[at]]
    if not len(at):
        return
    column = [word[at], word[at - 1], *(b[at] for b in before)]
    rows = row[at]
    new = np.ones(len(at), bool)
    new[1:] = (column[1][1:] != column[1][:-1]) | (column[0][1:] != column[0][:-1])
    starts = [np.flatnonzero(new)]
    for c in column[2:]:
        new[1:] |= c[1:] != c[:-1]
        starts.append(np.flatnonzero(new))
    # the entries of one level are dealt, with what is below them
    deal = starts[1 if depth > 1 else 0]
    pair = [c[deal].astype(np.int64) for c in ((column[2], column[1]) if depth > 1 else (column[1], column[0]))]
    which = _range_of(joined(*pair), ranges)
    order = np.argsort(which.astype(np.uint16) if ranges <= 1 << 16 else which, kind="stable")
    which, first = which[order], deal[order]
    sizes = np.diff(np.append(deal, len(at)))[order]
    own, cut = _slices(first, sizes)
    bounds = _runs(which)  # of the ranges among the entries dealt
    last, before = column[0][first], column[1][first]
    if depth > 1:
        new = np.ones(len(first), bool)
        new[1:] = (last[1:] != last[:-1]) | (before[1:] != before[:-1])
        new[bounds[:-1]] = True
        pairs = np.flatnonzero(new)
        parts, cuts = [last[pairs], before[pairs]], [np.searchsorted(pairs, bounds)] * 2
        parts += [np.diff(np.append(pairs, len(first))), column[2][first]]
        cuts += [cuts[0], bounds]
    else:
        parts, cuts = [last, before], [bounds] * 2
    leaf = sizes
    for j in range(3, depth + 1):
        lower = starts[j - 1]
        upper = np.append(deal, len(at)) if j == 3 else np.append(starts[j - 2], len(at))
        held = np.searchsorted(lower, upper)
        if j == 3:
            chosen, down = _slices(held[:-1][order], np.diff(held)[order])
            ends = down[bounds]
            counts = np.diff(down)
        else:
            counts = np.diff(held)[chosen]
            chosen, down = _slices(held[:-1][chosen], counts)
            ends = down[ends]
        parts += [counts, column[j][lower[chosen]]]
        cuts += [cuts[-1], ends]
        leaf = np.diff(np.append(lower, len(at)))[chosen]
    parts.append(leaf)
    cuts.append(cuts[-1])
    rows = rows[own]
    if score and depth > 1:
        parts.append(np.add.reduceat(taught[rows].astype(np.int32), np.concatenate([[0], np.cumsum(leaf[:-1])])))
        cuts.append(cuts[-1])
    if score:
        parts.append(rows)
        cuts.append(cut[bounds])
    parts = [_planes(x) for x in parts]
    cuts = [c.tolist() for c in cuts]
    for i, r in enumerate(which[bounds[:-1]].tolist()):
        yield r, _joined_planes([[p[c[i]:c[i + 1]] for p in planes] for planes, c in zip(parts, cuts)])


def strings_of(parts: list[np.ndarray], depth: int) -> list[tuple]:
    """Of tries (as `gathered` gives them), for each length from 2: (strings, contexts) as keys, which of
    them there are, their parents' places in the level before, and which have a last word that occurs twice."""
    word, context = parts[0].astype(np.int64), parts[1].astype(np.int64)
    # of each entry of a level: its last word, its context's words (nearest first) and its key
    last, before = word, [context]
    levels = [(joined(context, word), context, np.ones(len(word), bool), None, word > ONCE)]
    for j in range(depth - 1):
        count, first = parts[2 + 2 * j], parts[3 + 2 * j].astype(np.int64)
        up = np.repeat(np.arange(len(count)), count)
        last = last[up]
        before = [b[up] for b in before] + [first]
        context = before[-1]
        for b in before[-2::-1]:
            context = joined(context, b)
        levels.append((joined(context, last), context, first > NONE, up, last > ONCE))
    return levels


def _alike(keys: np.ndarray, n: np.ndarray, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, runs, sums): the places of keys whose sum of n reaches LEAST_COUNT, of some entries, by key;
    where each key begins among them, and the end; the sums."""
    if some is None:
        at = _sorted_places(keys)
    else:
        at = np.flatnonzero(some)
        at = at[_sorted_places(keys[at])]
    bounds = _runs(keys[at])
    total = np.add.reduceat(n[at], bounds[:-1]) if len(at) else n[at]
    often, sizes = total >= LEAST_COUNT, np.diff(bounds)
    return at[np.repeat(often, sizes)], np.concatenate([[0], np.cumsum(sizes[often])]), total[often]


def _summed(keys: np.ndarray, n: np.ndarray, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, their sums of n, a place of each) of those whose sum reaches LEAST_COUNT, of some entries."""
    at, runs, total = _alike(keys, n, some)
    first = at[runs[:-1]]
    return keys[first], total, first


class Values:
    """Values by key (distinct, ascending), looked up by some bits of a key; keys that share them are searched."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        self.keys, self.values = keys, values
        self.mask = (1 << max(8, int(4 * len(keys)).bit_length())) - 1
        slot, nth = keys & self.mask, np.arange(len(keys), dtype=np.int32)
        self.table = np.full(self.mask + 1, -1, np.int32)
        self.table[slot] = nth
        self.others = np.flatnonzero(self.table[slot] != nth)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the wanted keys are there, and their places among the keys."""
        at = self.table[wanted & self.mask]
        some = np.flatnonzero(at >= 0)
        at = at[some]
        there = self.keys[at] == wanted[some]
        if len(self.others):
            rest = self.keys[self.others]
            more = np.flatnonzero(~there)
            own = wanted[some[more]]
            nth = np.minimum(np.searchsorted(rest, own), len(rest) - 1)
            hit = rest[nth] == own
            at[more[hit]] = self.others[nth[hit]]
            there[more[hit]] = True
        return some[there], at[there]

    def of(self, wanted: np.ndarray) -> list[np.ndarray]:
        """The values of the wanted keys, 0 where a key is not there."""
        some, at = self.find(wanted)
        out = [np.zeros(len(wanted)) for _ in self.values]
        for o, v in zip(out, self.values):
            o[some] = v[at]
        return out


def _trie_rows(found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r for r, _ in found], pa.int64()), pa.array([t for _, t in found], pa.binary())],
                                      ["range", "trie"])


def _round(texts: DataFrame, turn: int) -> DataFrame:
    """What a pass over the blocks reads of them, of one round."""
    return texts.select("block", "data", "taught", F.array(F.col("places")[turn]).alias("places"))


def _loaded(batches):
    """(block, data, places of each round, taught) of batches of rows of BLOCKS."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield (batch["block"][i].as_py(), batch["data"][i].as_py(), batch["places"][i].as_py(),
                   np.frombuffer(batch["taught"][i].as_py(), bool))


def count_pairs(texts: DataFrame, ranges: int) -> DataFrame:
    """Rows (key, context, suffix, n) of the pairs of words that occur LEAST_COUNT times in the training texts."""

    def run(batches):
        for _, data, places, taught in _loaded(batches):
            for own in places:
                yield _trie_rows(list(tries(data, own, taught, 1, ranges)))

    def add(group: pa.Table) -> pa.Table:
        (suffix, context, n), _ = gathered(group["trie"], 3)
        key, n, first = _summed(joined(context.astype(np.int64), suffix.astype(np.int64)), n.astype(np.int64))
        return pa.table({"key": key, "context": context[first].astype(np.int64), "suffix": suffix[first].astype(np.int64), "n": n})

    return (texts.select("block", "data", "taught", "places").mapInArrow(run, "range long, trie binary")
            .groupBy("range").applyInArrow(add, "key long, context long, suffix long, n long"))


def lower_of_pairs(texts: DataFrame, pairs: DataFrame, ranges: int, turn: int) -> DataFrame:
    """Rows (range, keys, p), of arrays: P(w | the word before) of the pairs in which
    strings of three words end that a range of contexts keeps, of one round;
    pairs: (key, part, p). A range asks the pairs' ranges by list."""

    def run(batches):
        for _, data, places, taught in _loaded(batches):
            yield _trie_rows(list(tries(data, places[0], taught, 2, ranges)))

    def want(group: pa.Table) -> pa.Table:
        parts, _ = gathered(group["trie"], 5)
        (pair, *_), (key, _, _, up, _) = strings_of(parts, 2)
        pair = np.unique(pair[up[_summed(key, parts[4])[2]]])
        bucket = _range_of(pair, ranges)  # ascending, like the keys
        cut = _runs(bucket)
        return pa.table({"bucket": bucket[cut[:-1]], "range": pa.array(np.full(len(cut) - 1, group["range"][0].as_py())),
                         "keys": _bytes([pair[a:b] for a, b in zip(cut[:-1], cut[1:])])})

    def tell(asked: pa.Table, known: pa.Table) -> pa.Table:
        order = _sorted_places(known["key"].to_numpy())
        key, p = known["key"].to_numpy()[order], known["p"].to_numpy()[order]
        return pa.table({"range": asked["range"], "keys": asked["keys"],
                         "p": _bytes([p[np.searchsorted(key, k)] for k in _of_bytes(asked["keys"], np.int64)])})

    asked = (_round(texts, turn).mapInArrow(run, "range long, trie binary")
             .groupBy("range").applyInArrow(want, "bucket long, range long, keys binary"))
    known = pairs.where(F.col("part") == turn).select(_range_column("key", ranges).alias("bucket"), "key", "p")
    return asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(tell, "range long, keys binary, p binary")


def _quantile_95(df):
    """95 % quantile of chi-square (Wilson and Hilferty), of an array or column of degrees above 0."""
    d = df * 1.0
    return d * (1 - 2 / (9 * d) + 1.6449 * (2 / (9 * d)) ** 0.5) ** 3


def grow(words: DataFrame, counted: DataFrame, n: int, v: int) -> tuple[DataFrame, DataFrame]:
    """(words, pairs), from the tables of words and of pairs, which are deleted: tables
    (key, base, score) and (key, part, p, score) of P(w | the word before), and of what a word
    (also as a state) and a pair add to a text's scores beyond the root probability of an unknown word."""
    log = F.log10(F.col("n") + 1)
    one = words.select(F.col("word").alias("key"), log.alias("base"), log.alias("score"))
    own = _kept(counted.join(words.select(F.col("word").alias("suffix"), ((F.col("n") + 1) / F.lit(float(n + v + 1))).alias("lower")), "suffix"),
                "suffixtree-lower-of-pairs")
    dropped(counted)
    contexts = own.groupBy("context").agg(
        F.count("*").alias("size"), F.sum("n").alias("kept"), F.sum("lower").alias("lower"),
        F.sum(F.col("n") * F.log(F.col("n") / F.col("lower"))).alias("gain")).join(
        words.select(F.col("word").alias("context"), F.col("n").alias("total")), "context")
    left = F.col("total") - F.col("kept")
    gain = F.col("gain") - F.col("kept") * F.log("total") + F.when(left > 0, left * F.log(
        left / F.col("total") / F.greatest(1 - F.col("lower"), F.lit(1e-12)))).otherwise(0.0)
    states = _kept(contexts.where(gain > _quantile_95(F.col("size")) / 2).select(
        "context", "total", (1 - (F.col("kept") - DISCOUNT * F.col("size")) / F.col("total")).alias("rest")), "suffixtree-states")
    weight = F.coalesce((F.col("n") - DISCOUNT) / F.col("total"), F.lit(0.0))
    p = weight + F.coalesce("rest", F.lit(1.0)) * F.col("lower")
    pairs = _kept(own.join(states, "context", "left").select(
        "key", _part(F.col("context"), ROUNDS).alias("part"), p.alias("p"), F.when(F.col("total").isNotNull(), F.log10(p) - F.log10("rest") - F.log10("lower")).alias("score")),
        "suffixtree-pair-values")
    one = _kept(one.unionByName(states.select(F.col("context").alias("key"), F.lit(0.0).alias("base"), F.log10("rest").alias("score"))),
                "suffixtree-word-values")
    dropped(words, own, states)
    return one, pairs


def branch(levels: list[tuple], taught: np.ndarray, depth: int, keys: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The tree's part in a range, grown from its tries (as `strings_of` gives them; taught: how often each
    branch occurs in training texts): what the states and strings that end in a branch, with contexts
    from 2 words, add to a score. keys, p: the pairs in which kept strings of three words end,
    ascending, and P(w | the word before)."""
    counts = [taught.astype(float)]
    for level, above in zip(levels[:1:-1], levels[-2::-1]):
        counts.append(np.bincount(level[3], counts[-1], len(above[0])))
    adds = np.zeros(len(levels[0][0]))
    own = None  # p of each entry of the level before, where its string is kept
    for (key, context, there, up, often), n in zip(levels[1:], counts[::-1]):
        at, runs, kept_n = _alike(key, n, there & often)
        sizes, first = np.diff(runs), at[runs[:-1]]
        lower = p[np.searchsorted(keys, levels[0][0][up[first]])] if own is None else own[up[first]]
        contexts, of = _distinct(context[first])
        some, nth = Values(contexts).find(context)
        total = np.bincount(nth, n[some], len(contexts))
        size, kept, below = (np.bincount(of, x, len(contexts)) for x in (None, kept_n, lower))
        left = total - kept
        gain = np.bincount(of, kept_n * np.log(kept_n / lower), len(contexts)) - kept * np.log(total)
        gain += left * np.log(np.where(left > 0, left, total) / total / np.maximum(1 - below, 1e-12))
        state = gain > _quantile_95(size) / 2
        rest = 1 - (kept - DISCOUNT * size) / total
        mine = np.where(state[of], (kept_n - DISCOUNT) / total[of] + rest[of] * lower, lower)
        more = np.where(state[of], np.log10(mine) - np.log10(rest[of]) - np.log10(lower), 0.0)
        adds = adds[up]
        adds[some] += np.where(state, np.log10(rest), 0.0)[nth]
        adds[at] += np.repeat(more, sizes)
        own = np.zeros(len(key))
        own[at] = np.repeat(mine, sizes)
    return adds


ASKED = "block long, range long, trie binary"
ANSWERED = "block long, row binary, n_known binary, base binary, score binary"
SUMS = "doc_id long, digest binary, n_tokens long, n_known long, base_score double, score double, copies long"


def score(texts: DataFrame, values: DataFrame, depth: int, ranges: int, turn: int = 0) -> DataFrame:
    """Rows of ANSWERED: what one round's ranges add to the scores of every text of the blocks.
    Depth 0: single words (no rounds), with their values (key, base, score); 1: pairs, with
    (key, part, score); beyond: contexts of two words to depth, and what
    follows them, with (range, keys, p) of `lower_of_pairs`."""

    def ask(batches):
        for number, data, places, taught in _loaded(batches):
            if depth:
                found = list(tries(data, places[0], taught, depth, ranges, True))
            else:
                word, _, token, row = unpacked(data, 4, np.int64, None, bool, np.uint16)
                some = np.flatnonzero(token & (word > NONE))
                if not len(some):
                    continue
                word, row = word[some], row[some]
                each = int(word.max()) // ranges + 1
                dealt = word % ranges * each + word // ranges
                order = _sorted_places(dealt)
                dealt, row = dealt[order], row[order]
                bounds = _runs(dealt)
                dealt = dealt[bounds[:-1]]
                cut = np.searchsorted(dealt, np.arange(ranges + 1) * each)
                found = [(r, packed([dealt[a:b] % each, np.diff(bounds[a:b + 1]), row[bounds[a]:bounds[b]]]))
                         for r, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if a < b]
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, number)), pa.array([r for r, _ in found], pa.int64()), pa.array([t for _, t in found], pa.binary())],
                _names(ASKED))

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.table({c: pa.array([], pa.int64() if c == "block" else pa.binary()) for c in _names(ANSWERED)})
        parts, lengths = gathered(asked["trie"], (3, 4)[depth] if depth < 2 else 3 + 2 * depth)
        if depth > 1:
            key, p = (np.concatenate([*_of_bytes(known[c], t), np.zeros(0, t)]) for c, t in (("keys", np.int64), ("p", np.float64)))
            order = _sorted_places(key)
            n, taught, row = parts[-3:]
            found = [branch(strings_of(parts, depth), taught, depth, key[order], p[order])]
        else:
            key = known["key"].to_numpy() if depth else known["key"].to_numpy() // ranges
            order = _sorted_places(key)
            bounds = _runs(key[order])
            told = Values(key[order][bounds[:-1]], *(np.add.reduceat(known[c].to_numpy()[order], bounds[:-1]) if len(key) else np.zeros(0)
                                                     for c in (["score"] if depth else ["base", "score"])))
            n, row = parts[-2:]
            found = told.of(strings_of(parts, 1)[0][0] if depth else parts[0].astype(np.int64))
            if not depth:
                found = [(found[0] > 0).astype(float), *found]
        # each text of a block has a place of its own in the sums
        ends = np.cumsum(lengths)
        most = np.maximum.reduceat(row, ends - lengths).astype(np.int64) + 1
        begin = np.cumsum(most) - most
        row = row + np.repeat(begin, lengths)
        found = [np.bincount(row, np.repeat(x, n), begin[-1] + most[-1]) for x in found]
        some = np.flatnonzero(reduce(np.logical_or, [x != 0 for x in found]))
        cut = np.searchsorted(some, np.append(begin, begin[-1] + most[-1]))
        whose = [slice(a, b) for a, b in zip(cut[:-1], cut[1:])]
        found = [x[some] for x in found]
        some -= np.repeat(begin, np.diff(cut))
        none = pa.nulls(len(whose), pa.binary())
        columns = [none] * 2 if depth else [_bytes([x[own] for own in whose]) for x in found[:2]]
        return pa.table(dict(zip(_names(ANSWERED), [asked["block"], _bytes([some[own].astype(np.uint16) for own in whose]), *columns,
                                                    _bytes([found[-1][own] for own in whose])])))

    held = values if depth > 1 else values.withColumn("range", _range_column("key", ranges) if depth else F.pmod("key", F.lit(ranges).cast("long")))
    if depth == 1:
        held = held.where(F.col("part") == turn)
    asked = _round(texts, turn).mapInArrow(ask, ASKED)
    return asked.groupBy("range").cogroup(held.groupBy("range")).applyInArrow(answer, ANSWERED)


def sums(texts: DataFrame, answers: DataFrame) -> DataFrame:
    """Rows of SUMS, one of every text, or piece of a long one, from those of ANSWERED."""

    def add_up(told: pa.Table, head: pa.Table) -> pa.Table:
        ids, piece, tokens, digest = (head[c].combine_chunks().flatten() for c in ("doc_id", "piece", "n_tokens", "digest"))
        total = {c: np.zeros(len(ids)) for c in ("n_known", "base", "score")}
        for row, *values in zip(_of_bytes(told["row"], np.uint16), *(told[c] for c in total)):
            for out, x in zip(total.values(), values):
                if x.is_valid:
                    out[row] += np.frombuffer(x.as_py(), np.float64)
        return pa.table({"doc_id": ids, "digest": digest, "n_tokens": tokens, "n_known": total["n_known"].astype(np.int64),
                         "base_score": total["base"], "score": total["score"], "copies": (piece.to_numpy() == 0).astype(np.int64)})

    heads = texts.select("block", *_names(HEADS))
    return answers.groupBy("block").cogroup(heads.groupBy("block")).applyInArrow(add_up, SUMS)


def score_texts(df: DataFrame, learn: Column, depth: int = DEPTH, id_col: str = "doc_id",
                text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row,
    by a tree grown on the rows where `learn` (a condition on doc_id) holds."""
    docs = keyed_texts(df, id_col, text_col).withColumn("learn", F.coalesce(learn, F.lit(False)))
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 6)).first()[0] or 0
    ranges = min(1 << 20, max(ROUNDS, 1 + size // range_bytes))
    own = -(-ranges // ROUNDS)  # of a round
    _batches_of_bytes(df.sparkSession)
    cut = _kept(cut_texts(docs, depth), "suffixtree-cut", BLOCK_FILE)
    numbered = _kept(number_words(cut, ranges), "suffixtree-numbers")
    texts = _kept(numbered_texts(cut, numbered, depth), "suffixtree-texts", BLOCK_FILE)
    dropped(cut)
    words = _kept(words_of(numbered), "suffixtree-words")
    n, v = numbered.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    dropped(numbered)
    one, pairs = grow(words, _kept(count_pairs(texts, ranges), "suffixtree-pairs"), int(n), int(v))
    rounds = [_kept(score(texts, one, 0, ranges), "suffixtree-scores-words")]
    rounds += [_kept(score(texts, pairs.where("score is not null"), 1, own, k), f"suffixtree-scores-pairs-round{k}")
               for k in range(ROUNDS)]
    if depth > 1:
        lower = [_kept(lower_of_pairs(texts, pairs, own, k), f"suffixtree-lower-round{k}") for k in range(ROUNDS)]
    dropped(one, pairs)
    if depth > 1:
        for k, held in enumerate(lower):
            rounds.append(_kept(score(texts, held, depth, own, k), f"suffixtree-scores-round{k}"))
            dropped(held)
    # a long text has a row for each of its pieces; equal rows have equal sums
    rows = sums(texts, _union(rounds)).groupBy("doc_id", "digest").agg(
        *[F.sum(c).alias(c) for c in ("copies", "n_tokens", "n_known", "base_score", "score")])
    root = F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    rows = rows.withColumn("n_tokens", (F.col("n_tokens") / F.col("copies")).cast("long"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows.select("doc_id", "n_tokens", (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"),
                       F.lit(int(n)).cast("long").alias("train_tokens"),
                       *[(F.col(c) / F.col("copies") - root).alias(c) for c in ("base_score", "score")])
