"""Periodic runs of words: descending-LCP Kruskal over suffix classes.

A run is a stretch of words with smallest period q and length of at least
max(min_length, exponent * q) that no neighbouring word extends with period q.

Seeds. If i < j are neighbours in position among all suffixes that share their
first l words, l = lcp(i, j) and j - i <= l, then the words from i to j + l have
smallest period j - i; they are a run, beginning at i, if the words before i and
j differ. Every run with an exponent of 3 or more shows itself this way, at its
first word. So the suffixes of a text are united by decreasing common prefix
(the edges are neighbours in suffix order, taken as in Kruskal's algorithm) with
a union-find whose sets hold their positions in order; each union looks at the
positions that have just become neighbours.

Only prefixes of `gram` words or more can matter (a run's first period and the
rest share max(min_length, exponent * q) - q words), so the suffixes that take
part are those whose first `gram` words occur again in the text, found by a
rolling hash; of ordinary text these are few. Their order and common prefixes
come from prefix doubling over ranks, many texts at a time in numpy.

Scale: one narrow pass, a text at a time is the unit of work, no shuffle. Work
is n log n a text, in slices of about a megabyte of texts (or one longer text).
Words are compared by 64-bit hashes of their bytes, grams by 64-bit hashes of
these, within one text.

Defined results: a null, empty or blank text has no words, no run and keeps the
empty text; every row gets a row, null and repeated ids too; of runs with equal
exponents the least start, then period, is first; an empty table gives no row;
extra columns are left out.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelkpi.llm.common import BASE, SPACES, keyed_texts, mixed, run_hashes, text_slices

MIN_LENGTH, EXPONENT = 24, 3


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of the words (runs of bytes but 9-13 and 32) of all texts, an
    own key for the end of each text, and where each text begins."""
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    solid = ~SPACES[raw]
    edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    edges = np.concatenate([[0], edges]) if len(solid) and solid[0] else edges
    starts, ends = edges[::2], edges[1::2]
    words = mixed(run_hashes(raw, starts, ends))
    bounds = np.searchsorted(starts, np.cumsum([0, *[len(t) + 1 for t in texts]]))
    counts = np.diff(bounds)
    begin = np.cumsum(counts + 1) - counts - 1
    keys = mixed(np.arange(len(words) + len(texts), dtype=np.uint64) + np.uint64(BASE))
    keys[np.arange(len(words)) + np.repeat(np.arange(len(texts)), counts)] = words
    return keys, begin


def _grams(keys: np.ndarray, gram: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Hashes of the `gram` keys from each place (0 beyond the end), and those of 1, 2, 4, ... below gram."""
    def joined(a, b, width):  # width: the length of a
        out = np.zeros(len(keys), np.uint64)
        out[:len(keys) - width] = mixed(a[:len(keys) - width] * np.uint64(BASE) + b[width:])
        return out

    powers, width = [(1, keys)], 1
    while 2 * width <= gram:
        powers.append((2 * width, joined(powers[-1][1], powers[-1][1], width)))
        width *= 2
    whole, done = powers[-1][1], width
    for size, h in reversed(powers[:-1]):
        if done + size <= gram:
            whole, done = joined(whole, h, done), done + size
    return whole, [(s, h) for s, h in powers if s < gram]


def _dense(values: np.ndarray) -> np.ndarray:
    """Ranks from 1 of values, equal for equal ones."""
    return np.unique(values, return_inverse=True)[1] + 1


def neighbours(keys: np.ndarray, text_of: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, lcp): neighbours in suffix order within a text with a common prefix
    of at least `gram` words."""
    none = np.zeros(0, np.int64)
    # an end of own keys, so that there is a gram from every place
    keys = np.concatenate([keys, mixed(~np.arange(2 * gram, dtype=np.uint64))])
    text_of = np.concatenate([text_of, np.full(2 * gram, -1)])
    whole, below = _grams(keys, gram)
    order = np.lexsort((whole, text_of))
    same = (whole[order[1:]] == whole[order[:-1]]) & (text_of[order[1:]] == text_of[order[:-1]]) & (whole[order[1:]] != 0)
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    if not same.any():
        return none, none, none
    # the places that occur again, and those a gram later, to which they are compared
    taken = again.copy()
    taken[gram:] |= again[:-gram]
    places = np.flatnonzero(taken)
    at = np.full(len(keys), -1, np.int64)
    at[places] = np.arange(len(places))
    # ranks of the first gram: distinct grams in the order of their words
    _, first, inverse = np.unique(whole[places], return_index=True, return_inverse=True)
    grams = keys[places[first][:, None] + np.arange(gram)]
    by = np.empty(len(first), np.int64)
    by[np.lexsort(grams.T[::-1])] = np.arange(len(first))
    m = np.int64(len(places) + 2)
    rank = _dense(text_of[places] * m + by[inverse])
    levels, width = [(gram, rank)], gram
    while True:
        later = places + width
        next_at = np.where(later < len(keys), at[np.minimum(later, len(keys) - 1)], -1)
        second = np.where((next_at >= 0) & again[places], rank[next_at], 0)
        finer = _dense(rank * m + second)
        if finer.max() == rank.max():
            break
        rank, width = finer, 2 * width
        levels.append((width, rank))
    order = np.argsort(rank, kind="stable")
    order = order[again[places[order]]]
    i, j = places[order[:-1]], places[order[1:]]
    x, y, lcp = i.copy(), j.copy(), np.zeros(len(i), np.int64)
    for size, r in reversed(levels):
        a, b = at[x], at[y]
        equal = (a >= 0) & (b >= 0) & (r[a] == r[b])
        step = equal * size
        x, y, lcp = x + step, y + step, lcp + step
    for size, h in reversed(below):
        step = (h[x] == h[y]) * size
        x, y, lcp = x + step, y + step, lcp + step
    enough = lcp >= gram
    return i[enough], j[enough], lcp[enough]


def unite(i: np.ndarray, j: np.ndarray, lcp: np.ndarray) -> list[tuple[int, int, int]]:
    """(position, position, lcp) of all positions that become neighbours, at a
    distance within their common prefix, as classes are united by decreasing lcp."""
    by = np.argsort(-lcp, kind="stable")
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    seeds = []

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    for x, y, common in zip(i[by].tolist(), j[by].tolist(), lcp[by].tolist()):
        a, b = root(x), root(y)
        large, small = members.get(a) or [a], members.get(b) or [b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b], members[a] = a, large
        members.pop(b, None)
        others = set(small) if len(small) > 1 else ()
        for p in small:
            insort(large, p)
        for p in small:
            k = bisect_left(large, p)
            if k and p - (q := large[k - 1]) <= common and q not in others:
                seeds.append((q, p, common))
            if k + 1 < len(large) and (q := large[k + 1]) - p <= common and q not in others:
                seeds.append((p, q, common))
    return seeds


def text_runs(texts: list[bytes], min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """Each text's runs (start, length, period) by start, then period, in words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not texts:
        return out
    keys, begin = _words(texts)
    text_of = np.repeat(np.arange(len(texts)), np.diff(np.append(begin, len(keys))))
    # the least of max(min_length, exponent * q) - q over all q
    gram = max(1, min(max(min_length, exponent * q) - q for q in range(1, min_length + 1)))
    for p, q, common in unite(*neighbours(keys, text_of, gram)):
        period, text = q - p, int(text_of[p])
        length = period + common
        if length >= max(min_length, exponent * period) and (p == begin[text] or keys[p - 1] != keys[q - 1]):
            out[text].append((p - int(begin[text]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapsed(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by single spaces, without those that a run holds after its first period."""
    words = text.split()  # of bytes, at 9-13 and 32
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words)


RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, best int, collapsed string"
FIELDS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
              exponent: int = EXPONENT) -> DataFrame:
    """doc_id, runs, best (the place in runs of the one of greatest exponent, null
    if there is none) and the collapsed text of every row. exponent: 3 or more."""
    if exponent < 3 or min_length < 1:
        raise ValueError("runs need an exponent of 3 or more")

    def run(batches):
        for batch in batches:
            for first, texts in text_slices(batch):
                raw = [t.encode("utf-8") for t in texts]
                runs = text_runs(raw, min_length, exponent)
                best = [min(range(len(r)), key=lambda i: (-Fraction(r[i][1], r[i][2]), r[i][0], r[i][2])) if r else None for r in runs]
                items = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(items, FIELDS), pa.array(best, pa.int32()),
                     pa.array([collapsed(t, r).decode("utf-8") for t, r in zip(raw, runs)], pa.string())],
                    ["doc_id", "runs", "best", "collapsed"])

    return keyed_texts(df, id_col, text_col).mapInArrow(run, RUNS)
