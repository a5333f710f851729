"""Byte-level BPE by merges on padded numpy matrices.

A text is cut into pieces by the vocabulary's pattern and each piece is merged
by itself. The new pieces of a slice of texts are dealt to buckets by length;
a bucket is one matrix with a row for each piece, padded with -1. Every round
finds each row's leftmost pair of least rank, merges it, shifts the rest of the
row to the left, and takes finished rows out of the matrix (compaction). Pair
ranks come from an open-addressing hash table in numpy arrays (`Places`). Workers keep the
ids of pieces they have seen in a bounded table.

A long piece (over LONG bytes) merges all occurrences of its least rank in one
round where that gives what one merge after the other would give, and only the
leftmost where a new pair would rank lower; so its rounds follow its distinct
merges and not its length.

Defined results: a null or empty text has no ids and decodes to no bytes; every
row gives one row, repeated rows and null ids included; an empty table gives no
row; extra columns are left out. Ids that the vocabulary does not hold, given
to `decode`, raise an error.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkpi.llm.common import Places, keyed_texts, text_slices, worker_state

PIECE_CACHE = 500_000
LONG = 64
NONE = np.int64(1) << 40
#: Unicode White_Space, as the pattern's \s has it (Python's str.isspace differs).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ENCODED_SCHEMA = "doc_id long, n_tokens long, ids binary"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PairTable:
    """rank of (left id, right id), for arrays of pairs; NONE where there is no merge."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.places = Places(np.fromiter(pairs, np.int64, len(pairs)))
        # place -1, no merge, reads the last
        self.ranks = np.append(np.fromiter(pairs.values(), np.int64, len(pairs)), NONE)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = np.where((left < 0) | (right < 0), -1, left << 32 | right)
        return self.ranks[self.places.find(keys.ravel())].reshape(left.shape)


class Bpe:
    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = load_ranks(path)
        self.pairs = PairTable(self.ranks)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.pieces_of = regex.compile(pattern).findall
        # runs that end where white space begins hold whole pieces, and fewer of them
        self.runs_of = regex.compile(f"[ ]?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall
        self.known: dict[str, bytes] = {}
        size = max(self.ranks.values()) + 1
        self.bytes_of: list[bytes | None] = [None] * size
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token

    def _matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        """ids of pieces of at most `width` bytes."""
        out: list[bytes] = [b""] * len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        lengths = np.array([len(p) for p in pieces])
        ids = np.where(np.arange(width) < lengths[:, None], self.single[raw], -1)
        rows = np.arange(len(pieces))
        ranks = self.pairs(ids[:, :-1], ids[:, 1:])
        places = np.arange(width)
        while len(rows):
            at = ranks.argmin(axis=1)  # the leftmost of the least
            least = ranks[np.arange(len(rows)), at]
            done = least == NONE
            if done.any():
                for r, n, x in zip(rows[done], (ids[done] >= 0).sum(axis=1), ids[done].astype("<u4")):
                    out[r] = x[:n].tobytes()
                rows, ids, ranks, at, least = (x[~done] for x in (rows, ids, ranks, at, least))
                if not len(rows):
                    break
            each = np.arange(len(rows))
            ids[each, at] = least
            step = np.minimum(places + (places > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, step, axis=1)
            ids[:, -1] = -1  # every row has become shorter by one
            ranks = np.take_along_axis(ranks, step[:, :-1].clip(max=width - 2), axis=1)
            ranks[:, -1] = NONE
            after = np.minimum(at + 1, width - 1)
            ranks[each, np.minimum(at, width - 2)] = np.where(
                at < width - 1, self.pairs(ids[each, at], np.where(at < width - 1, ids[each, after], -1)), NONE)
            has = at > 0
            ranks[each[has], at[has] - 1] = self.pairs(ids[each[has], at[has] - 1], ids[each[has], at[has]])
        return out

    def _long(self, piece: bytes) -> bytes:
        """ids of one long piece: a matrix of one row, merging equal pairs together where that is the same."""
        ids = self.single[np.frombuffer(piece, np.uint8)]
        ranks = self.pairs(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) < NONE:
            at = np.flatnonzero(ranks == least)
            run = np.concatenate([[True], np.diff(at) != 1])  # only pairs of equal ids overlap
            since = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[since % 2 == 0]
            merged = np.full(len(at), least)
            before = np.where(at > 0, ids[np.maximum(at - 1, 0)], -1)
            after = np.where(at + 2 < len(ids), ids[np.minimum(at + 2, len(ids) - 1)], -1)
            next_to = np.concatenate([np.diff(at) == 2, [False]])
            lower = ((self.pairs(before, merged) < least) | (self.pairs(merged, after) < least)
                     | (next_to & (self.pairs(merged, merged) < least)))
            if lower.any():
                at = at[:1]
            ids[at] = least
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids = ids[keep]
            if len(at) == 1:
                i = int(at[0])
                ranks = np.delete(ranks, i)
                for j in (i - 1, i):
                    if 0 <= j < len(ids) - 1:
                        ranks[j] = self.pairs(ids[j:j + 1], ids[j + 1:j + 2])[0]
            else:
                ranks = self.pairs(ids[:-1], ids[1:])
        return ids.astype("<u4").tobytes()

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """ids (little-endian unsigned 32-bit) of pieces; a piece that is a token is that token."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (rank := self.ranks.get(p)) is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(p) > LONG:
                out[i] = self._long(p)
            else:
                buckets.setdefault(max(4, 1 << (len(p) - 1).bit_length()), []).append(i)
        for width, rows in buckets.items():
            for i, ids in zip(rows, self._matrix([pieces[i] for i in rows], width)):
                out[i] = ids
        return out

    def _learn(self, runs: list[str]) -> None:
        known = self.known
        cut = [self.pieces_of(r) for r in runs]
        new = list({p for ps in cut for p in ps if p not in known})
        known.update(zip(new, self.merge([p.encode("utf-8") for p in new])))
        known.update((r, b"".join([known[p] for p in ps])) for r, ps in zip(runs, cut) if len(ps) != 1)

    def encode(self, texts: list[str]) -> list[bytes]:
        rows = [self.runs_of(t) for t in texts]
        if len(self.known) > PIECE_CACHE:
            self.known.clear()
        known = self.known
        self._learn(list({r for row in rows for r in row if r not in known}))
        return [b"".join([known[r] for r in row]) for row in rows]

    def decode(self, ids: bytes) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])


def bpe(path: str, pattern: str) -> Bpe:
    return worker_state(f"bpe:{path}:{pattern}", lambda: Bpe(path, pattern))


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) of every text."""

    def run(batches):
        coder = bpe(path, pattern)
        for batch in batches:
            for first, texts in text_slices(batch):
                ids = coder.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return keyed_texts(df, id_col, text_col).mapInArrow(run, ENCODED_SCHEMA)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of `encode` with `decoded`, the bytes that the ids stand for."""

    def run(batches):
        coder = bpe(path, pattern)
        for batch in batches:
            ids = batch.column(2)
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                decoded = [coder.decode(ids[first + i].as_py()) for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())],
                                                 ["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(
        run, ENCODED_SCHEMA + ", decoded binary")
