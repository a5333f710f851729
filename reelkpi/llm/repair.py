"""Token-id files compressed by a Re-Pair grammar, with random access.

Documents go to shards in ascending id order (a range partitioning, so no task
holds more than its range), each shard is cut into blocks of about `block_ids`
ids, and each block is one row of the file: its rules (pairs of symbols), the
length of each rule's expansion, the symbols that are left, and for every
document its first symbol and its number of ids. No rule crosses a document's
end, so a document is read by expanding its own symbols alone.

Re-Pair: each round counts the pairs of neighbouring symbols, takes the most
frequent ones, replaces all their occurrences by new symbols, and starts again
until no pair occurs LEAST_COUNT times. The pairs of one round are chosen so that
no symbol is the left of one and the right of another, hence occurrences never
overlap (a pair of two equal symbols is replaced from the left in each run).

Defined results: a null or empty text is its end id alone; rows with equal ids
follow one another in the order of a hash of their texts, equal rows included
as often as they occur; null ids come first; an empty table gives no file row;
extra columns are left out; a text longer than a block is a block of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelkpi.llm.common import keyed_texts, partition_bases, text_slices
from reelkpi.llm.wordtokens import word_encoder

BLOCK_IDS = 1 << 20
#: Pairs replaced in one round.
PAIRS_A_ROUND = 4096
#: A rule costs two symbols and a length, so rarer pairs do not pay.
LEAST_COUNT = 6

FILE_SCHEMA = """part int, block int, before long, n_ids long, n_docs int, least_doc long, greatest_doc long,
    doc_ids array<long>, doc_lengths binary, doc_symbols binary, first_rule long, rules binary,
    expansions binary, symbols binary"""
READ_SCHEMA = "doc_id long, part int, before long, n_tokens long, ids binary"


#: Pairs are first counted by hash, in this many cells.
CELL_BITS = 18
#: The cell of symbols that start no pair.
NO_PAIR = 1 << CELL_BITS


def _cells(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA6B)) >> np.uint32(32 - CELL_BITS)


def _counts(cells: np.ndarray) -> np.ndarray:
    out = np.bincount(cells, minlength=NO_PAIR + 1)
    out[NO_PAIR] = 0
    return out


def _chosen(pairs: np.ndarray) -> list[int]:
    """Of pairs, most frequent first, those that can be replaced in one round:
    no symbol is left in one and right in another."""
    left, right, chosen = set(), set(), []
    for pair in pairs.tolist():
        a, b = pair >> 32, pair & 0xFFFFFFFF
        if a not in right and b not in left and (a != b or (a not in left and b not in right)):
            left.add(a), right.add(b)
            if a == b:  # taken out of all other pairs
                left.add(b), right.add(a)
            chosen.append(pair)
    return chosen


def compress(ids: np.ndarray, last: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(first rule's symbol, rules, symbols, place of each symbol's first id).

    ids: symbols of all documents; last: True at each document's last id."""
    seq = ids.astype(np.uint32)
    first = top = int(seq.max()) + 1 if len(seq) else 0
    # cell of the pair that starts at each symbol; no pair crosses a document's end
    cell = np.full(len(seq), NO_PAIR, np.int64)
    cell[:-1] = _cells(seq[:-1], seq[1:])
    cell[last] = NO_PAIR
    filled = _counts(cell)
    rules: list[np.ndarray] = []
    whole = False
    while len(seq) > 1:
        # a cell holds at least what each of its pairs counts: only pairs of well-filled cells are counted one by one
        least = LEAST_COUNT if whole else max(LEAST_COUNT, int(np.partition(filled, -PAIRS_A_ROUND)[-PAIRS_A_ROUND]))
        at = np.flatnonzero((filled >= least).take(cell))
        key = seq[at].astype(np.int64) << 32 | seq[at + 1]
        pairs, counts = np.unique(key, return_counts=True)
        pairs, counts = pairs[counts >= LEAST_COUNT], counts[counts >= LEAST_COUNT]
        chosen = np.array(_chosen(pairs[np.argsort(-counts, kind="stable")[:PAIRS_A_ROUND]]), dtype=np.int64)
        if not len(chosen):
            if least == LEAST_COUNT:
                break
            whole = True  # rare pairs alone fill the fullest cells: look into all that may hold a frequent one
            continue
        whole = False
        left, right = (chosen >> 32).astype(np.uint32), (chosen & 0xFFFFFFFF).astype(np.uint32)
        rule_of = np.full(NO_PAIR + 1, -1, np.int32)  # of two pairs in one cell the more frequent is replaced
        rule_of[_cells(left, right)[::-1]] = np.arange(len(chosen), dtype=np.int32)[::-1]
        rule = rule_of[cell[at]]
        hit = (rule >= 0) & (chosen[rule] == key)
        at, rule = at[hit], rule[hit]
        # pairs of equal symbols overlap in runs: every other one counts, from the left
        run = np.concatenate([[True], np.diff(at) != 1]) if len(at) else np.zeros(0, bool)
        from_left = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        at, rule = at[from_left % 2 == 0], rule[from_left % 2 == 0]
        used, rule = np.unique(rule, return_inverse=True)
        rules.append(chosen[used])
        # only pairs that a replaced one is part of or touches are counted anew
        apart = at > 0
        apart[1:] &= at[1:] - at[:-1] != 2  # else the pair to the left touches two replaced ones
        now = at - np.arange(len(at))  # places after the replacement
        filled -= _counts(cell[np.concatenate([at, at + 1, at[apart] - 1])])
        seq[at] = top + rule
        cell[at] = cell[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, cell = seq[keep], cell[keep]
        changed = np.concatenate([now, now[apart] - 1])
        changed = changed[cell[changed] != NO_PAIR]
        cell[changed] = _cells(seq[changed], seq[changed + 1])
        filled += _counts(cell[changed])
        top += len(used)
    flat = np.concatenate(rules) if rules else np.zeros(0, np.int64)
    grammar = np.stack([flat >> 32, flat & 0xFFFFFFFF], axis=1)
    symbols = seq.astype(np.int64)
    sizes = np.concatenate([[1], expansion_lengths(first, grammar)])[np.maximum(symbols - first + 1, 0)]
    return first, grammar, symbols, np.cumsum(sizes) - sizes


def expansion_lengths(first: int, rules: np.ndarray) -> np.ndarray:
    """Ids that each rule stands for; a rule's parts come before it."""
    out = np.ones(len(rules), dtype=np.int64)
    of = lambda s: out[s - first] if s >= first else 1
    for i, (a, b) in enumerate(rules.tolist()):
        out[i] = of(a) + of(b)
    return out


def expand(symbols: np.ndarray, first: int, rules: np.ndarray) -> np.ndarray:
    """The ids of any run of symbols: rules are opened until none is left."""
    seq = symbols.astype(np.int64)
    while len(seq) and (seq >= first).any():
        rule = seq >= first
        starts = np.cumsum(1 + rule) - (1 + rule)
        out = np.empty(int(len(seq) + rule.sum()), dtype=np.int64)
        out[starts[~rule]] = seq[~rule]
        parts = rules[seq[rule] - first]
        out[starts[rule]], out[starts[rule] + 1] = parts[:, 0], parts[:, 1]
        seq = out
    return seq


def _width(top: int) -> str:
    return "<u2" if top <= 1 << 16 else "<u4"


def _block(part: int, block: int, before: int, doc_ids: list, ids: list[bytes]) -> dict:
    lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    flat = np.frombuffer(b"".join(ids), "<u4")
    last = np.zeros(len(flat), bool)
    last[np.cumsum(lengths) - 1] = True
    first, rules, symbols, place = compress(flat, last)
    doc_at = np.searchsorted(place, np.cumsum(lengths) - lengths)
    top = first + len(rules)
    known = [d for d in doc_ids if d is not None]
    return {"part": part, "block": block, "before": before, "n_ids": int(lengths.sum()), "n_docs": len(ids),
            "least_doc": min(known, default=None), "greatest_doc": max(known, default=None), "doc_ids": doc_ids,
            "doc_lengths": lengths.astype("<u4").tobytes(), "doc_symbols": doc_at.astype("<u4").tobytes(),
            "first_rule": first, "rules": rules.astype(_width(top)).tobytes(),
            "expansions": expansion_lengths(first, rules).astype("<u4").tobytes(),
            "symbols": symbols.astype(_width(top)).tobytes()}


def write_store(df: DataFrame, path: str, tokenizer_path: str, end_id: int, block_ids: int = BLOCK_IDS,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all documents, in ascending id order, to `path` (a shared folder)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(FILE_SCHEMA))

    def run(batches):
        from pyspark import TaskContext

        part, block, before = TaskContext.get().partitionId(), 0, 0
        encoder, end = word_encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        docs, held, size = [], [], 0

        def row():
            return pa.RecordBatch.from_pylist([_block(part, block, before, docs, held)], schema=schema)

        for batch in batches:
            for first, texts in text_slices(batch):
                keys = batch.column(0).slice(first, len(texts)).to_pylist()
                for key, ids in zip(keys, encoder.encode(texts)):
                    n = len(ids) // 4 + 1
                    if held and size + n > block_ids:
                        yield row()
                        docs, held, block, before, size = [], [], block + 1, before + size, 0
                    docs.append(key), held.append(ids + end)
                    size += n
        if held:
            yield row()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (keyed_texts(df, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(path))


def _documents(row: dict, wanted: set | None):
    lengths, at = np.frombuffer(row["doc_lengths"], "<u4").astype(np.int64), np.frombuffer(row["doc_symbols"], "<u4")
    n_rules = len(row["expansions"]) // 4
    width = _width(row["first_rule"] + n_rules)
    rules = np.frombuffer(row["rules"], width).astype(np.int64).reshape(-1, 2)
    symbols = np.frombuffer(row["symbols"], width)
    starts = np.cumsum(lengths) - lengths
    if wanted is None:  # the whole block at once: every symbol's ids from one table
        first, sizes = row["first_rule"], np.frombuffer(row["expansions"], "<u4").astype(np.int64)
        ids = np.concatenate([np.arange(first), expand(np.arange(first, first + n_rules), first, rules)]).astype("<u4")
        size = np.concatenate([np.ones(first, np.int64), sizes])
        begin = np.cumsum(size) - size
        own = size[symbols]
        at_ = np.repeat(begin[symbols] - (np.cumsum(own) - own), own)
        flat = ids[at_ + np.arange(len(at_))].tobytes()
        for i, key in enumerate(row["doc_ids"]):
            yield key, int(starts[i]), int(lengths[i]), flat[4 * starts[i]:4 * (starts[i] + lengths[i])]
        return
    ends = [*at[1:].tolist(), len(symbols)]
    for i, key in enumerate(row["doc_ids"]):
        if key in wanted:
            ids = expand(symbols[at[i]:ends[i]], row["first_rule"], rules)
            yield key, int(starts[i]), int(lengths[i]), ids.astype("<u4").tobytes()


def read_store(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids, for all
    documents or for those named: then only blocks whose id range holds one are
    read, and of these only the documents' own symbols are expanded."""
    blocks = spark.read.schema(FILE_SCHEMA).parquet(path)
    wanted = None if doc_ids is None else {int(x) for x in doc_ids}
    chosen = blocks
    if wanted is not None:
        meets = F.lit(False)
        for d in sorted(wanted):
            meets = meets | ((F.col("least_doc") <= d) & (F.col("greatest_doc") >= d))
        chosen = blocks.where(meets)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found, held = [], 0
                for key, start, n, ids in _documents(row, wanted):
                    found.append((key, row["part"], row["before"] + start, n, ids))
                    held += len(ids)
                    if held > 4 << 20:
                        yield _read_batch(found)
                        found, held = [], 0
                if found:
                    yield _read_batch(found)

    # one row per part of the files, so broadcast whatever the amount of data
    bases = F.broadcast(partition_bases(blocks, "part", "n_ids"))
    columns = "part", "before", "doc_ids", "doc_lengths", "doc_symbols", "first_rule", "rules", "expansions", "symbols"
    return (chosen.select(*columns).mapInArrow(run, READ_SCHEMA).join(bases, "part")
            .select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids"))


def _read_batch(found: list[tuple]) -> pa.RecordBatch:
    key, part, before, n, ids = zip(*found)
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(part, pa.int32()), pa.array(before, pa.int64()),
         pa.array(n, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "part", "before", "n_tokens", "ids"])
