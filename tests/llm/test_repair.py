import tempfile
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from reelkpi.llm import repair

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


def check_block(docs):
    flat = np.array([x for d in docs for x in d], dtype=np.int64)
    ends = np.cumsum([len(d) for d in docs])
    last = np.zeros(len(flat), bool)
    last[ends - 1] = True
    first, rules, symbols, place = repair.compress(flat, last)
    assert repair.expand(symbols, first, rules).tolist() == flat.tolist()
    lengths = repair.expansion_lengths(first, rules)
    sizes = np.where(symbols >= first, lengths[np.maximum(symbols - first, 0)] if len(lengths) else 1, 1)
    assert (np.cumsum(sizes) - sizes).tolist() == place.tolist()
    starts = [0, *ends[:-1].tolist()]
    assert set(starts) <= set(place.tolist())  # no rule crosses a document's end
    # no pair within a document is left that occurs LEAST_COUNT times
    end = np.isin(np.cumsum(sizes), ends)
    pairs = list(zip(symbols[:-1][~end[:-1]].tolist(), symbols[1:][~end[:-1]].tolist()))
    assert max(Counter(pairs).values(), default=0) < repair.LEAST_COUNT
    return len(symbols)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=60), min_size=1, max_size=20))
def test_blocks_come_back(docs):
    check_block(docs)


def test_repeats_get_shorter():
    assert check_block([[5, 6, 7, 8] * 500, [7, 7, 7, 7, 7, 7] * 300]) < 1200


def test_grammar_of_texts_is_whole():
    """A block of real texts: no frequent pair is left, also when rare pairs fill the cells."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    docs = [library_ids(t) for t in texts]
    assert check_block(docs) < 0.6 * sum(map(len, docs))
    rng = np.random.default_rng(1)
    noise = rng.integers(0, 1 << 20, 400_000).tolist()
    at = rng.integers(0, len(noise), 40).tolist()
    for i in at[:20]:
        noise[i:i] = [7, 8, 9]
    check_block([noise])


def read(store):
    return sorted((r.start, r.doc_id, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in store)


def test_store_in_id_order(spark, make_docs, odd_pairs):
    docs = make_docs(odd_pairs, part=T.StringType(), symbols=T.LongType(), before=T.StringType())
    path = tempfile.mkdtemp(prefix="repair-") + "/store"
    repair.write_store(docs, path, PATH, end_id=2, block_ids=3000)
    rows = [(r.start, r.doc_id, np.frombuffer(r.ids, "<u4").tolist())
            for r in repair.read_store(spark, path).collect()]
    rows.sort(key=lambda r: r[0])
    at = 0
    for start, _, ids in rows:
        assert start == at
        at += len(ids)
    order = [r[1] for r in rows]
    assert order[:2] == [None, None] and order[2:] == sorted(order[2:])
    assert sorted((str(d), i) for _, d, i in rows) == sorted((str(d), library_ids(t)) for d, t in odd_pairs)
    some = repair.read_store(spark, path, doc_ids=[7, 4, 99]).collect()
    assert sorted((r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in some) == \
        sorted((s, i) for s, d, i in rows if d in (7, 4))


def test_empty_table(spark, make_docs):
    path = tempfile.mkdtemp(prefix="repair-") + "/store"
    repair.write_store(make_docs([]), path, PATH, end_id=2)
    assert repair.read_store(spark, path).collect() == []


def test_query_on_given_table(spark):
    from reelkpi.llm.registry import QUERIES

    rows = QUERIES["op9_token_files"](spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    at = 0
    assert len(rows) == len(docs)
    for r, d in zip(rows, docs):
        ids = np.array(library_ids(d.text), "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_pairs_are_counted_once_and_then_kept_up(monkeypatch):
    """A round counts the pairs that its replacements touch, not the whole block again."""
    seen = []
    counts = repair._counts
    monkeypatch.setattr(repair, "_counts", lambda cells: seen.append(len(cells)) or counts(cells))
    monkeypatch.setattr(repair, "PAIRS_A_ROUND", 8)
    rng = np.random.default_rng(3)
    ids = (rng.zipf(1.3, 20_000) % 3000).astype("<u4")
    check_block([ids[i:i + 50].tolist() for i in range(0, len(ids), 50)])
    rounds = (len(seen) - 1) // 2
    assert rounds > 20 and seen[0] == len(ids)
    assert sum(seen[1:]) < rounds * len(ids) // 4
