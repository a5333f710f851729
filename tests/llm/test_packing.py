import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from reelkpi.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text, end):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [end]


def test_pieces_hold_every_id_once(make_docs, odd_pairs):
    docs = make_docs(odd_pairs, ids=T.StringType(), part=T.StringType(), base=T.LongType(), at=T.LongType())
    rows = packing.pack(docs, PATH, end_id=1, window=64).collect()
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for s, pieces in by_seq.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length == len(p.ids) // 4 > 0
            at += p.length
        assert at == 64 or s == len(by_seq) - 1
    # the pieces of each document, in order, are the library's ids
    ordered = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    docs_found, held = [], None
    for r in ordered:
        if r.start == 0:
            held = [r.doc_id, r.doc_tokens, b""]
            docs_found.append(held)
        assert held[0] == r.doc_id and len(held[2]) == 4 * r.start
        held[2] += bytes(r.ids)
    want = sorted((str(i), tuple(library_ids(t, 1))) for i, t in odd_pairs)
    got = sorted((str(i), tuple(np.frombuffer(b, "<u4").tolist())) for i, n, b in docs_found)
    assert got == want
    assert all(len(b) == 4 * n for _, n, b in docs_found)


def test_assembled_sequences(make_docs, odd_pairs):
    pieces = packing.pack(make_docs(odd_pairs), PATH, end_id=1, window=128)
    seqs = packing.sequences(pieces).collect()
    total = sum(len(library_ids(t, 1)) for _, t in odd_pairs)
    assert sum(s.n_ids for s in seqs) == total
    assert sorted(s.n_ids for s in seqs)[1:] == [128] * (len(seqs) - 1)


def test_empty_table(make_docs):
    assert packing.pack(make_docs([]), PATH, end_id=1).collect() == []


def test_query_on_given_table(spark):
    from reelkpi.llm.registry import QUERIES

    rows = QUERIES["op8_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(texts)
    ids = {d: np.array(library_ids(t, 1), "<u4") for d, t in texts.items()}
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))


@pytest.mark.parametrize("window", [1, 7])
def test_tiny_windows(make_docs, window):
    rows = packing.pack(make_docs([(1, "a b c"), (2, None)]), PATH, end_id=1, window=window).collect()
    assert sum(r.length for r in rows) == 5 and max(r.length for r in rows) <= window
