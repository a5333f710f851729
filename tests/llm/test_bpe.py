import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from reelkpi.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
CODER = bpe.Bpe(PATH, PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def ids_of(texts):
    return [np.frombuffer(x, "<u4").tolist() for x in CODER.encode(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=8))
def test_like_the_library(texts):
    assert ids_of(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab tionesh\n \x1c\x85'sé", max_size=400), max_size=4))
def test_dense_merges_and_odd_spaces(texts):
    assert ids_of(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "tionthe" * 900, "=" * 4097, " " * 3000 + "x", "é" * 999,
                                  "thetionre" * 41 + "x" * 77 + "erhe" * 200, "\n" * 500, "0123456789" * 300])
def test_long_pieces(text):
    assert ids_of([text]) == [LIBRARY.encode_ordinary(text)]


def test_long_and_matrix_forms_agree():
    rng = np.random.default_rng(5)
    for _ in range(60):
        piece = bytes(rng.choice(list(b"theraonis"), size=int(rng.integers(2, 64))).tolist())
        if piece not in CODER.ranks:
            assert CODER._long(piece) == CODER._matrix([piece], 64)[0]


def test_operator_on_odd_rows(make_docs, odd_pairs):
    docs = make_docs(odd_pairs, ids=T.StringType(), n_tokens=T.StringType(), decoded=T.LongType())
    rows = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, PATTERN).collect()
    got = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in rows)
    want = sorted((str(i), LIBRARY.encode_ordinary(t or ""), (t or "").encode()) for i, t in odd_pairs)
    assert got == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in rows)


def test_empty_table(make_docs):
    assert bpe.decode(bpe.encode(make_docs([]), PATH, PATTERN), PATH, PATTERN).collect() == []


def test_query_on_given_table(spark):
    from reelkpi.llm.registry import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op3_byte_bpe"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = LIBRARY.encode_ordinary(d.text)
        assert rows[d.doc_id].n_tokens == len(ids)
        assert rows[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[d.doc_id].decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()
