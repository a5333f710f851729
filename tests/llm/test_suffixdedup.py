import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelkpi.llm import suffixdedup as sd
from reelkpi.llm.registry import QUERIES


def brute(pairs, size=sd.SIZE):
    """(id, bytes, removed, spans, digest) by counting every window of every text."""
    texts = [(i, (t or "").encode()) for i, t in pairs]
    windows = Counter(t[k:k + size] for _, t in texts for k in range(len(t) - size + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for k in range(len(t) - size + 1):
            if windows[t[k:k + size]] > 1:
                gone[k + 1:k + 1 + size] = True
        spans = int((np.diff(gone.astype(int)) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone[1:-1]].tobytes()
        out.append((str(i), len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def collected(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest())
                  for r in df.collect())


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=900), st.sampled_from([130, 200, 300]), st.sampled_from([64, 150, 1 << 20]))
def test_every_window_has_its_anchor(data, size, stretch):
    raw = np.frombuffer((data * 3)[:1500], np.uint8)
    h, place, first, last = sd.anchors(raw, size, stretch=stretch)
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)]) if len(h) else np.zeros(0)
    assert starts.tolist() == list(range(max(0, len(raw) - size + 1)))
    assert all(a <= b <= p <= a + size - sd.GRAM for p, a, b in zip(place, first, last))
    by = {}
    for x, p, a, b in zip(h, place, first, last):  # equal windows: equal anchors at equal offsets
        for s in range(a, b + 1):
            assert by.setdefault(raw[s:s + size].tobytes(), (x, p - s)) == (x, p - s)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.binary(min_size=14, max_size=14)), max_size=24), st.integers(2, 6))
def test_columns(rows, size):
    rows.sort(key=lambda r: r[0])
    rows = [(c, bytes(x % 3 if x % 17 else sd.GONE for x in b)) for c, b in rows]
    columns = np.array([list(b) for _, b in rows], np.uint8).reshape(len(rows), 14).T
    got = sd.sort_columns(np.array([c for c, _ in rows], np.int64), columns, size, 14 - size + 1)
    for i, (c, b) in enumerate(rows):
        for k in range(14 - size + 1):
            window = b[k:k + size]
            want = sd.GONE not in window and any(j != i and d == c and x[k:k + size] == window
                                                 for j, (d, x) in enumerate(rows))
            assert got[i, k] == want


def words(rng, n):
    return " ".join("".join(rng.choice(list("abcdeéñ"), 5)) for _ in range(n))


def planted(rng):
    shared = [words(rng, 60) for _ in range(3)]
    base = words(rng, 300)
    pairs = [(i, f"{words(rng, 40)} {shared[i % 3]} {words(rng, 30)}") for i in range(12)]
    pairs += [(100 + i, base[:600 + 37 * i] + str(i) + base[600 + 37 * i:]) for i in range(6)]  # near copies
    pairs += [(200, "x" * 900), (201, "ab" * 260), (202, shared[0][:150] + words(rng, 50)), (203, shared[1][5:230])]
    pairs += [(300, words(rng, 80)), (301, None), (302, ""), (303, "short"), (303, "short"), (304, base), (304, base)]
    twice = words(rng, 50)
    return pairs + [(400, twice + words(rng, 20) + twice), (None, twice[:260]), (None, None)]


def test_hot_passage_is_never_one_collection(spark, make_docs):
    """One passage in many documents with surroundings of their own: the segments
    at its ends are all distinct, and equal on the passage's side. None of the
    collections that are sorted exceeds `hot`, and nothing is lost."""
    rng = np.random.default_rng(11)
    word = lambda n: bytes(rng.integers(97, 123, n).tolist()).decode()
    passage, short = word(300), word(230)
    pairs = [(i, word(int(rng.integers(150, 400))) + passage + word(int(rng.integers(150, 400)))) for i in range(400)]
    pairs += [(1000 + i, word(90) + short + word(90)) for i in range(150)] + [(2000 + i, passage[:250] + word(300)) for i in range(60)]
    pairs += [(3000 + i, pairs[0][1]) for i in range(5)] + [(4000, passage), (4001, word(500))]
    docs, hot = make_docs(pairs), 50
    texts = sd.texts_with_anchors(docs, "doc_id", "text", (), sd.SIZE)
    found = sd.segments(texts, sd.SIZE)
    distinct = found.groupBy("segment").agg(F.count("*").alias("n"), *[F.any_value(c, F.lit(True)).alias(c) for c in (
        "bytes", "hash", "lead", "windows")])
    fine, counted = sd.collections(distinct, sd.GRAM, sd.SIZE, hot)
    assert counted is not None and counted.count() > 400
    assert distinct.groupBy("hash").count().agg(F.max("count")).first()[0] > 300
    assert fine.groupBy("collection").count().agg(F.max("count")).first()[0] <= hot
    assert collected(sd.deduplicate(docs, hot=hot, group_segments=100)) == brute(pairs)


@pytest.mark.parametrize("hot,groups", [(sd.HOT, sd.GROUP_SEGMENTS), (2, 10)])
def test_planted_passages(make_docs, hot, groups):
    pairs = planted(np.random.default_rng(8))
    docs = make_docs(pairs, place=T.StringType(), hash=T.LongType(), row=T.StringType(), part=T.LongType())
    assert collected(sd.deduplicate(docs, hot=hot, group_segments=groups)) == brute(pairs)


def test_odd_rows_and_kept_columns(make_docs, odd_pairs):
    docs = make_docs(odd_pairs, packed=T.StringType())
    rows = sd.deduplicate(docs, keep=("lang", "packed", "text"))
    assert rows.columns == ["doc_id", "n_bytes", "spans", "kept", "lang", "packed", "text"]
    assert collected(rows) == brute(odd_pairs)


def test_empty_table(make_docs):
    assert sd.deduplicate(make_docs([])).collect() == []


def test_query_on_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op4_suffix_dedup"](spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    assert got == brute([(d.doc_id, d.text) for d in docs])
    assert sum(r.n_removed for r in rows) > 0
