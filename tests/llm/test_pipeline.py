import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from reelkpi.llm import simhash
from tests.llm.test_simhash import brute_bits, brute_components

SF = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def survivors(pairs):
    """The (id, text) rows that stay: the first of least id in each component."""
    groups = {}
    parts = {}
    rows = [(i, brute_bits(t), t) for i, t in pairs]
    numbered = brute_components([(n, b) for n, (_, b, _) in enumerate(rows)])
    for n, _, root in numbered:
        parts[int(n)] = root
    for n, (i, _, t) in enumerate(rows):
        groups.setdefault(parts[n], []).append((i is None, i or 0, n))
    return [pairs[min(g)[2]] for g in groups.values()]


def removed(texts, size=200):
    from collections import Counter

    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[k:k + size] for t in raw for k in range(len(t) - size + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - size + 1):
            if seen[t[k:k + size]] > 1:
                gone[k:k + size] = True
        out.append(np.frombuffer(t, np.uint8)[~gone].tobytes().decode("utf-8", "ignore"))
    return out


def pairs_of(df):
    return sorted(((str(r.doc_id), r.text) for r in df.collect()), key=str)


def check_pieces(pieces, pairs):
    ids = {}
    for r in sorted(pieces.collect(), key=lambda r: (r.sequence_id, r.offset)):
        ids.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
    at = [sum(n for _, n, _ in x) for _, x in sorted(ids.items())]
    assert all(n == 2048 for n in at[:-1])
    total = sum(len(LIBRARY.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in pairs)
    assert sum(at) == total


def test_stages_on_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near-duplicates", "repeated-passages", "packing"]
    good = stages["quality"](spark, docs, SF)
    assert good.dtypes == docs.dtypes
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    ones, zeros = [d for d, q in labels.items() if q == 1], [d for d, q in labels.items() if q == 0]
    assert np.mean([d in kept for d in ones]) > 0.95 and np.mean([d in kept for d in zeros]) < 0.5
    single = stages["near-duplicates"](spark, good, SF)
    assert single.dtypes == docs.dtypes
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert pairs_of(single) == sorted(((str(i), t) for i, t in survivors(rows)), key=str)
    passages = stages["repeated-passages"](spark, single, SF)
    assert passages.dtypes == docs.dtypes
    rows = [(r.doc_id, r.text) for r in single.collect()]
    want = sorted(((str(i), t) for (i, _), t in zip(rows, removed([t for _, t in rows]))), key=str)
    assert pairs_of(passages) == want
    assert all(r.n_chars == len(r.text) for r in passages.collect())
    check_pieces(stages["packing"](spark, passages, SF), want)


def test_run(spark):
    pieces = corpus_pipeline.run(spark, SF)
    assert pieces.count() > 0 and {"doc_id", "sequence_id", "offset", "ids"} <= set(pieces.columns)


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, make_docs, odd_pairs, empty):
    pairs = [] if empty else odd_pairs + [(50, " ".join(f"a{i}" for i in range(90)))] * 2
    docs = make_docs(pairs, parts=1, bits=T.StringType(), score=T.StringType(), kept=T.LongType(), part=T.StringType())
    single = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert single.columns == docs.columns
    assert pairs_of(single) == sorted(((str(i), t) for i, t in survivors([(r.doc_id, r.text) for r in docs.collect()])), key=str)
    good = corpus_pipeline.good_quality(spark, docs, SF)
    passages = corpus_pipeline.repeated_passages(spark, docs, SF)
    assert good.columns == passages.columns == docs.columns
    assert set(pairs_of(good)) <= set(pairs_of(docs))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert pairs_of(passages) == sorted(((str(i), t) for (i, _), t in zip(rows, removed([t for _, t in rows]))), key=str)
    check_pieces(corpus_pipeline.pack(spark, docs, SF), rows)


def test_one_of_each_keeps_ties_apart(make_docs):
    docs = make_docs([(4, "alpha beta gamma delta"), (4, "one two three four five"), (4, "alpha beta gamma delta"),
                      (None, "alpha beta gamma delta"), (None, "nothing like the rest")], parts=1)
    got = sorted(((str(r.doc_id), r.text) for r in simhash.one_of_each(docs).collect()))
    assert got == [("4", "alpha beta gamma delta"), ("4", "one two three four five"), ("None", "nothing like the rest")]
