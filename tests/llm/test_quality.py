import zlib

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelkpi.llm import quality

SF = "/root/testdata/sf0.01"


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_held_out_quality(spark):
    from reelkpi.llm.registry import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op10_quality"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(rows[x.doc_id].score, x.quality) for x in labels if rows[x.doc_id].held_out]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert len(good) > 50 and len(bad) > 10
    assert np.mean([g > b for g in good for b in bad]) > 0.97  # area under the curve
    assert np.mean([s >= 0.5 for s in good]) > 0.95
    assert np.mean([s < 0.5 for s in bad]) > 0.7


def test_negative_labels_are_not_used(spark, make_docs):
    """Only positives teach: the scores stay when the zeros change or go."""
    docs = make_docs([(i, f"plain words go here {i} and on" if i % 3 else f"X!!{i} *** ||| $$ !!") for i in range(90)])
    ones = [(i, 1) for i in range(90) if i % 3 and i % 2]
    a = quality.classify(docs, labels_frame(spark, ones), F.lit(True)).orderBy("doc_id").collect()
    zeros = [(i, 0) for i in range(0, 90, 3)] + [(5000, 1), (None, 1), (7, None)]
    b = quality.classify(docs, labels_frame(spark, ones + zeros), F.lit(True)).orderBy("doc_id").collect()
    assert np.allclose([r.score for r in a], [r.score for r in b], atol=0.2)


def test_fold_teaches_nothing_of_held_out_rows(spark, make_docs):
    docs = make_docs([(i, "some words " * (i % 7 + 1)) for i in range(60)])
    learn = F.col("doc_id") < 40
    a = quality.classify(docs, labels_frame(spark, [(i, 1) for i in range(0, 60, 2)]), learn)
    b = quality.classify(docs, labels_frame(spark, [(i, 1) for i in range(0, 40, 2)] + [(i, 0) for i in range(40, 60)]), learn)
    assert a.orderBy("doc_id").collect() == b.orderBy("doc_id").collect()


def test_prior_estimate():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(0, 1, (6000, 5)), rng.normal(2.5, 1, (1000, 5))
    unlabelled = rng.permutation(np.concatenate([good[3000:], bad]))
    assert abs(quality.estimate_prior(good[:3000], unlabelled) - 0.75) < 0.08


def test_odd_rows_extra_columns(spark, make_docs, odd_pairs):
    docs = make_docs(odd_pairs, score=T.StringType(), quality=T.LongType(), x=T.StringType(), kind=T.StringType())
    rows = quality.classify(docs, labels_frame(spark, [(7, 1), (4, 1), (4, 1), (9, 0), (None, None)]), F.lit(True),
                            keep=("score", "text")).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in odd_pairs)
    assert all(0 <= r[1] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", r[1]) == r[1]  # equal texts, equal scores


def test_no_positives_and_empty_tables(spark, make_docs, odd_pairs):
    rows = quality.classify(make_docs(odd_pairs), labels_frame(spark, [(7, 0)]), F.lit(True)).collect()
    assert {r.score for r in rows} == {0.5}
    assert quality.classify(make_docs([]), labels_frame(spark, []), F.lit(True)).collect() == []


def test_repeated_ids_stay_out_of_the_driver(spark, make_docs, monkeypatch):
    """All rows of a sampled id have features, and one of them is collected."""
    docs = make_docs([(1, f"Text number {i}, of one id.") for i in range(60)] + [(2, "Another text."), (3, "A third one.")])
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    collect, seen = type(docs).toPandas, []

    def counted(df):
        seen.append(collect(df))
        return seen[-1]

    monkeypatch.setattr(type(docs), "toPandas", counted)
    good, rest = quality.training_rows(docs.select("doc_id", "text"), labels, F.lit(True), 10, 10)
    assert (len(good), len(rest)) == (2, 3)
    assert [len(x) for x in seen if "x" in x.columns] == [5]
