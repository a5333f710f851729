import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelkpi.llm import common


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-(1 << 62), 1 << 62), max_size=200), max_size=6), st.lists(st.integers(-50, 50)))
def test_places_grow(parts, others):
    places, want = common.Places(np.zeros(0, np.int64)), {}
    for part in parts:
        new = [k for k in dict.fromkeys(part) if k not in want]
        want.update(zip(new, range(len(want), len(want) + len(new))))
        places.add(np.array(new, dtype=np.int64))
    asked = [*want, *others]
    got = places.find(np.array(asked, dtype=np.int64))
    assert got.tolist() == [want.get(k, -1) for k in asked]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aAbBÉé \t\n\x0b\x1c\x85z", max_size=30), max_size=6))
def test_word_keys(texts):
    keys, counts = common.word_keys(texts)
    words = [w for t in texts for w in re.split(rb"[\x20\x09-\x0d]+", t.encode()) if w]
    assert counts.tolist() == [len([w for w in re.split(rb"[\x20\x09-\x0d]+", t.encode()) if w]) for t in texts]
    small = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    by = {}
    assert all(by.setdefault(w, k) == k for w, k in zip(small, keys.tolist()))
    assert len(set(by.values())) == len(by) and (keys >= 0).all()


def test_partition_bases(spark):
    rows = [(p, n) for p in (0, 3, 7) for n in (1, 2, 3)]
    got = common.partition_bases(spark.createDataFrame(rows, "part int, n long"), "part", "n").collect()
    assert sorted(map(tuple, got)) == [(0, 0), (3, 6), (7, 12)]


def test_small_batches_keep_a_smaller_setting(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for given_, want in (("10000", "512"), ("0", "512"), ("7", "7")):
            spark.conf.set(key, given_)
            common.small_batches(spark)
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("sizes", [[0], [1, 2], [3 << 20, 5, 5]])
def test_text_slices_cover_all_rows(sizes):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([None if n == 5 else "x" * n for n in sizes], pa.string())], ["text"])
    found = [(first + i, t) for first, texts in common.text_slices(batch) for i, t in enumerate(texts)]
    assert found == [(i, "" if n == 5 else "x" * n) for i, n in enumerate(sizes)]
