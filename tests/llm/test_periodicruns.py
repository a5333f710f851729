"""Periodic runs against a scan of every period."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelkpi.llm import periodicruns
from reelkpi.llm.registry import QUERIES


def brute(words, min_length=24, exponent=3):
    """All runs: for each period the longest stretches that keep it and have none smaller."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, exponent * q) and j > i:
                own = words[i:i + length]
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def check(texts, **how):
    got = periodicruns.text_runs([" ".join(t).encode() for t in texts], **how)
    assert got == [brute(t, **how) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), min_size=1, max_size=4), st.integers(1, 12), st.integers(3, 5))
def test_two_words(texts, min_length, exponent):
    check(texts, min_length=min_length, exponent=exponent)


def test_made_of_repeats():
    rnd = random.Random(4)
    texts = []
    for _ in range(120):
        words = []
        while len(words) < rnd.choice([30, 100, 400]):
            unit = [rnd.choice("abcdef") for _ in range(rnd.randint(1, 14))]
            words += (unit * rnd.randint(1, 9))[:rnd.randint(1, 90)]
            if rnd.random() < 0.3:
                words.insert(rnd.randrange(len(words)), "x")
        texts.append(words)
    check(texts)
    check(texts, min_length=10)
    check(texts, min_length=25, exponent=4)


def test_runs_inside_runs_and_one_word():
    unit = ["a"] * 24 + ["b"]
    check([unit * 4, ["a"] * 5000, ["a"] * 23, ["a"] * 24, [], ["w"], (["a", "b"] * 12 + ["c"]) * 3, [f"w{i % 700}" for i in range(2099)],
           [f"w{i % 700}" for i in range(2100)], ["x"] + ["y", "z"] * 20 + ["y", "y"]])


def expected(rows):
    """Rows of the query by the brute force, from (doc_id, text)."""
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        n, g = len(words), h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        best = None
        for r in runs:  # by start and period: only a greater exponent wins
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        out.append((doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                    hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run_query(spark, rows, tmp_path, schema="doc_id long, text string, runs string, best int"):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(*r, "clash", 1) for r in rows], schema).repartition(3).write.parquet(path)
    return sorted((tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()), key=repr)


def test_query_on_odd_rows(spark, odd_pairs, tmp_path):
    pairs = [(i, t if t is None or len(t) < 20000 else t[:6000]) for i, t in odd_pairs]
    line = "one line that comes again\n"
    pairs += [(100 + i, line * k + "tail " * (i % 30)) for i, k in enumerate([1, 2, 3, 5, 9, 40] * 12)]
    got = run_query(spark, pairs, tmp_path)
    assert got == expected(pairs)
    assert sum(r[1] > 0 for r in got) > 20


def test_empty_table(spark, tmp_path):
    assert run_query(spark, [], tmp_path) == []


def test_long_text_of_copies(spark, tmp_path):
    """A long text, beyond a slice, in which a third is one passage again and again."""
    rnd = random.Random(1)
    passage = " ".join(rnd.choice(["alpha", "beta", "gamma"]) + str(rnd.randint(0, 99)) for _ in range(80))
    text = " ".join([f"u{i}" for i in range(90000)] + [passage] * 500 + [f"v{i}" for i in range(60000)])
    ((_, runs, start, length, period, milli, *_),) = run_query(spark, [(2, text)], tmp_path)
    assert (runs, start, length, period, milli) == (1, 90000, 40000, 80, 500000)


def test_query_on_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op11_periodic_runs"](spark, sf)
    assert got.schema.simpleString() == ("struct<doc_id:bigint,n_runs:bigint,start:bigint,length:bigint,period:bigint,"
                                         "exponent_milli:bigint,runs_sha256:string,collapsed_sha256:string>")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_exponents_below_three_are_refused(spark):
    with pytest.raises(ValueError):
        periodicruns.find_runs(spark.range(1), exponent=2)
