"""Collocations against counting every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from reelkpi.llm import collocations
from reelkpi.llm.registry import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, most=4, top=2000, cover=80):
    """Rows of the result from (lang, text)."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        f = counts["und" if lang is None else lang]
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            f.update(tuple(words[i:i + s]) for s in range(1, most + 1) for i in range(len(words) - s + 1))
    out = []
    for lang, f in counts.items():
        cands = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        covered = set()
        for g, a in cands.items():
            covered |= {s for size in range(2, len(g)) for i in range(len(g) - size + 1)
                        if 100 * a >= cover * cands[s := g[i:i + size]]}
        scored = []
        for g, a in cands.items():
            if g not in covered:
                score, k = min((2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        n = sum(c for g, c in f.items() if len(g) == 1)
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def found(spark, rows, parts=3, **how):
    df = spark.createDataFrame([(i, *r, "clash", 5) for i, r in enumerate(rows)],
                               "doc_id long, lang string, text string, phrase string, n int").repartition(parts)
    return sorted(tuple(r) for r in collocations.collocations(df, **how).collect())


def _texts(n, seed, words=12, langs=("en", "fr", None)):
    rnd = random.Random(seed)
    vocab = [f"{rnd.choice(['Été', 'a', 'Bb', 'x-y', 'don’t', '☃'])}{i}" for i in range(words)]
    out = []
    for _ in range(n):
        text = "".join(rnd.choice(vocab[:rnd.randint(2, words)]) + rnd.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\r\n", "\x0b"])
                       for _ in range(rnd.randint(0, 60)))
        out.append((rnd.choice(langs), text))
    return out


@pytest.mark.parametrize("shard,ranges", [(1 << 20, 1 << 22), (20, 50)])
def test_equal_to_counting(spark, monkeypatch, shard, ranges):
    """In one shard a language and task, and in many small ones with many ranges of keys."""
    monkeypatch.setattr(collocations, "SHARD", shard)
    monkeypatch.setattr(collocations, "RANGE", ranges)
    rows = _texts(150, 1) + [("en", "one very common line, again and again")] * 80
    assert found(spark, rows, least=5) == brute(rows, 5)
    assert found(spark, rows, least=3, top=7) == brute(rows, 3, top=7)


@pytest.mark.parametrize("most,cover", [(2, 80), (3, 100), (5, 50), (7, 80)])
def test_other_lengths(spark, most, cover):
    rows = _texts(60, most, words=4) + [("en", "a b a b a b a b a b a b a")] * 9
    assert found(spark, rows, least=4, most=most, cover=cover) == brute(rows, 4, most=most, cover=cover)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 50} and the" for i in range(30000))
    rows = [(None, None), ("en", ""), ("en", " \t\n.,;"), ("und", "x y z " * 40), (None, "x y z " * 40), ("en", long), ("", "p q " * 31),
            ("en", "A a A a"), ("de", "ÄB äb. " * 35), ("de", "nul\x00byte \x1cx " * 33)]
    assert found(spark, rows, least=30) == brute(rows, 30)


def test_empty_and_refused(spark):
    assert found(spark, []) == []
    assert found(spark, [("en", "too few words")]) == []
    with pytest.raises(ValueError):
        collocations.collocations(spark.createDataFrame([], "text string, lang string"), most=1)


def test_ties_in_byte_order(spark):
    rows = [("en", ". ".join(["é z", "e z2", "~ q", "☃ r", "\U0001f600 s"]))] * 30
    got = found(spark, rows, top=3)
    assert [r[2] for r in got] == ["e z2", "~ q", "é z"] and got == brute(rows, 30, top=3)


def test_arithmetic_beyond_64_bits(spark):
    """The score's expression at counts whose product passes 64 bits."""
    a = 9_000_000_000_000_001
    expr = f"cast(cast({collocations.SCALE} as decimal(18,0)) * cast(a as decimal(20,0)) div cast(l + r as decimal(20,0)) as long) as s"
    got = spark.createDataFrame([(a, a + 1, a + 5)], "a long, l long, r long").selectExpr(expr).first().s
    assert got == 2000000 * a // (2 * a + 6)


@pytest.mark.parametrize("depth", [2, 3, 4, 5, 6, 9])
def test_index_gives_every_interval(depth):
    """Phrases and counts by extension of intervals, against a scan of the text."""
    rnd = np.random.default_rng(depth)
    ids = np.concatenate([[0], rnd.integers(0, 4, 400), [0]]).astype(np.int32)
    here = collocations.Index(collocations.transform(ids, depth))
    rows, known = here.words(), {(w,): int((ids == w).sum()) for w in range(1, 4)}
    names = [(1,), (2,), (3,)]
    for size in range(2, depth + 1):
        rows, head, last, n = here.extend(rows)
        names = [names[h] + names[x][-1:] for h, x in zip(head, last)]
        known.update(zip(names, n.tolist()))
        text = ids.tolist()
        want = Counter(tuple(text[i:i + size]) for i in range(len(text) - size + 1) if 0 not in text[i:i + size])
        assert {g: c for g, c in known.items() if len(g) == size} == dict(want)


def test_query_on_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op12_collocations"](spark, sf)
    assert got.schema.simpleString() == ("struct<lang:string,rank:bigint,phrase:string,a:bigint,l:bigint,r:bigint,n:bigint,score:bigint>")
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 30)
