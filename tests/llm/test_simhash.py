import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from reelkpi.llm import simhash
from reelkpi.llm.components import components


def brute_bits(text, n=3):
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0d]+", (text or "").encode()) if w]
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(ids_bits, distance=3):
    """component id of each row, all pairs compared."""
    bits = sorted({b for _, b in ids_bits})
    parent = {b: b for b in bits}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    array = np.array(bits, dtype=np.uint64)
    for i, b in enumerate(bits):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1:] ^ np.uint64(b)) <= distance):
            parent[root(bits[i + 1 + j])] = root(b)
    least = {}
    for d, b in ids_bits:
        r = root(b)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return sorted(((str(d), b, least.get(root(b))) for d, b in ids_bits), key=str)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ABab éÉ\t\n\x0b\x1c\x85z", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == brute_bits(text)


def planted(rng, n, spread):
    base = rng.integers(0, 1 << 63, size=max(1, n // spread), dtype=np.uint64) * np.uint64(2)
    out = []
    for _ in range(n):
        x = int(rng.choice(base))
        for b in rng.integers(0, 64, size=int(rng.integers(0, 5))):
            x ^= 1 << int(b)
        out.append(x)
    return out


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_segments_meet(distance):
    assert sum(n for _, n in simhash.segments(distance)) == 64
    assert len(simhash.segments(distance)) == distance // 2 + 1


@pytest.mark.parametrize("distance,big", [(3, simhash.BIG), (3, 4), (2, 3), (1, simhash.BIG)])
def test_links_keep_components(spark, distance, big):
    rng = np.random.default_rng(7)
    bits = list(dict.fromkeys(planted(rng, 300, 20) + planted(rng, 120, 120)))
    signed = [(b - (1 << 64) if b >> 63 else b,) for b in bits]
    found = components(simhash.links(spark.createDataFrame(signed, "bits long"), distance, big)).collect()
    root = {r.node % (1 << 64): r.root % (1 << 64) for r in found}
    got = {}
    for b in bits:
        got.setdefault(root.get(b, b), set()).add(b)
    want = {}
    ids = {str(i): b for i, b in enumerate(bits)}
    for s, b, c in brute_components([(i, b) for i, b in enumerate(bits)], distance):
        want.setdefault(c, set()).add(ids[s])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("distance,half", [(3, 32), (3, 0), (2, 32)])
def test_big_buckets_become_small(spark, distance, half):
    """Nodes with one equal half, of all of which some variant's bucket consists:
    dealt out, no bucket is big any more, and the components are those of all pairs."""
    rng = np.random.default_rng(5)
    other = rng.choice(1 << 32, 2000, replace=False).tolist()
    other += [x ^ (1 << int(b)) for x in other[:300] for b in rng.integers(0, 32, 1)]
    bits = list(dict.fromkeys(0x1234567 | x << 32 if half else 0x89ABCDEF << 32 | x for x in other))
    nodes = spark.createDataFrame([(b - (1 << 64) if b >> 63 else b,) for b in bits], "bits long")
    big = 60
    assert simhash.variants(nodes, distance).groupBy("place", "value").count().agg({"count": "max"}).first()[0] > 1900
    assert simhash.buckets(nodes, distance, big).groupBy("place", "value").count().agg({"count": "max"}).first()[0] <= big
    found = components(simhash.links(nodes, distance, big)).collect()
    root = {r.node % (1 << 64): r.root % (1 << 64) for r in found}
    got, want = {}, {}
    for b in bits:
        got.setdefault(root.get(b, b), set()).add(b)
    ids = {str(i): b for i, b in enumerate(bits)}
    for s, _, c in brute_components(list(enumerate(bits)), distance):
        want.setdefault(c, set()).add(ids[s])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_operator_on_odd_rows(make_docs, odd_pairs):
    near = [(100 + i, " ".join(f"w{j}" if j != 5 * i else "changed" for j in range(400))) for i in range(12)]
    docs = make_docs(odd_pairs + near, bits=T.StringType(), component_id=T.StringType(), part=T.LongType())
    got = sorted(((str(r.doc_id), r.bits % (1 << 64), r.component_id)
                  for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == brute_components([(i, brute_bits(t)) for i, t in odd_pairs + near])


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == []


def test_chain_of_components(spark):
    pairs = [(i, i + 1) for i in range(0, 60) if i % 20 != 19]
    found = components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert all(r.root == r.node // 20 * 20 for r in found) and len(found) == 57


def test_query_on_given_table(spark):
    from reelkpi.llm.registry import QUERIES

    rows = QUERIES["op6_simhash"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = sorted(((str(r.doc_id), int(r.fingerprint, 16), r.component_id) for r in rows), key=str)
    assert got == brute_components([(d.doc_id, brute_bits(d.text)) for d in docs])
    assert all(len(r.fingerprint) == 16 for r in rows)
