import hashlib
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from reelkpi.llm import imatch


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def spark_hash(*values, seed=42):
    """xxhash64 of strings, longs, ints, lists of longs: each one's hash seeds the next."""
    for v in values:
        items = v if isinstance(v, list) else [v]
        for x in items:
            if isinstance(x, str):
                data = x.encode()
            else:
                data = struct.pack("<q", x) if isinstance(x, int) and not isinstance(x, Small) else struct.pack("<i", x)
            seed = xxhash.xxh64_intdigest(data, seed)
    return signed(seed)


class Small(int):
    """A 32-bit literal."""


def terms(text):
    return set(re.split(r"[\t-\r ]+", text.lower())) | {""}


def brute(pairs, subsets=imatch.SUBSETS, least=imatch.LEAST_SHARE, greatest=imatch.GREATEST_SHARE, upper=imatch.UPPER):
    docs = [(i, t or "") for i, t in pairs]
    df = Counter(t for _, text in docs for t in terms(text))
    members = {}
    for t, n in df.items():
        if t and least * len(docs) <= n:
            above, h = n > greatest * len(docs), spark_hash(t)
            of = [k for k, m in enumerate(upper if above else subsets) if spark_hash(h, Small(64 * above + k)) % m == 0]
            members[t] = ((h >> 48 << 48) + (above << 47) + sum(1 << k for k in of), above, of)

    def values(text):
        own = sorted({members[t][0]: members[t] for t in terms(text) if t in members and members[t][2]}.values())
        if not own:
            return [max(1, spark_hash(text) & 0xFFFFFFFF)] * (len(subsets) + len(upper))
        n_above = sum(above for _, above, _ in own)
        few, out = 4 * (len(own) - n_above) < n_above, []
        for part, sizes in enumerate((subsets, upper)):
            for k in range(len(sizes)):
                held = [h for h, above, of in own if above == part and k in of and not (few and not above)]
                out.append(max(1, spark_hash(held) & 0xFFFFFFFF) if held else 0)
        return out

    def near(a, b):
        n = len(subsets)
        a, b = (a[:n], b[:n]) if any(a[:n]) and any(b[:n]) else (a[n:], b[n:])
        either = sum(1 for x, y in zip(a, b) if x or y)
        return sum(1 for x, y in zip(a, b) if x == y != 0) / either if either else 1.0

    digest = {d: hashlib.md5(f"{'null' if d[0] is None else d[0]}:{d[1]}".encode()).hexdigest() for d in docs}
    order = sorted(set(docs), key=lambda d: (d[0] is None, -(d[0] or 0), digest[d]))
    out = []
    for d in docs:
        text, after = d[1], order[(order.index(d) + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = values(text), values(edited), values(after)
        out.append((str(d[0]), len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    "".join(f"{x:08x}" for x in a), "".join(f"{x:08x}" for x in b), near(a, b), near(a, c)))
    return sorted(out)


def collected(df):
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited,
                   r.near_next) for r in df.collect())


@pytest.mark.parametrize("broadcast_rows", [imatch.BROADCAST_ROWS, 0])
def test_odd_rows(make_docs, odd_pairs, broadcast_rows):
    pairs = odd_pairs + [(200 + i, f"alpha beta{i % 5} gamma{i % 3} delta 𝒳{i} tail") for i in range(30)]
    docs = make_docs(pairs, term=T.LongType(), key=T.StringType(), entry=T.StringType(), values=T.StringType())
    got = imatch.compare_edited(docs, subsets=(1, 2, 3, 4), least=0.02, greatest=0.6, upper=(1, 2),
                                broadcast_rows=broadcast_rows)
    assert collected(got) == brute(pairs, (1, 2, 3, 4), 0.02, 0.6, (1, 2))


def test_one_and_no_document(make_docs):
    assert collected(imatch.compare_edited(make_docs([(1, "abc def")]))) == brute([(1, "abc def")])
    assert imatch.compare_edited(make_docs([])).collect() == []


def test_query_on_given_table(spark):
    from reelkpi.llm.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op7_imatch"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert collected(rows) == brute([tuple(d) for d in docs])


def test_no_python_in_the_plan(spark):
    from reelkpi.llm.registry import QUERIES

    plan = QUERIES["op7_imatch"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_likeness_tells_edited_from_unrelated(spark):
    from reelkpi.llm.registry import QUERIES

    rows = QUERIES["op7_imatch"](spark, "/root/testdata/sf0.01").collect()
    assert np.mean([r.near_edited for r in rows]) > np.mean([r.near_next for r in rows]) + 0.05


def test_hot_near_copies_keep_their_likeness(make_docs):
    """A third of the rows are near copies of one text, with one word of their own
    each, apart or among other documents: no half-edited text loses all likeness."""
    rng = np.random.default_rng(5)
    common = [f"often{i}" for i in range(60)]
    hot = [f"hot{i}" for i in range(120)]
    pairs = []
    for i in range(600):
        if i % 3 == 0 if i < 300 else i < 400:
            words = list(hot)
            words[int(rng.integers(0, 120))] = f"own{rng.integers(0, 40)}"
        else:
            words = [f"word{rng.integers(0, 3000)}" for _ in range(90)] + [common[k] for k in rng.integers(0, 60, 40)]
            rng.shuffle(words)
        pairs.append((i, " ".join(words)))
    rows = {r.doc_id: r for r in imatch.compare_edited(make_docs(pairs)).collect()}
    is_hot = {i for i, t in pairs if "hot" in t}
    assert len(is_hot) == 200
    # next to one another they are near; beside other documents half of a text is left
    assert all(rows[i].near_next > 0.3 for i in is_hot if i - 1 in is_hot)
    assert np.mean([rows[i].near_edited > 0 for i in is_hot]) > 0.95
    assert np.mean([rows[i].near_next for i in is_hot if i - 1 not in is_hot]) < 0.05


def test_few_edited_texts_lose_all_likeness(spark):
    from reelkpi.llm.registry import QUERIES

    rows = QUERIES["op7_imatch"](spark, "/root/testdata/sf0.1").collect()
    assert np.mean([r.near_edited == 0 for r in rows]) < 0.05
    assert np.mean([r.near_next for r in rows]) < 0.005
