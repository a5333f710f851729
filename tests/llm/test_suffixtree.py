import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelkpi.llm import suffixtree as st
from reelkpi.llm.registry import QUERIES

END = "</end>"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0d]+", low) if w] + [END]


class BruteTree:
    """The same model, with dictionaries of tuples."""

    def __init__(self, texts, depth=st.DEPTH):
        rows = [tokens(t) for t in texts]
        self.words = Counter(w for r in rows for w in r)
        self.n, self.v = sum(self.words.values()), len(self.words)
        least = max(st.LEAST_COUNT, st.LEAST_SHARE * self.n)
        self.grams = [{}, {(w,): n for w, n in self.words.items() if n >= least}]
        for size in range(2, depth + 2):
            found = Counter()
            for r in rows:
                r = [END, *r]
                for i in range(len(r) - size + 1):
                    g = tuple(r[i:i + size])
                    if g[:-1] in self.grams[-1] and g[1:] in self.grams[-1]:
                        found[g] += 1
            self.grams.append({g: n for g, n in found.items() if n >= least})
        self.states = {}
        for size in range(2, depth + 2):
            by = {}
            for g, n in self.grams[size].items():
                by.setdefault(g[:-1], {})[g[-1]] = n
            new = {}
            for s, next_ in by.items():
                total = self.grams[size - 1][s]
                lower = {w: self.p(w, s[1:]) for w in next_}
                gain = sum(n * math.log(n / total / lower[w]) for w, n in next_.items())
                left = total - sum(next_.values())
                if left > 0:
                    gain += left * math.log(left / total / max(1 - sum(lower.values()), 1e-12))
                if gain > st._quantile_95(np.array([len(next_)]))[0] / 2:
                    new[s] = next_
            self.states.update(new)

    def p(self, w, context):
        if not context:
            return (self.words.get(w, 0) + 1) / (self.n + self.v + 1)
        if context not in self.states:
            return self.p(w, context[1:])
        total, next_ = self.grams[len(context)][context], self.states[context]
        rest = 1 - sum((n - st.DISCOUNT) / total for n in next_.values())
        own = (next_[w] - st.DISCOUNT) / total if w in next_ else 0
        return own + rest * self.p(w, context[1:])

    def score(self, text, depth=st.DEPTH):
        r = [END, *tokens(text)]
        return sum(math.log10(self.p(r[i], tuple(r[max(0, i - depth):i]))) for i in range(1, len(r)))

    def base(self, text):
        return sum(math.log10(self.p(w, ())) for w in tokens(text))


def check(rows, pairs, learnt, depth=st.DEPTH):
    tree = BruteTree(learnt, depth)
    want = sorted((str(i), len(tokens(t)), sum(w in tree.words for w in tokens(t)), tree.n, round(tree.base(t), 6),
                   round(tree.score(t, depth), 6)) for i, t in pairs)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                 for r in rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], atol=2e-6)
    return tree


def test_query_like_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in pairs}
    rows = QUERIES["op1_suffix_tree"](spark, sf).collect()
    assert all(r.held_out == held[r.doc_id] for r in rows)
    tree = check(rows, pairs, [t for i, t in pairs if not held[i]])
    assert {len(s) for s in tree.states} == {1, 2, 3}


def test_held_out_texts_gain(spark):
    rows = [r for r in QUERIES["op1_suffix_tree"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) * 0.97


@pytest.mark.parametrize("depth,block,texts,range_bytes", [
    (1, 1 << 20, 1 << 15, 12 << 20), (2, 1 << 20, 1 << 15, 12 << 20), (3, 700, 5, 4000), (2, 64, 3, 20000)])
def test_odd_rows(make_docs, odd_pairs, monkeypatch, depth, block, texts, range_bytes):
    """Also with small blocks, into which texts are cut, and many ranges."""
    monkeypatch.setattr(st, "BLOCK", block)
    monkeypatch.setattr(st, "BLOCK_TEXTS", texts)
    more = [(300 + i, "the cat sat on the mat and the dog sat on the log " * 3) for i in range(9)]
    pairs = odd_pairs + more
    docs = make_docs(pairs, word=T.StringType(), n=T.StringType(), rare=T.LongType(), part=T.StringType())
    learn = F.col("doc_id") % 2 == 0
    check(st.score_texts(docs, learn, depth, range_bytes=range_bytes).collect(), pairs, [t for i, t in pairs if i is not None and i % 2 == 0], depth)


def test_distributions_sum_to_one(make_docs):
    texts = ["a b a b c a b", "b a a c b a", "a b a b", "c c a b"] * 3
    tree = BruteTree(texts)
    for s in [(), *tree.states]:
        known = sum(tree.p(w, s) for w in tree.words)
        assert abs(known + tree.p("?", s) - 1) < 1e-9


def test_no_training_rows_and_empty_table(make_docs):
    rows = st.score_texts(make_docs([(1, "a b"), (None, "c")]), F.col("doc_id") > 5).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.score, r.base_score) for r in rows) == \
        [(2, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert st.score_texts(make_docs([]), F.col("doc_id") > 5).collect() == []


def test_tree_grows_with_the_corpus(make_docs):
    """Strings that occur twice are kept however many tokens there are."""
    rng = np.random.default_rng(3)
    pairs = [(2 * i, " ".join(f"w{x}" for x in rng.integers(0, 40_000, 400))) for i in range(1, 10_600)]
    told = [f"key{i} lock{i} door{i} room{i}" for i in range(50)]
    pairs += [(2 * (20_000 + i), f"{t} x{i} {t}") for i, t in enumerate(told)]
    held = [(2 * (30_000 + i) + 1, t) for i, t in enumerate(told)]
    rows = st.score_texts(make_docs(pairs + held), F.col("doc_id") % 2 == 0).where("doc_id % 2 = 1").collect()
    assert rows[0].train_tokens * 5e-7 > 2.1 and len(rows) == 50
    assert min(r.score - r.base_score for r in rows) > 6  # three words each that their states foretell


def test_texts_are_cut_into_words_once(make_docs, monkeypatch, tmp_path):
    """Later passes read the numbered blocks, not the texts."""
    cut = st._sequences

    def noted(texts):
        with open(tmp_path / "cut", "a") as f:
            f.writelines(t + "\n" for t in texts)
        return cut(texts)

    monkeypatch.setattr(st, "_sequences", noted)
    pairs = [(i, f"a b c w{i} a b c d") for i in range(40)]
    check(st.score_texts(make_docs(pairs), F.col("doc_id") % 3 > 0).collect(), pairs, [t for i, t in pairs if i % 3])
    assert sorted((tmp_path / "cut").read_text().split("\n")[:-1]) == sorted(t for _, t in pairs)


def test_order_sums_and_values_like_plain_ones():
    rng = np.random.default_rng(5)
    columns = [rng.integers(0, 3, 500) for _ in range(5)]
    order = st._order(columns, [1 << 30] * 5)  # two to a key
    assert (np.stack(columns)[:, order] == np.stack(columns)[:, np.lexsort(columns[::-1])]).all()
    keys, n, some = rng.integers(0, 300, 500) << 40, rng.integers(0, 3, 500), rng.random(500) < 0.7
    want = {k: n[(keys == k) & some].sum() for k in np.unique(keys)}
    want = {k: x for k, x in want.items() if x >= st.LEAST_COUNT}
    key, total, first = st._summed(keys, n, some)
    assert dict(zip(key.tolist(), total.tolist())) == want and (keys[first] == key).all() and some[first].all()
    told = st.Values(key, total.astype(float))
    wanted = np.append(keys, [7, 1 << 50])
    assert told.of(wanted)[0].tolist() == [want.get(k, 0) for k in wanted.tolist()]
    assert st.Values(key[:0], total[:0]).of(wanted)[0].tolist() == [0] * len(wanted)


def test_rounds_share_out_the_places(make_docs):
    """A pass of one round works on the places of that round alone, and no place is left out."""
    pairs = [(i, f"a b c w{i % 7} a b d x{i}") for i in range(40)]
    cut = st.cut_texts(make_docs(pairs).select("doc_id", "text", (F.col("doc_id") % 3 > 0).alias("learn")), 3)
    shared = [0] * st.ROUNDS
    for r in st.numbered_texts(cut, st.number_words(cut, 3), 3).collect():
        word, _, token, _ = st.unpacked(bytes(r.data), 4)
        places = [st.unpacked(bytes(p), 1)[0] for p in r.places]
        every = np.flatnonzero(token)
        assert sorted(np.concatenate(places)) == every[word[every - 1] > st.ONCE].tolist()
        for k, own in enumerate(places):
            assert (st._part(word[own - 1], st.ROUNDS) == k).all()
            told = [st.unpacked(t, 9)[-1] for _, t in st.tries(r.data, r.places[k], np.ones(40, bool), 3, 5, True)]
            taken = own[np.where(token[own - 1], word[np.maximum(own - 2, 0)], 0) > st.ONCE]
            assert sum(map(len, told)) == len(taken)
            shared[k] += len(own)
    assert min(shared) > 0


def test_sorted_places_of_keys_that_share_high_bits():
    rng = np.random.default_rng(11)
    near = (rng.integers(0, 40, 3000) << 55) + rng.integers(0, 5, 3000)
    for keys in (near, rng.integers(0, 1 << 63, 700), rng.integers(0, 9, 100), near + 1, np.zeros(0, np.int64), np.array([st.END])):
        assert st._sorted_places(keys).tolist() == np.argsort(keys, kind="stable").tolist()
        distinct, code = st._distinct(keys)
        assert distinct.tolist() == sorted(set(keys.tolist())) and (distinct[code] == keys).all()
