"""Quality scores by positive-unlabelled learning.

The only labels used are trusted positives. Web text without labels is a blend
of `prior` good and 1 - prior bad texts, so the risk on bad texts is what is
left of the unlabelled risk when the positives' part is taken away:

    risk = prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

(non-negative unbiased risk; where the second part of a batch falls below zero,
its gradient is turned round). The loss is logistic, so the sigmoid of the
model's output estimates the chance of label 1. The model is one hidden layer
over style features of the whole text (bytes, words, lines, repetition).

The prior is estimated from positives and unlabelled rows too: a classifier
tells the two apart, and on rows it has not seen the smallest ratio of
unlabelled to positive mass above a threshold (with the sampling error of both
added) bounds the share of good texts (`estimate_prior`).

Scale: the model is fitted in the driver on at most MOST_POSITIVES and
MOST_UNLABELLED rows, those of least id hash; both are parameters, the only
bound here, and chosen on ids alone before any text is read. Scoring is one
narrow pass over all texts.

Defined results: a null, empty or blank text has the features of no words and
gets a score like any other; every row gives one row; a null id has no fold and
is not held out; labels that are null or of unknown ids are not used; without
any positive every score is 0.5; an empty table gives no row; extra columns are
left out.
"""

from __future__ import annotations

import zlib
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkpi.llm.common import keyed_texts, text_slices

MOST_POSITIVES, MOST_UNLABELLED = 8_000, 16_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 60, 512, 3e-3, 1e-4

# classes of bytes: 1 small letter, 2 capital, 3 digit, 4 space, 5 sentence mark, 6 other mark, 0 beyond ASCII
CLASS = np.zeros(256, np.uint8)
CLASS[97:123], CLASS[65:91], CLASS[48:58] = 1, 2, 3
CLASS[[9, 10, 11, 12, 13, 32]] = 4
CLASS[[ord(c) for c in ".,;:'\"-?()"]] = 5
CLASS[[b for b in range(33, 127) if CLASS[b] == 0]] = 6
MARKS = [b for b in range(33, 127) if CLASS[b] in (5, 6)]
N_FEATURES = 17 + len(MARKS)


def features(text: str) -> np.ndarray:
    out = np.zeros(N_FEATURES, np.float32)
    raw = text.encode("utf-8")
    words = raw.split()
    n = len(words)
    if not n:
        return out
    b = np.frombuffer(raw, np.uint8)
    hist = np.bincount(b, minlength=256)
    kinds = CLASS[b]
    small, big, digit, _, stops, marks = np.bincount(CLASS, weights=hist, minlength=7)[1:]
    letters = small + big + hist[128:].sum()
    space = kinds == 4
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(~space & np.concatenate([space[1:], [True]]))
    sizes = ends - starts + 1
    has_small = np.add.reduceat((kinds == 1).astype(np.int32), starts) > 0
    caps = np.add.reduceat((kinds == 2).astype(np.int32), starts)
    lines = raw.split(b"\n")
    pairs = set(zip(words, words[1:]))
    out[:17] = (
        np.log1p(n) / 5, big / max(letters, 1), ((caps >= 2) & ~has_small).mean(), marks / len(raw), stops / len(raw),
        digit / len(raw), (kinds[ends] == 6).mean(), (kinds[ends] == 5).mean(), ((kinds[starts] >= 5) & (sizes <= 2)).mean(),
        sum(map(eq, words, words[1:])) / n, len(set(words)) / n, len(pairs) / n, sizes.mean() / 10, sizes.std() / 10,
        1 - len(set(lines)) / len(lines), np.log1p(len(raw) / len(lines)) / 5,
        min(2.0, len(zlib.compress(raw, 1)) / len(raw)))
    out[17:] = np.log1p(100 * hist[MARKS] / n) / 5
    return out


def _matrix(texts: list[str]) -> np.ndarray:
    return np.stack([features(t) for t in texts]) if texts else np.zeros((0, N_FEATURES), np.float32)


class Model:
    """One hidden layer; `score` is the estimated chance of a good text."""

    def __init__(self, rows: np.ndarray, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = rows.mean(axis=0), rows.std(axis=0) + 0.02
        d = rows.shape[1]
        self.p = [rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        self.m, self.v, self.t = [np.zeros_like(x) for x in self.p], [np.zeros_like(x) for x in self.p], 0

    def scaled(self, rows):
        return np.clip((rows - self.mean) / self.scale, -8, 8)

    def output(self, x):
        w, b, u, c = self.p
        h = np.tanh(x @ w + b)
        return h, h @ u + c[0]

    def score(self, rows):
        return 1 / (1 + np.exp(-np.clip(self.output(self.scaled(rows))[1], -30, 30)))

    def step(self, x, h, d_out, rate):
        """One Adam step; d_out: derivative of the loss by each row's output."""
        w, _, u, _ = self.p
        d_h = d_out[:, None] * u * (1 - h * h)
        grads = [x.T @ d_h + DECAY * w, d_h.sum(axis=0), h.T @ d_out + DECAY * u, np.array([d_out.sum()])]
        self.t += 1
        for p, m, v, g in zip(self.p, self.m, self.v, grads):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)

    def weights(self) -> tuple:
        return self.mean, self.scale, [x.copy() for x in self.p]


def _epochs(model: Model, positive: np.ndarray, unlabelled: np.ndarray, derivative, seed: int) -> Model:
    """derivative(outputs of positives, outputs of unlabelled) -> theirs by the loss."""
    rng = np.random.default_rng(seed)
    xp, xu = model.scaled(positive), model.scaled(unlabelled)
    steps = max(1, -(-len(xu) // BATCH))
    epochs = max(EPOCHS, -(-1500 // steps))  # few rows: as many steps all the same
    for epoch in range(epochs):
        iu = np.array_split(rng.permutation(len(xu)), steps)
        rate = RATE * (1 - epoch / epochs) + 1e-5
        for u in iu:
            p = rng.integers(0, len(xp), min(BATCH, max(32, len(xp))))
            x = np.concatenate([xp[p], xu[u]])
            h, out = model.output(x)
            dp, du = derivative(out[:len(p)], out[len(p):])
            model.step(x, h, np.concatenate([dp, du]), rate)
    return model


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 5) -> float:
    """Share of good texts among unlabelled rows, from positives and unlabelled rows.

    Half of both fits a positive-or-unlabelled classifier; on the other half,
    over all thresholds, the least upper bound of unlabelled / positive mass."""
    if min(len(positive), len(unlabelled)) < 8:
        return 0.5
    p_fit, p_held, u_fit, u_held = positive[::2], positive[1::2], unlabelled[::2], unlabelled[1::2]

    def derivative(p, u):  # logistic loss, both sides weighing the same
        return -_sigmoid(-p) / len(p), _sigmoid(u) / len(u)

    model = _epochs(Model(np.concatenate([p_fit, u_fit]), seed), p_fit, u_fit, derivative, seed)
    sp, su = np.sort(model.score(p_held)), np.sort(model.score(u_held))
    share_p = 1 - np.arange(len(sp)) / len(sp)  # at or above each positive's score
    share_u = 1 - np.searchsorted(su, sp) / len(su)
    error = np.sqrt(np.log(20) / (2 * len(sp))) + np.sqrt(np.log(20) / (2 * len(su)))
    bound = (share_u + error) / share_p
    best = int(np.argmin(bound))
    return float(np.clip(share_u[best] / share_p[best], 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, seed: int = 17) -> tuple[Model, float]:
    """(model, prior) of least non-negative unbiased risk."""
    prior = estimate_prior(positive, unlabelled) if prior is None else prior

    def derivative(p, u):
        # logistic losses: as good log(1+e^-x), as bad log(1+e^x)
        as_bad_p, as_bad_u = np.logaddexp(0, p).mean(), np.logaddexp(0, u).mean()
        good = -prior * _sigmoid(-p) / len(p)
        bad_p, bad_u = -prior * _sigmoid(p) / len(p), _sigmoid(u) / len(u)
        if as_bad_u - prior * as_bad_p < 0:  # the bad texts' risk cannot be negative: step back
            return -bad_p, -bad_u
        return good + bad_p, bad_u

    return _epochs(Model(np.concatenate([positive, unlabelled]), seed), positive, unlabelled, derivative, seed), prior


def _sample(ids: DataFrame, most: int) -> DataFrame:
    """At most `most` distinct ids, those of least hash."""
    return ids.where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def training_rows(docs: DataFrame, labels: DataFrame, learn, most_positives: int, most_unlabelled: int) -> tuple:
    """(positives, unlabelled) feature rows from the rows where `learn` holds.

    docs: doc_id, text; labels: doc_id, quality. The unlabelled rows are drawn
    from all documents of the fold, whatever their label."""
    good = _sample(labels.where(learn & (F.col("quality") == 1)).select("doc_id"), most_positives)
    any_ = _sample(docs.where(learn).select("doc_id"), most_unlabelled)
    # at most most_positives + most_unlabelled ids: the parameters bound what is broadcast
    wanted = F.broadcast(good.withColumn("kind", F.lit(1)).union(any_.withColumn("kind", F.lit(0))))

    def run(batches):
        for batch in batches:
            for first, texts in text_slices(batch):
                rows = _matrix(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(first, len(texts)), batch.column(0).slice(first, len(texts)),
                     pa.array(list(rows), pa.list_(pa.float32()))], ["kind", "doc_id", "x"])

    # repeated ids: the row of least features each, settled before rows leave the cluster, so the bound holds
    found: pd.DataFrame = (docs.join(wanted, "doc_id").select("doc_id", "text", "kind")
                           .mapInArrow(run, "kind int, doc_id long, x array<float>")
                           .groupBy("kind", "doc_id").agg(F.min("x").alias("x")).toPandas())
    found = found.sort_values(["kind", "doc_id"], kind="stable")
    part = [np.stack(x.to_numpy()).astype(np.float64) if len(x) else np.zeros((0, N_FEATURES))
            for x in (found.x[found.kind == 1], found.x[found.kind == 0])]
    return part[0], part[1]


def _scored(df: DataFrame, labels: DataFrame, learn, prior: float | None, most_positives: int, most_unlabelled: int,
            id_col: str, text_col: str, keep: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """Rows (_doc_id, _score, carried columns), and the carried name of each column of `keep`."""
    docs = keyed_texts(df, id_col, text_col)
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    positive, unlabelled = training_rows(docs, labels, learn, most_positives, most_unlabelled)
    model = fit(positive, unlabelled, prior)[0] if len(positive) and len(unlabelled) else None

    # the columns carried, the text among them if it is asked for
    carried = [c for c in keep if c != text_col]
    names = [f"_k{i}" for i in range(len(carried))] + ["text"] * (text_col in keep)

    def run(batches):
        for batch in batches:
            for first, texts in text_slices(batch):
                score = model.score(_matrix(texts)) if model else np.full(len(texts), 0.5)
                kept = [c.slice(first, len(texts)) for c in batch.columns]
                kept = [*kept[2:], kept[1]][:len(names)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(score, pa.float64()),
                                                  *kept], ["_doc_id", "_score", *names])

    read = df.select(F.col(f"`{id_col}`").cast("long").alias("_doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"),
                     *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(carried)])
    types = dict(read.dtypes)
    scored = read.mapInArrow(run, ", ".join(["_doc_id long", "_score double", *[f"{n} {types[n]}" for n in names]]))
    place = {c: f"_k{i}" for i, c in enumerate(carried)} | {text_col: "text"}
    return scored, place


def classify(df: DataFrame, labels: DataFrame, learn, prior: float | None = None,
             most_positives: int = MOST_POSITIVES, most_unlabelled: int = MOST_UNLABELLED,
             id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score, *keep) of every row: the chance of label 1, 0 to 1.

    learn: condition on doc_id for the rows that may teach; keep: further
    columns of df carried along unread."""
    rows, place = _scored(df, labels, learn, prior, most_positives, most_unlabelled, id_col, text_col, keep)
    return rows.select(F.col("_doc_id").alias("doc_id"), F.col("_score").alias("score"),
                       *[F.col(place[c]).alias(c) for c in keep])


def accepted(df: DataFrame, labels: DataFrame, learn, least: float = 0.5, prior: float | None = None,
             most_positives: int = MOST_POSITIVES, most_unlabelled: int = MOST_UNLABELLED,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df, all columns, whose score is `least` or more."""
    others = tuple(c for c in df.columns if c != id_col)
    rows, place = _scored(df, labels, learn, prior, most_positives, most_unlabelled, id_col, text_col, others)
    place[id_col] = "_doc_id"
    return rows.where(F.col("_score") >= least).select(*[F.col(place[c]).alias(c) for c in df.columns])
