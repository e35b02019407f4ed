"""Quality by Bradley-Terry pairwise ranking.

Documents are described by ratios of their words, signs and lines. From pairs
(a better, a worse document) the weights are learnt by logistic loss on the
difference of the two descriptions, so only the order of scores is trained. The
accepting threshold is a quantile of scores, the one at the share of worse
documents: midway between its two neighbouring scores. The published score is a
logistic function that puts this threshold at 0.7.

Describing a text is a handful of passes at C speed; the model is a short
vector. Its weights are learnt from a bounded sample of labelled rows; the
threshold is the exact order statistic over all labelled rows outside the
held-out fold, each row of a repeated doc_id counted, texts of any length.

Defined cases: null and blank texts are described by zeros and scored like any
other; a sample without both classes accepts everyone with score 1 (0 if all
are worse); repeated rows each give a row; a null doc_id is not held out; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.select import column_order_stats
from cartwise.llm.common import BROADCAST_LIMIT_BYTES, staged
from cartwise.llm.labelled import known_labels, remainder, training_sample

#: The training sample's bounds: worse and better rows, characters a row.
SAMPLE = {0: 3000, 1: 6000}
MAX_CHARS = 20_000
PAIRS, STEPS, RATE, DECAY, SEED = 4096, 400, 0.5, 1e-4, 11
FOLDS, HELD_OUT, ACCEPT = 4, 2, 0.7

SIGNS, DIGITS = b"*$%&#@^~=<>{}[]\\/_+", b"0123456789"
ODD_ENDS = frozenset(SIGNS + b"!|")


def describe(text: str | None) -> list[float]:
    """A text's ratios, all between 0 and about 1."""
    raw = (text or "").encode()
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper = sum(map(bytes.isupper, words)) / n
    signs = (len(raw) - len(raw.translate(None, SIGNS))) / size
    bangs = raw.count(b"!") / size
    pipes = counts.get(b"|", 0) / n
    same = sum(map(eq, words, words[1:])) / n
    again = 1 - len(counts) / n if words else 0.0
    most = max(counts.values(), default=0) / n
    odd = sum(c for w, c in counts.items() if w[-1] in ODD_ENDS) / n
    shares = [upper, signs, bangs, pipes, same, again, most, odd]
    return [*shares, *map(math.sqrt, shares), *(min(1.0, 20 * s) for s in (upper, signs, bangs, pipes, same, odd)),
            math.log(n) / 5, len(raw) / n / 6, (len(raw) - len(raw.translate(None, DIGITS))) / size,
            1 - len(set(lines)) / max(1, len(lines)) if lines else 0.0,
            (raw.count(b",") + raw.count(b".")) / n, 1 / n, math.log(max(1, len(lines))) / 3]


class Model:
    """Weights over descriptions and the accepting threshold."""

    def __init__(self, weights: np.ndarray, threshold: float, spread: float):
        self.weights, self.threshold, self.spread = weights, threshold, spread

    def ranks(self, texts) -> np.ndarray:
        """Scores as they are ranked, before the threshold is known."""
        return np.array([describe(t) for t in texts]) @ self.weights if len(texts) else np.empty(0)

    def scores(self, texts) -> np.ndarray:
        raw = self.ranks(texts)
        # monotone in the rank score, and ACCEPT exactly at the threshold
        z = np.clip((raw - self.threshold) / self.spread, -60, 60) + math.log(ACCEPT / (1 - ACCEPT))
        score = 1 / (1 + np.exp(-z))
        return np.where(raw >= self.threshold, np.maximum(score, ACCEPT), np.minimum(score, np.nextafter(ACCEPT, 0)))


def train(sample: list[tuple[int, str]]) -> Model:
    """Weights from random (better, worse) pairs of the sample."""
    y = np.array([label for label, _ in sample])
    x = np.array([describe(t) for _, t in sample]) if len(sample) else np.zeros((0, len(describe(""))))
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(x.shape[1]), math.inf if len(y) and not y.max() else -math.inf, 1.0)
    spread = x.std(axis=0) + 1e-6
    x = x / spread
    rng = np.random.default_rng(SEED)
    better, worse = np.nonzero(y == 1)[0], np.nonzero(y == 0)[0]
    w, sq = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-8)
    for _ in range(STEPS):
        d = x[rng.choice(better, PAIRS)] - x[rng.choice(worse, PAIRS)]
        p = 1 / (1 + np.exp(np.clip(d @ w, -60, 60)))
        g = DECAY * w - (p[:, None] * d).mean(axis=0)
        sq += g**2
        w -= RATE * g / np.sqrt(sq)
    # the quantile at the share of worse rows, midway between its neighbours
    ranked = np.sort(x @ w)
    k = len(worse)
    threshold = (ranked[k - 1] + ranked[k]) / 2
    return Model(w / spread, float(threshold), float(ranked.std()) or 1.0)


def whole_threshold(docs: DataFrame, labels: DataFrame, model: Model) -> float:
    """The quantile at the worse rows' share over all labelled rows outside the
    held-out fold. Where the labels can be broadcast only labelled rows are scored;
    beyond that bound texts are scored where they lie, ids and scores alone are joined."""

    @F.pandas_udf("double")
    def rank(text: pd.Series) -> pd.Series:
        return pd.Series(model.ranks(list(text)), dtype="float64")

    known = staged(known_labels(labels, "quality", FOLDS, HELD_OUT).filter(F.col("y").isin(0, 1)), "quality-labels")
    size = 32 * known.count()
    fold = docs.filter(remainder("doc_id", FOLDS) != HELD_OUT).select("doc_id", F.col("text").cast("string").alias("text"))
    if size <= BROADCAST_LIMIT_BYTES:
        ranked = fold.join(F.broadcast(known), "doc_id").select(rank("text").alias("raw"), "y")
    else:
        ranked = fold.select("doc_id", rank("text").alias("raw")).join(known, "doc_id").select("raw", "y")
    rows = staged(ranked, "quality-ranks")
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(1 - F.col("y")).alias("worse")).first()
    k = counts["worse"]
    at = column_order_stats(rows, {"raw": (counts["n"], [k, k + 1])})
    return (at[("raw", k)] + at[("raw", k + 1)]) / 2


def fit(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> Model:
    """Model of ``labels.quality``, learnt outside the held-out fold."""
    model = train(training_sample(docs, labels, "quality", FOLDS, HELD_OUT, sample or SAMPLE, MAX_CHARS, SEED))
    if math.isfinite(model.threshold):
        model.threshold = whole_threshold(docs, labels, model)
    return model


def scorer(model: Model):
    """Pandas UDF text -> score; the model is a vector of some thirty numbers."""

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.scores(list(text)), dtype="float64")

    return score


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from 0.7) for every row."""
    return (docs.select("doc_id", F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                        scorer(model)(F.col("text").cast("string")).alias("score"))
            .withColumn("predicted", (F.col("score") >= ACCEPT).cast("int")))


def drop_poor(docs: DataFrame, model: Model) -> DataFrame:
    """Rows that score 0.7 or more, columns as they are."""
    return docs.filter(scorer(model)(docs["text"].cast("string")) >= ACCEPT)
