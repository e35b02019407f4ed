"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (3 to 6, with word-end marks) and of
itself, hashed to a fixed number of buckets; its vector is the mean of their
embeddings, a document's vector the mean over all its words, each occurrence
counted (and a few neutral ones, without which a text of five words would hang on
one), and a linear softmax over two classes gives the score. Embeddings and
softmax are trained jointly by AdaGrad in numpy on a bounded sample of labelled
rows; buckets whose document shares don't differ between the classes stay at
zero. So a misspelling that no training text holds shares n-grams with the words
it is made from. (With two classes the softmax is a logistic function of the
difference of the class weights, which is what is stored.)

A trained model is one number per bucket (embedding times class weights), so
tasks score a word by a mean of a few numbers and cache it, up to a bound.
Occurrences keep the mean at the text's share of toxic words, whatever its length.

Defined cases: null, empty and wordless texts score as the intercept alone; a
sample without both classes gives the share of label 1 (0 without any) as
everyone's score; repeated rows each give a row; a null doc_id is not held out;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.labelled import remainder, training_sample

WORDS = re.compile(r"[^\W\d_]+").findall
BUCKETS, DIM = 1 << 18, 4
GRAMS = (3, 4, 5, 6)
#: The training sample's bounds: rows without and with the label, characters a row.
SAMPLE = {0: 4000, 1: 2000}
MAX_CHARS = 20_000
STEPS, BATCH, RATE, GAIN, SEED = 400, 64, 0.3, 20.0, 7
FOLDS, HELD_OUT = 5, 0
BASE = 0x01000193
CHI2 = 15.0
#: Neutral words that every text is padded with, so that a few words decide nothing alone.
PAD = 8
CACHE, LONGEST = 400_000, 64


def word_grams(words: list[str], size: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of every word itself and of its n-grams over its
    characters, hashed by a polynomial in 32-bit arithmetic, all words at once."""
    marked = [f"<{w}>" for w in words]
    raw = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.array([len(m) for m in marked], np.int64)
    end = np.repeat(np.cumsum(length), length)
    owner = np.repeat(np.arange(len(words)), length)
    place = np.arange(len(raw))

    def mixed(h, n):
        h = (h ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE35)
        return ((h ^ (h >> np.uint32(13))) % np.uint32(size)).astype(np.int32)

    # the word itself: its characters' sum weighted by powers of the base
    power = np.cumprod(np.full(int(length.max(initial=1)), BASE, np.uint32), dtype=np.uint32)
    whole = np.zeros(len(words), np.uint32)
    np.add.at(whole, owner, raw * power[(end - 1 - place)])
    buckets, owners = [mixed(whole, 1)], [np.arange(len(words))]
    h = np.zeros(len(raw), np.uint32)
    for n in range(1, min(max(GRAMS), len(raw)) + 1):
        # h at i: hash of the n characters from i on (garbage past a word's end, masked below)
        m = len(raw) - n + 1
        h[:m] = h[:m] * np.uint32(BASE) + raw[n - 1:]
        if n in GRAMS:
            inside = place + n <= end
            buckets.append(mixed(h[inside], n))
            owners.append(owner[inside])
    return np.concatenate(buckets), np.concatenate(owners)


class Model:
    """logit = intercept + mean over a text's words, all occurrences, and PAD neutral
    ones of the mean weight of the word's buckets."""

    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, intercept
        self.cache: dict[str, float] = {}

    def _learn(self, words: list[str]) -> dict[str, float]:
        bucket, owner = word_grams(words, len(self.weights))
        total = np.bincount(owner, self.weights[bucket], len(words))
        return dict(zip(words, (total / np.bincount(owner, minlength=len(words))).tolist(), strict=True))

    def scores(self, texts: list[str | None]) -> list[float]:
        """Scores of many texts; words seen lately are taken from the cache."""
        bags = [Counter(WORDS((t or "").lower())) for t in texts]
        known = self.cache
        new = sorted(set().union(*bags) - known.keys())
        fresh = self._learn(new) if new else {}
        if len(known) + len(fresh) > CACHE:
            known = self.cache = {}
            fresh = self._learn(sorted(set().union(*bags)))
        known.update(fresh)
        out = []
        for bag in bags:
            z = self.intercept + (math.fsum([known[w] * n for w, n in bag.items()]) / (bag.total() + PAD))
            out.append(1 / (1 + math.exp(-z)) if z > -700 else 0.0)
        return out


def informative(docs, y, flat, starts, lengths, buckets: int) -> np.ndarray:
    """Buckets whose share of documents differs between the classes beyond chance
    (chi-square of at least CHI2): the others would only learn single texts by heart."""
    seen = np.zeros((2, buckets))
    for words, label in zip(docs, y.astype(int), strict=True):
        mark = np.zeros(buckets, bool)
        size = lengths[words]
        at = np.repeat(starts[words] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(words) else words
        mark[flat[at]] = True
        seen[label] += mark
    n = np.array([(y == 0).sum(), (y == 1).sum()], np.float64)[:, None]
    total, all_n = seen.sum(axis=0), n.sum()
    expected = np.maximum(total * (all_n - total), 1e-9)
    chi2 = all_n * (seen[1] * (n[0] - seen[0]) - seen[0] * (n[1] - seen[1])) ** 2 / (n[0] * n[1] * expected)
    return chi2 >= CHI2


def train(sample: list[tuple[int, str]], buckets: int = BUCKETS, dim: int = DIM, steps: int = STEPS) -> Model:
    """Embeddings and class weights fitted jointly on (label, text) rows."""
    y = np.array([label for label, _ in sample], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(buckets, np.float32), math.log((share + 1e-9) / (1 - share + 1e-9)))
    vocabulary: dict[str, int] = {}
    bags = [Counter(vocabulary.setdefault(w, len(vocabulary)) for w in WORDS(t.lower())) for _, t in sample]
    docs = [np.array(sorted(bag), np.int64) for bag in bags]
    times = [np.array([bag[w] for w in words], np.int64) for bag, words in zip(bags, docs, strict=True)]
    del bags
    if not vocabulary:
        return Model(np.zeros(buckets, np.float32), math.log(y.mean() / (1 - y.mean())))
    flat, owner = word_grams(list(vocabulary), buckets)
    flat, lengths = flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(vocabulary))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    live = informative(docs, y, flat, starts, lengths, buckets)
    # only what can carry an embedding is trained; a word's mean stays over all its buckets
    lengths_live = np.add.reduceat(live[flat].astype(np.int64), starts)
    flat, starts_live = flat[live[flat]], np.concatenate([[0], np.cumsum(lengths_live)[:-1]])
    del vocabulary

    rng = np.random.default_rng(SEED)
    emb = (rng.random((buckets, dim), dtype=np.float32) - 0.5) * 0.1
    out, bias = rng.normal(0, 1, dim), 0.0
    emb_sq, out_sq, bias_sq = np.full((buckets, dim), 1e-8, np.float32), np.full(dim, 1e-8), 1e-8
    full = np.array([i for i in range(len(docs)) if len(docs[i])], np.int64)
    order = np.concatenate([rng.permutation(full) for _ in range(-(-steps * BATCH // max(1, len(full))))]) if len(full) else full
    for at in range(0, min(steps * BATCH, len(order)), BATCH):
        batch = order[at:at + BATCH]
        words, of_word = np.unique(np.concatenate([docs[i] for i in batch]), return_inverse=True)
        n = np.array([len(docs[i]) for i in batch])
        occurs = np.concatenate([times[i] for i in batch])
        of_doc = np.repeat(np.arange(len(batch)), n)
        share = GAIN * occurs / (np.bincount(of_doc, occurs, len(batch)) + PAD)[of_doc]
        size, all_size = lengths_live[words], lengths[words][:, None]
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        grams = flat[np.repeat(starts_live[words] - first, size) + np.arange(size.sum())]
        owner = np.repeat(np.arange(len(words)), size)
        vec = np.stack([np.bincount(owner, emb[grams, j], len(words)) for j in range(dim)], 1) / all_size
        hidden = np.stack([np.bincount(of_doc, share * vec[of_word, j], len(batch)) for j in range(dim)], 1)
        p = 1 / (1 + np.exp(-np.clip(hidden @ out + bias, -30, 30)))
        r = (p - y[batch]) / len(batch)
        back = r[:, None] * out
        g_vec = np.stack([np.bincount(of_word, share * back[of_doc, j], len(words)) for j in range(dim)], 1) / all_size
        hit, of_hit = np.unique(grams, return_inverse=True)
        g_emb = np.stack([np.bincount(of_hit, g_vec[owner, j], len(hit)) for j in range(dim)], 1)
        emb_sq[hit] += g_emb**2
        emb[hit] -= RATE * g_emb / np.sqrt(emb_sq[hit])
        g_out, g_bias = hidden.T @ r, r.sum()
        out_sq += g_out**2
        out -= RATE * g_out / np.sqrt(out_sq)
        bias_sq += g_bias**2
        bias -= RATE * g_bias / math.sqrt(bias_sq)
    emb[~live] = 0
    return Model((emb @ out * GAIN).astype(np.float32), float(bias))


def fit(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> Model:
    """Model of ``labels.toxic``, learnt outside the held-out fold."""
    return train(training_sample(docs, labels, "toxic", FOLDS, HELD_OUT, sample or SAMPLE, MAX_CHARS, SEED))


def scorer(spark, model: Model):
    """Pandas UDF text -> score with the model broadcast (a few MB, whatever the corpus)."""
    shared = spark.sparkContext.broadcast((model.weights, model.intercept))
    key = uuid.uuid4().hex

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        m = _worker_model(key, shared)
        texts = list(text)
        # a slice of texts at a time bounds what is held besides the cache
        return pd.Series([x for at in range(0, len(texts), 256) for x in m.scores(texts[at:at + 256])], dtype="float64")

    return score


_MODELS: dict = {}


def _worker_model(key, shared) -> Model:
    """One model, and so one word cache, per worker process."""
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(*shared.value)
    return _MODELS[key]


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from 0.5) for every row."""
    score = scorer(docs.sparkSession, model)
    return (docs.select("doc_id", F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                        score(F.col("text").cast("string")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """Rows that score under one half, columns as they are."""
    return docs.filter(scorer(docs.sparkSession, model)(docs["text"].cast("string")) < 0.5)
