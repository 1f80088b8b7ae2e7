"""Quality classifier: naive Bayes support vector machine.

A text's features are the distinct hashed n-grams (one and two tokens) of its
whole length; tokens are words or runs of punctuation, case kept, and n-grams of
repetition flags stand beside them. Every
indicator is scaled by its class log-count ratio, rows are scaled to length one,
and a linear hinge-loss model is fitted to them by dual coordinate descent. The
score is the logistic of the margin.

The fit takes at most ``sample_rows`` labelled rows, first by a hash of the id, of
texts up to ``sample_chars`` characters: the documented bound on a classifier's
sample, which also bounds what reaches the driver. Scoring covers every whole
text.

Defined results: a null text is an empty text; texts without a feature get the
score of the bias alone; a document labelled more than once takes its largest
label, null labels are no labels; with no labelled row (or one class only) every
score is 0.5 (that class's: 1 or 0); repeated rows repeat their result.
"""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import id_text, in_fold, map_texts

_TOKENS = re.compile(r"\w+|[^\w\s]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Featurizer:
    """Distinct hashed n-grams of texts; token hashes are kept up to a bound."""

    def __init__(self, bits: int, cache_tokens: int = 300_000):
        self.shift, self.most, self.cache = np.uint64(64 - bits), cache_tokens, {}

    def _hashes(self, tokens: list[str]) -> np.ndarray:
        cache = self.cache
        if len(cache) > self.most:
            cache.clear()
        for t in set(tokens).difference(cache):
            raw = t.encode("utf-8", "surrogatepass")
            cache[t] = zlib.crc32(raw) << 32 | zlib.crc32(raw, 0x5EED)
        return np.fromiter(map(cache.__getitem__, tokens), np.uint64, len(tokens))

    def __call__(self, text: str | None) -> np.ndarray:
        h = self._hashes(_TOKENS.findall(text or "")) * _MIX
        h ^= h >> np.uint64(29)
        grams = [h * _MIX, (h[:-1] * np.uint64(3) + h[1:]) * _MIX]
        for back in (1, 2):  # n-grams of "same token as one (two) before", which see repetition in any words
            same = (h[back:] == h[:-back]).astype(np.uint64)
            if len(same) >= 6:
                run = sum(same[k:len(same) - 5 + k] << np.uint64(k) for k in range(6))
                grams.append((np.unique(run) + np.uint64(1000 * back)) * _MIX * _MIX)
        return np.unique((np.concatenate(grams) >> self.shift).astype(np.int64))


class Model(NamedTuple):
    weights: np.ndarray  # of an indicator, its log-count ratio included
    squares: np.ndarray  # squared log-count ratios, for the row length
    bias: float
    bits: int

    def margin(self, features: np.ndarray) -> float:
        length = float(np.sqrt(self.squares[features].sum()))
        return (float(self.weights[features].sum()) / length if length > 0 else 0.0) + self.bias


def train(rows: list[np.ndarray], labels: list[int], bits: int, c: float = 1.0, rounds: int = 20,
          smoothing: float = 1.0, seed: int = 7) -> Model:
    """NB-SVM on rows of distinct feature ids with labels 0 or 1."""
    size = 1 << bits
    if len(set(labels)) < 2:
        sure = 0.0 if not labels else (1e3 if labels[0] == 1 else -1e3)
        return Model(np.zeros(size), np.zeros(size), sure, bits)
    counts = np.full((2, size), smoothing)
    for x, y in zip(rows, labels):
        counts[y, x] += 1.0
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    # A row's vector: ratio[x] / its length, and a constant 1 for the bias; classes weigh the same.
    sign = np.array([1.0 if y == 1 else -1.0 for y in labels])
    upper = np.where(sign > 0, len(sign) / (2 * (sign > 0).sum()), len(sign) / (2 * (sign < 0).sum())) * c
    length = np.array([np.sqrt(np.square(ratio[x]).sum()) or 1.0 for x in rows])
    w, b, alpha, rng = np.zeros(size), 0.0, np.zeros(len(rows)), np.random.default_rng(seed)
    norm = np.array([2.0 if len(x) else 1.0 for x in rows])
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            x = rows[i]
            values = ratio[x] / length[i]
            gradient = sign[i] * (w[x] @ values + b) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), upper[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[x] += step * values
                b += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return Model(w * ratio, np.square(ratio), b, bits)


def fit(docs: DataFrame, labels: DataFrame, bits: int = 18, sample_rows: int = 4000, sample_chars: int = 100_000,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options) -> Model:
    """The model from labelled rows that aren't held out: ``sample_rows`` ids that have a document to learn from,
    the first by a hash. Of several documents of an id one is taken."""
    texts = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
             .where(F.coalesce(F.length("_text"), F.lit(0)) <= sample_chars))
    drawn = (labels.where(F.col(label_col).isNotNull() & ~in_fold(id_col, 3, 1))
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
             .join(texts.select("_id").distinct(), "_id", "left_semi")
             .orderBy(F.xxhash64(F.lit("quality"), id_text("_id")), "_id").limit(sample_rows))
    rows = (texts.join(F.broadcast(drawn), "_id")  # at most sample_rows narrow rows
            .groupBy("_id", "_label").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text")))

    def features():
        of = Featurizer(bits)
        return lambda texts: [(of(t).astype(np.int32),) for t in texts]

    got = map_texts(rows, features, {"x": "array<int>"}).toPandas().sort_values("_id", kind="stable")
    return train([np.asarray(x, np.int64) for x in got["x"]], got["_label"].tolist(), bits, **options)


def quality_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))  # bounded by 2 ** bits

    def scorer():
        m = Model(*shared.value)
        of = Featurizer(m.bits)

        def score(text):
            s = 1.0 / (1.0 + float(np.exp(-np.clip(2.0 * m.margin(of(text)), -500, 500))))
            return s, int(s >= 0.5)

        return lambda texts: [score(t) for t in texts]

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return (map_texts(rows, scorer, {"score": "double", "predicted": "int"})
            .withColumn("held_out", in_fold(id_col, 3, 1)))


def quality_classifier(docs: DataFrame, labels: DataFrame, **fit_options) -> DataFrame:
    """Fit on the rows that aren't held out, then score all rows."""
    return quality_scores(docs, fit(docs, labels, **fit_options))
