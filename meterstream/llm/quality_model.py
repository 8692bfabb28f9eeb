"""Quality classifier: Naive Bayes support vectors.

Features are indicators of hashed n-grams of characters (n = 1 to 4) and of
the share of word bigrams that hold one word twice.  Each indicator is scaled
by the log ratio of its class counts, taken over all labelled documents; rows
are scaled to length one; a linear hinge-loss model is fitted by dual
coordinate descent on a bounded sample of the labelled documents, and its
margin is turned into a probability on a part of the sample it hasn't seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, without

#: Longest n-gram, and shares of repeated words that give a feature each.
LONGEST, SHARES = 4, (0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)
#: Characters of a text handled at a time.
BLOCK = 1 << 16


class Features:
    """The distinct features of a text, as numbers below ``size``."""

    def __init__(self, bits: int):
        self.bits, self.size = bits, (1 << bits) + len(SHARES)
        self._last = np.zeros(1 << bits, np.int64)

    def _distinct(self, k: np.ndarray) -> np.ndarray:
        at = np.arange(len(k))
        self._last[k] = at  # of equal features the last one remains
        return k[self._last[k] == at]

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        chars, parts = np.frombuffer(text.encode("utf-32-le"), "<u4"), []
        for at in range(0, len(chars), BLOCK):
            a = chars[at:at + BLOCK + LONGEST - 1].astype(np.uint64)
            h, grams = np.zeros_like(a), []
            for n in range(1, LONGEST + 1):
                if n > len(a):
                    break
                h = h[:len(a) - n + 1] * np.uint64(1_000_003) + a[n - 1:] + np.uint64(n)
                grams.append(h[:BLOCK] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits))
            parts.append(self._distinct(np.concatenate(grams).astype(np.int64)))
        found = parts[0] if len(parts) == 1 else self._distinct(np.concatenate(parts)) if parts else np.empty(0, np.int64)
        words = text.split()
        share = sum(map(str.__eq__, words, words[1:])) / max(1, len(words) - 1)
        return np.r_[found, [(1 << self.bits) + i for i, s in enumerate(SHARES) if share > s]].astype(np.int64)


@dataclass(frozen=True)
class Model:
    """``weight`` and ``square`` by feature: the margin is sum(weight) / sqrt(sum(square)) + bias."""

    bits: int
    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, found: np.ndarray) -> float:
        length = float(np.sqrt(self.square[found].sum()))
        margin = (float(self.weight[found].sum()) / length if length else 0.0) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def hinge_by_dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: float = 1.0,
                          rounds: int = 300, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear model with hinge loss; rows are (features, values).

    Ends when no row of a round is off by ``tolerance``, or after ``rounds``.
    """
    order, w, bias, dual = np.random.default_rng(0), np.zeros(size), 0.0, np.zeros(len(rows))
    square = np.array([v @ v + 1 for _, v in rows])  # the bias is a feature of value 1
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(rows)):
            x, v = rows[i]
            slack = y[i] * (w[x] @ v + bias) - 1
            step = min(slack, 0.0) if dual[i] <= 0 else max(slack, 0.0) if dual[i] >= cost else slack
            if step:
                new = min(max(dual[i] - slack / square[i], 0.0), cost)
                move, dual[i] = (new - dual[i]) * y[i], new
                w[x] += move * v
                bias += move
            worst = max(worst, abs(step))
        if worst < tolerance:
            break
    return w, bias


def calibrated(margin: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins, classes weighted to ``share`` of label 1."""
    good = y > 0
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    weight = np.where(good, share / max(1, good.sum()), (1 - share) / max(1, (~good).sum())) * len(y)
    x, beta = np.c_[margin, np.ones_like(margin)], np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (weight * (target - p)) - 1e-3 * (beta - [1.0, 0.0]))
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def _counts(bits: int):
    def count(batches):
        features, n = Features(bits), None
        for batch in batches:
            n = np.zeros((2, features.size + 1), np.int64) if n is None else n
            for text, q in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n[q, features(text)] += 1
                n[q, -1] += 1  # documents
        if n is not None:
            some = np.flatnonzero(n.any(axis=0))
            yield pa.record_batch([pa.array(some), pa.array(n[1, some]), pa.array(n[0, some])], names=["feature", "good", "bad"])

    return count


def _fit(bits: int, ratio: np.ndarray, share: float):
    def fit(batches):
        features, rows, y = Features(bits), [], []
        for batch in batches:
            for text, q in zip(*(batch.column(i).to_pylist() for i in range(2))):
                x = features(text)
                v = ratio[x]
                length = np.sqrt(v @ v)
                rows.append((x.astype(np.int32), v / length if length else v))
                y.append(1 if q else -1)
        y = np.array(y)
        kept = np.arange(len(y)) % 4 == 3  # for the calibration
        if len(set(y[kept])) < 2 or len(set(y[~kept])) < 2:
            kept[:] = False
        w, bias = hinge_by_dual_descent([r for r, k in zip(rows, kept) if not k], y[~kept], len(ratio))
        seen = kept if kept.any() else ~kept
        margin = np.array([w[x] @ v + bias for (x, v), k in zip(rows, seen) if k])
        slope, offset = calibrated(margin, y[seen], share)
        yield pa.record_batch([pa.array([(w * ratio).tobytes()]), *[pa.array([z]) for z in (bias, slope, offset)]],
                              names=["weight", "bias", "slope", "offset"])

    return fit


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
          bits: int = 18, sample_per_class: int = 2000, broadcast_rows: int = 1_000_000) -> Model | None:
    """The model, or None if the labelled documents don't show both classes.

    Class counts come from every labelled document.  The hinge-loss model is
    fitted on at most ``sample_per_class`` documents of each class, taken by a
    hash of the id.  Of several labels of a document 0 wins; null ids and
    labels are left out.  Labels of up to ``broadcast_rows`` documents (16
    bytes each) are sent to the tasks, more are joined by a shuffle.
    """
    spark = docs.sparkSession
    known = (labels.select(quoted(doc_id).cast("long").alias("k"), (quoted(label) >= 1).cast("int").alias("q"))
             .dropna().groupBy("k").agg(F.min("q").alias("q")))
    texts = docs.select(quoted(doc_id).cast("long").alias("k"), quoted(text).alias("t"))
    side = F.broadcast(known) if known.limit(broadcast_rows + 1).count() <= broadcast_rows else known
    counted = (texts.join(side, "k").select("t", "q").mapInArrow(_counts(bits), "feature long, good long, bad long")
               .groupBy("feature").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toArrow())
    n, size = np.zeros((2, (1 << bits) + len(SHARES) + 1), np.int64), (1 << bits) + len(SHARES)
    at = counted.column("feature").to_numpy()
    n[0, at], n[1, at] = counted.column("bad").to_numpy(), counted.column("good").to_numpy()
    bad, good = n[:, -1]
    if not (bad and good):
        return None
    ratio = np.log((n[1, :size] + 1) / (good + 2)) - np.log((n[0, :size] + 1) / (bad + 2))
    ratio[~n[:, :size].any(axis=0)] = 0.0
    picked = [known.filter(F.col("q") == q).orderBy(F.xxhash64("k"), "k").limit(sample_per_class) for q in (0, 1)]
    sample = (texts.join(F.broadcast(picked[0].union(picked[1])), "k")
              .groupBy("k", "q").agg(F.min("t").alias("t")).select("t", "q", "k"))
    fitted = (sample.repartition(1).sortWithinPartitions(F.xxhash64("k"), "k").select("t", "q")
              .mapInArrow(_fit(bits, ratio, float(good / (good + bad))),
                          "weight binary, bias double, slope double, offset double").first())
    return Model(bits, np.frombuffer(fitted.weight), ratio * ratio, fitted.bias, fitted.slope, fitted.offset)


def quality_score(text: Column, model: Model | None, spark) -> Column:
    if model is None:
        return F.lit(1.0)
    sent = spark.sparkContext.broadcast(model)
    kept: list[Features] = []

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not kept:
            kept.append(Features(sent.value.bits))
        return pa.array([sent.value.score(kept[0](t)) for t in texts.to_pylist()], pa.float64())

    return score(text)


def with_scores(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` and ``score`` (0 to 1, higher: label 1 likelier), ``predicted`` (1 from ``threshold`` on).

    Null and empty texts get the score of a text without n-grams; without a
    model (no document of either class known) every score is 1.  Columns named
    like the two are replaced.  Repeated rows stay; an empty table stays empty.
    """
    return (without(docs, "score", "predicted").withColumn("score", quality_score(quoted(text), model, docs.sparkSession))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def held_out(doc_id: Column) -> Column:
    """The quarter of the documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
