"""Toxicity by subword-bag embeddings: word n-grams share vectors, their mean goes to a linear softmax.

A word is a bag of the n-grams of ``<word>`` (lengths 3 to 5, and the whole), hashed into a fixed
number of vectors; a document is the mean of its words' mean vectors. Vectors and softmax are trained
jointly with numpy on a bounded sample of labelled rows (``per_class`` of each class, drawn by a hash
of the id). A misspelling shares most n-grams with the word, so it lands near it.

As the model is linear behind the mean, a word adds one number to the score; workers remember it.

Null, empty and wordless texts score the bias alone. Without any usable label the score is 0 for all.
With one class only, the score is that class. Repeated documents score alike; the labels' table may
repeat ids (the greatest label counts). Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

from cascata.llm.common import bounded_labels, fold_of

WORD = re.compile(r"[^\W_]+(?:[^\w\s]+[^\W_]+)*")
BUCKETS = 1 << 17
PER_CLASS = 2500
SIZES = (3, 4, 5)
WORDS_KEPT = 400_000
LONGEST = 40


def grams(word: str, buckets: int = BUCKETS) -> list[int]:
    """Buckets of a word's n-grams; of words over 40 characters the n-grams of every 40-character piece."""
    out = []
    for start in range(0, len(word), LONGEST):
        w = f"<{word[start:start + LONGEST]}>"
        out.append(zlib.crc32(w.encode()) % buckets)
        for n in SIZES:
            if n < len(w):
                out += [zlib.crc32(w[i : i + n].encode()) % buckets for i in range(len(w) - n + 1)]
    return out


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


@dataclass
class ToxicModel:
    """score = sigmoid(mean over words of the mean of ``weights`` at the word's n-grams, plus ``bias``)."""

    weights: np.ndarray
    bias: float

    def word(self, word: str) -> float:
        return float(self.weights[grams(word, len(self.weights))].mean())

    def score(self, text: str | None, kept: dict[str, float]) -> float:
        if not np.isfinite(self.bias):
            return float(self.bias > 0)
        found = words(text)
        total = 0.0
        for w in found:
            value = kept.get(w)
            if value is None:
                if len(kept) > WORDS_KEPT:
                    kept.clear()
                value = kept[w] = self.word(w)
            total += value
        z = self.bias + (total / len(found) if found else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def bag(text: str | None, buckets: int = BUCKETS) -> bytes:
    """Buckets of a whole text and their share of the mean, as 32-bit integers and floats."""
    share: Counter[int] = Counter()
    counted = Counter(words(text))
    for w, n in counted.items():
        found = grams(w, buckets)
        for g in found:
            share[g] += n / len(found)
    total = max(1, sum(counted.values()))
    ids = np.fromiter(share, np.int32, len(share))
    values = np.fromiter(share.values(), np.float32, len(share)) / np.float32(total)
    return ids.tobytes() + values.astype(np.float32).tobytes()


def train(
    bags: list[bytes], labels: np.ndarray, buckets: int = BUCKETS, dim: int = 8,
    epochs: int = 10, rate: float = 0.05, batch: int = 32, decay: float = 0.02,
    least_share: float = 0.02, seed: int = 7,
) -> ToxicModel:
    """Vectors and softmax by Adam on the cross entropy, both at once.

    Vectors shrink a little with each step. Those of n-grams in less than ``least_share`` of the documents stay zero: they could
    only learn single documents by heart.
    """
    if not len(labels):
        return ToxicModel(np.zeros(buckets, np.float32), -np.inf)
    if labels.min() == labels.max():
        return ToxicModel(np.zeros(buckets, np.float32), np.inf if labels[0] else -np.inf)
    draw = np.random.default_rng(seed)
    pairs = [(np.frombuffer(b, np.int32, len(b) // 8), np.frombuffer(b, np.float32, offset=len(b) // 2)) for b in bags]
    seen = np.zeros(buckets, np.int32)
    for ids, _ in pairs:
        seen[ids] += 1
    common = seen >= least_share * len(labels)
    pairs = [(i[common[i]], v[common[i]]) for i, v in pairs]
    table = draw.normal(0, 0.1, (buckets, dim)).astype(np.float32) * common[:, None]
    out = draw.normal(0, 0.5, (dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    first, second = np.zeros_like(table), np.zeros_like(table)
    dense = [np.zeros_like(x) for x in (out, out, bias, bias)]
    order, step = np.arange(len(labels)), 0
    for epoch in range(epochs):
        draw.shuffle(order)
        lr = rate * (1 - epoch / epochs)
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            step += 1
            ids = np.concatenate([pairs[r][0] for r in rows])
            size = np.array([len(pairs[r][0]) for r in rows])
            share = np.concatenate([pairs[r][1] for r in rows])
            owner = np.repeat(np.arange(len(rows)), size)
            mean = np.stack([
                np.bincount(owner, share * table[ids, k], minlength=len(rows)) for k in range(dim)
            ], 1).astype(np.float32)
            z = mean @ out + bias
            z -= z.max(1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            p /= len(rows)
            back = p @ out.T
            unique, inverse = np.unique(ids, return_inverse=True)
            grad = np.stack([
                np.bincount(inverse, share * back[owner, k], minlength=len(unique)) for k in range(dim)
            ], 1).astype(np.float32)
            # Adam; moments of vectors change only where a batch touches them.
            fix = lr * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            first[unique] = 0.9 * first[unique] + 0.1 * grad
            second[unique] = 0.999 * second[unique] + 0.001 * grad**2
            for param, g, k in ((out, mean.T @ p, 0), (bias, p.sum(0), 2)):
                dense[k] = 0.9 * dense[k] + 0.1 * g
                dense[k + 1] = 0.999 * dense[k + 1] + 0.001 * g**2
                param -= (fix * dense[k] / (np.sqrt(dense[k + 1]) + 1e-8)).astype(np.float32)
            table[unique] *= 1 - lr * decay
            table[unique] -= fix * first[unique] / (np.sqrt(second[unique]) + 1e-8)
    return ToxicModel((table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(
    documents: DataFrame, labels: DataFrame, label: str = "toxic",
    per_class: int = PER_CLASS, buckets: int = BUCKETS,
) -> ToxicModel:
    """Learn from at most ``per_class`` documents of each class outside the held-out fold.

    The drawn ids are at most two times ``per_class`` rows and are broadcast; executors make the bags,
    and the driver trains on them (some 10 KB a document).
    """

    @F.arrow_udf(BinaryType())
    def bags(texts: pa.Array) -> pa.Array:
        return pa.array([bag(t.as_py(), buckets) for t in texts], pa.binary())

    drawn = F.broadcast(bounded_labels(labels, label, per_class))
    found = (
        documents.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
        .join(drawn, "_id")
        .select("_id", "_y", bags("_text").alias("_bag"))
    )
    # Ids that documents repeat may give more rows than were drawn: per class the first by hash.
    ranked = [
        found.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id", "_bag").limit(per_class)
        for y in (0, 1)
    ]
    rows = ranked[0].unionByName(ranked[1]).select("_y", "_bag").toArrow()
    y = rows["_y"].to_numpy().astype(np.int64)
    return train([b.as_py() for b in rows["_bag"]], y, buckets)


def score_column(text: Column, model: ToxicModel, spark) -> Column:
    """Score of a whole text. The weights (half a megabyte at the default size) are broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        kept = _KEPT.setdefault(shared.value.weights.tobytes()[:64], {})
        return pa.array([shared.value.score(t.as_py(), kept) for t in texts], pa.float64())

    return score(text)


_KEPT: dict[bytes, dict[str, float]] = {}


def score_documents(documents: DataFrame, model: ToxicModel) -> DataFrame:
    scored = documents.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 0).alias("held_out"),
        score_column(F.col("text"), model, documents.sparkSession).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
