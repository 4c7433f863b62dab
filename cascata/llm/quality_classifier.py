"""Quality scores: random Fourier features over document statistics, ridge regression, isotonic steps.

Statistics of whole texts are standardised and squashed, mapped to cosines that approximate a Gaussian
kernel, and fitted to the labels by ridge regression: every partition gives the sums of its normal
equations, those are added up, and the driver solves one small system. Folds 1 to 3 fit the scores,
fold 4 the isotonic calibration (pooled over a bounded number of score bins), fold 0 is held out.

Null, empty and wordless texts have all statistics zero and are scored like any other. Without labels
for fitting every score is 1 (nothing is rejected); without labels for calibrating, scores are the
clipped ridge values. Repeated documents score alike; of several labels the greatest counts. Extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from cascata.llm.common import fold_of, store, sum_arrays

COSINES = 192
BINS = 400
THRESHOLD = 0.3
SYMBOLS = b"#*$%&|<>!_=~^{}[]\\@+"


def statistics(text: str | None) -> list[float]:
    """Fixed list of statistics of a whole text; zeros for a text without a word."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * STATISTICS
    n, size = len(words), len(data)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counted = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in data.split(b"\n") if line.strip()]
    codes = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = codes / size
    capitals, small = share[65:91].sum(), share[97:123].sum()
    symbols = share[list(SYMBOLS)].sum()
    top = counted.most_common(1)[0][1]
    starts = np.fromiter((w[0] for w in words), np.int64, n)
    ends = np.fromiter((w[-1] for w in words), np.int64, n)
    return [
        np.log1p(n),
        lengths.mean(),
        lengths.std(),
        len(counted) / n,
        top / n,
        pairs / max(1, n - 1),
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        capitals,
        capitals / (capitals + small + 1e-9),
        share[48:58].sum(),
        symbols,
        share[124],
        share[33] + share[63],
        share[46] + share[44],
        share[128:].sum(),
        codes[ord("*")] / n,
        float(((starts >= 65) & (starts <= 90)).mean()),
        float(np.isin(ends, list(SYMBOLS)).mean()),
        float((lengths == 1).mean()),
    ]


STATISTICS = 20


def _matrix(arrays: pa.Array) -> np.ndarray:
    flat = arrays.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(arrays), -1)


@dataclass
class Kernel:
    """Standardising and random cosines; ``draws`` come from a fixed seed."""

    mean: np.ndarray
    scale: np.ndarray
    draws: np.ndarray
    shifts: np.ndarray

    @classmethod
    def of(cls, mean, scale, cosines: int = COSINES, width: float = 0.35, seed: int = 11) -> Kernel:
        draw = np.random.default_rng(seed)
        return cls(
            mean, scale, draw.normal(0, width, (len(mean), cosines)), draw.uniform(0, 2 * np.pi, cosines)
        )

    def features(self, x: np.ndarray) -> np.ndarray:
        """Cosines and a constant."""
        z = np.clip((x - self.mean) / self.scale, -4, 4)
        cosines = np.sqrt(2 / len(self.shifts)) * np.cos(z @ self.draws + self.shifts)
        return np.concatenate([cosines, np.ones((len(x), 1))], axis=1)


@dataclass
class QualityModel:
    kernel: Kernel | None
    weights: np.ndarray | None
    steps: np.ndarray
    values: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(x))
        raw = np.clip(self.kernel.features(x) @ self.weights, 0, 1)
        return np.interp(raw, self.steps, self.values) if len(self.steps) else raw


def statistics_column(text: Column) -> Column:
    @F.arrow_udf(ArrayType(DoubleType()))
    def measured(texts: pa.Array) -> pa.Array:
        rows = [statistics(t.as_py()) for t in texts]
        values = np.array(rows, dtype=np.float64).reshape(len(rows), STATISTICS)
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * STATISTICS
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))

    return measured(text)


def labelled(stats: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Statistics and label of rows outside the held-out fold: ``_fold``, ``_x``, ``_y``."""
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
        .where("_id is not null and _y in (0, 1)")
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
    )
    return (
        stats.select(F.col("doc_id").alias("_id"), F.col("stats").alias("_x"))
        .withColumn("_fold", fold_of(F.col("_id")))
        .where("_fold > 0")
        .join(known, "_id")
        .select("_fold", "_x", "_y")
    )


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", ridge: float = 1e-3) -> QualityModel:
    """``stats`` has ``doc_id`` and ``stats``; all labelled rows are used."""
    rows = store(labelled(stats, labels, label), "labelled")
    sums = rows.where("_fold < 4").select(
        F.count("*").alias("n"),
        *[F.sum(F.col("_x")[i]).alias(f"s{i}") for i in range(STATISTICS)],
        *[F.sum(F.col("_x")[i] * F.col("_x")[i]).alias(f"q{i}") for i in range(STATISTICS)],
    ).first()
    if not sums["n"]:
        return QualityModel(None, None, np.zeros(0), np.zeros(0))
    mean = np.array([sums[f"s{i}"] for i in range(STATISTICS)]) / sums["n"]
    square = np.array([sums[f"q{i}"] for i in range(STATISTICS)]) / sums["n"]
    kernel = Kernel.of(mean, np.sqrt(np.maximum(square - mean**2, 1e-12)) + 1e-6)
    size = COSINES + 1

    def equations(batches):
        total = np.zeros(size * (size + 1))
        for batch in batches:
            z = kernel.features(_matrix(batch.column("_x")))
            y = batch.column("_y").to_numpy(zero_copy_only=False).astype(float)
            total += np.concatenate([(z.T @ z).ravel(), z.T @ y])
        yield pa.RecordBatch.from_pydict({"v": pa.array([total.tolist()], pa.list_(pa.float64()))})

    parts = rows.where("_fold < 4").select("_x", "_y").mapInArrow(equations, "v array<double>")
    total = sum_arrays(parts, "v")
    normal, right = total[: size * size].reshape(size, size), total[size * size :]
    weights = np.linalg.solve(normal + ridge * sums["n"] / size * np.eye(size), right)
    model = QualityModel(kernel, weights, np.zeros(0), np.zeros(0))
    raw = rows.where("_fold = 4").withColumn("_raw", stats_score(F.col("_x"), model))
    bins = (
        raw.groupBy(F.least(F.floor(F.col("_raw") * BINS), F.lit(BINS - 1)).alias("bin"))
        .agg(F.count("*").alias("n"), F.sum("_y").alias("good"), F.avg("_raw").alias("at"))
        .orderBy("bin")
        .collect()
    )
    model.steps, model.values = isotonic(
        [r["at"] for r in bins], [r["good"] for r in bins], [r["n"] for r in bins]
    )
    return model


def isotonic(at: list[float], good: list[int], count: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; one middle place and value a block, which ``interp`` joins by lines."""
    blocks: list[list[float]] = []
    for x, g, n in zip(at, good, count):
        blocks.append([x * n, g, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def stats_score(stats: Column, model: QualityModel) -> Column:
    @F.arrow_udf(DoubleType())
    def score(arrays: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(arrays)), pa.float64())

    return score(stats)


def text_score(text: Column, model: QualityModel) -> Column:
    """Score straight from a whole text."""

    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        rows = [statistics(t.as_py()) for t in texts]
        x = np.array(rows, dtype=np.float64).reshape(len(rows), STATISTICS)
        return pa.array(model.score(x), pa.float64())

    return score(text)


def measure(documents: DataFrame) -> DataFrame:
    """Statistics of every document, written once: some 160 bytes a row."""
    return store(documents.select("doc_id", statistics_column(F.col("text")).alias("stats")), "stats")


def score_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    stats = measure(documents)
    model = fit(stats, labels)
    scored = stats.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 0).alias("held_out"),
        stats_score(F.col("stats"), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
