"""Quality rules whose cutoffs carry a guarantee against rejecting good documents.

Every rule rejects documents above a cutoff of one ratio (symbols, repeated lines, repeated words, word
length from above and below). Within a stratum the cutoffs of all rules are tightened along one path, a
step of one rule at a time. The path is fixed by other rows than those it is tested on: next comes the
rule and cutoff that rejects most rows labelled bad for each unlabelled row it rejects. Rows labelled good
then decide how far it goes: a place is allowed if the exact binomial tail shows, at the level left after
correction for the strata, that the rules reject together at most ``risk`` of the good documents. Places
are tried from the loosest on, each at the full level, up to the first that fails (fixed-sequence
testing); the number of bands divides the level (Bonferroni). So with probability 1 - ``error`` no stratum
loses more than ``risk`` of its good documents to all rules together.

Strata are bands of the number of words. A band with fewer good rows than a test without any rejection
needs (217 at the settings below) is joined with its neighbour, and the guarantee then is for the joined
stratum. With fewer good rows in all bands together, no rule rejects. Rows of the held-out fold are not used.

Null and empty texts have no words, so they fail the base rule. Of several labels of a document the
greatest counts. Repeated documents are judged alike. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cascata.llm.common import fold_of, store

RISK, ERROR = 0.02, 0.05
BANDS = (50, 200, 1000)
GRID = 200
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: Rule name, numerator, denominator, and the step of its cutoffs; ratios above the cutoff are rejected.
RULES = (
    ("symbols", "n_symbols", "word_chars", 0.005),
    ("dup_lines", "n_dup_lines", "n_lines", 0.005),
    ("repeat_words", "n_repeat_words", "n_words", 0.005),
    ("long_words", "word_chars", "n_words", 0.1),
    ("short_words", "n_words", "word_chars", 0.005),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def counts(text: str | None) -> tuple[int, ...]:
    data = (text or "").encode()
    words = data.split()
    if not words:
        return 0, 0, 0, 0, 0, 0
    joined = b"".join(words)
    inner = sum(128 <= b < 192 for b in joined) if not joined.isascii() else 0
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(joined) - inner,
        sum(data.count(s) for s in (bytes([b]) for b in SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated(words),
        len(lines),
    )


def repeated(words: list[bytes]) -> int:
    """Words that lie in a window of five that the text holds at least twice."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    hit = np.fromiter((seen[w] > 1 for w in windows), np.int64, len(windows))
    cover = np.zeros(len(words) + 1, np.int64)
    cover[:len(windows)] += hit
    cover[WINDOW : WINDOW + len(windows)] -= hit
    return int((np.cumsum(cover) > 0).sum())


_COUNTED = StructType([StructField(name, LongType()) for name in COUNTS])


def counted(text: Column) -> Column:
    @F.arrow_udf(_COUNTED)
    def count(texts: pa.Array) -> pa.Array:
        rows = np.array([counts(t.as_py()) for t in texts], dtype=np.int64).reshape(-1, len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(c) for c in rows.T], names=list(COUNTS))

    return count(text)


def measure(documents: DataFrame) -> DataFrame:
    """Counts of every whole text, written once: seven numbers a row."""
    found = documents.select("doc_id", counted(F.col("text")).alias("_c")).select("doc_id", "_c.*")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return store(found.withColumn("base_failed", failed), "counts")


def band() -> Column:
    """Stratum: the band of the number of words."""
    found = F.lit(0)
    for k, edge in enumerate(BANDS):
        found = F.when(F.col("n_words") >= edge, k + 1).otherwise(found)
    return found


def ratio_step(above: str, below: str, step: float) -> Column:
    """Number of the cutoff step that a ratio lies in; a cutoff k rejects steps greater than k."""
    return F.coalesce(F.least(F.floor(F.try_divide(F.col(above), F.col(below)) / step), F.lit(GRID)), F.lit(0)).cast("int")


def tail(rejected: int, good: int, rate: float) -> float:
    """Probability of at most ``rejected`` of ``good`` rejections if the true rate is ``rate``."""
    if rejected >= good:
        return 1.0
    logs = [
        math.lgamma(good + 1) - math.lgamma(k + 1) - math.lgamma(good - k + 1)
        + k * math.log(rate) + (good - k) * math.log1p(-rate)
        for k in range(rejected + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def least_good(risk: float, level: float) -> int:
    """Good rows that a test without any rejection needs."""
    return math.ceil(math.log(level) / math.log1p(-risk))


def strata(good: list[int], least: int) -> list[list[int]]:
    """Neighbouring bands joined until each stratum has ``least`` good rows; none if all have too few."""
    found, open_ = [], []
    for k in range(len(good)):
        open_ = [*open_, k]
        if sum(good[j] for j in open_) >= least:
            found.append(open_)
            open_ = []
    if found:
        found[-1] = found[-1] + open_
    return found


def path(bad: dict, other: dict) -> list[tuple[str, int]]:
    """Cutoffs of all rules from the loosest on, as (rule, cutoff), one step of one rule at a time.

    ``bad`` and ``other`` have numbers of rows by (rule, step).
    """
    at = {name: GRID for name, *_ in RULES}
    out = []
    while any(at.values()):
        best = None
        for name, limit in at.items():
            b = u = 0
            for k in range(limit - 1, -1, -1):
                b += bad.get((name, k + 1), 0)
                u += other.get((name, k + 1), 0)
                score = (b / (u + 1), -u, k)
                if best is None or score > best[0]:
                    best = (score, name, k)
        _, name, k = best
        out += [(name, j) for j in range(at[name] - 1, k - 1, -1)]
        at[name] = k
    return out


def allowed(rejected: dict[int, int], good: int, places: int, risk: float, level: float) -> int:
    """How many places of a path pass; ``rejected`` has good rows by the first place that rejects them."""
    total = 0
    for t in range(places):
        total += rejected.get(t, 0)
        if total > risk * good or tail(total, good, risk) > level:
            return t
    return places


def first_place(paths: dict[int, list]) -> Column:
    """First place of a row's path that rejects it; null if none does. ``paths`` are by band."""
    found = F.lit(None).cast("int")
    for k, steps in paths.items():
        places = []
        for name, a, b, s in RULES:
            # A cutoff k rejects steps greater than k, and a path tightens every rule step by step.
            first = {cut + 1: t for t, (rule, cut) in enumerate(steps) if rule == name}
            listed = ", ".join(str(first[x]) if x in first else "int(null)" for x in range(GRID + 1))
            places.append(F.get(F.expr(f"array({listed})"), ratio_step(a, b, s)))
        found = F.when(band() == k, F.least(*places)).otherwise(found)
    return found


def fit(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> dict:
    """Cutoffs by (band, rule). Good rows are those labelled 1 that pass the base rule."""
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y"))
        .where("_id is not null and _y in (0, 1)")
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
    )
    held = measured.where("not base_failed").where(fold_of(F.col("doc_id")) != 0)
    rows = held.join(known, F.col("doc_id") == F.col("_id"), "left")
    steps = F.explode(
        F.array(*[
            F.struct(F.lit(name).alias("rule"), ratio_step(a, b, s).alias("step"))
            for name, a, b, s in RULES
        ])
    )
    # At most three times bands times rules times steps rows.
    found = (
        rows.select(band().alias("band"), F.coalesce("_y", F.lit(-1)).alias("y"), steps.alias("_s"))
        .groupBy("band", "y", "_s.rule", "_s.step")
        .count()
        .collect()
    )
    bands = len(BANDS) + 1
    level = error / bands
    good = [sum(r["count"] for r in found if (r["band"], r["y"], r["rule"]) == (k, 1, RULES[0][0])) for k in range(bands)]
    joined = strata(good, least_good(risk, level))
    cutoffs = {(k, name): GRID for k in range(bands) for name, *_ in RULES}
    paths = {}
    for stratum in joined:
        bad, other = Counter(), Counter()
        for r in found:
            if r["band"] in stratum and r["y"] != 1:
                (bad if r["y"] == 0 else other)[r["rule"], r["step"]] += r["count"]
        steps = path(bad, other)
        paths |= {k: steps for k in stratum}
    if not joined:
        return cutoffs
    # At most bands times places rows.
    hit = rows.where("_y = 1").select(band().alias("band"), first_place(paths).alias("t")).groupBy("band", "t").count().collect()
    for stratum in joined:
        rejected = Counter()
        for r in hit:
            if r["band"] in stratum and r["t"] is not None:
                rejected[r["t"]] += r["count"]
        steps = paths[stratum[0]]
        passed = allowed(rejected, sum(good[k] for k in stratum), len(steps), risk, level)
        for name, cut in steps[:passed]:
            cutoffs |= {(k, name): cut for k in stratum}
    return cutoffs


def rejected_by(cutoffs: dict) -> Column:
    """Names of the rules that reject a row."""
    rejects = []
    for name, a, b, s in RULES:
        limit = F.element_at(
            F.create_map(*[F.lit(x) for k in range(len(BANDS) + 1) for x in (k, cutoffs[k, name])]), band()
        )
        rejects.append(F.when(ratio_step(a, b, s) > limit, F.lit(name)))
    return F.array_compact(F.array(*rejects))


def judge_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    measured = measure(documents)
    cutoffs = fit(measured, labels)
    return measured.withColumn("rejected_by", rejected_by(cutoffs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"), "rejected_by",
    )
