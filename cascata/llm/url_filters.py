"""URL filters by a cascade of Bloom filters with exact membership.

A rule is a host and a path, and fits a url whose host is the rule's or a subdomain of it and whose
path starts with the rule's. A url asks for few keys: each suffix of its host at a label border with
each prefix of its path that has the length of some rule's path. The key universe is all keys that the
corpus asks for. Level 1 of a cascade holds the listed keys, level 2 the other keys of the universe
that pass level 1, level 3 the listed keys that pass level 2, and so on until a level lets nothing
wrong pass. For a key of the universe the first level that rejects it tells, without error, whether it
is listed; no join is needed. One cascade holds the allowed keys and one the blocked ones.

Spark makes the universe and tests it level by level; the bits of a level are set on executors (one
row a word of bits) and only the filter comes to the driver, whose size is checked against
``MOST_BYTES`` before it is broadcast. Beyond that the keys are joined with the list instead.

Null urls and urls without "://" have an empty host and path: no key, no rule, verdict "allow". The
longest fitting rule (host and path) wins; of a rule listed twice "block" wins. Urls of any length are
cut once. Repeated pages are judged alike. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascata.llm.common import store

MOST_BYTES = 64 << 20
FIRST_RATE, LATER_RATE = 0.05, 0.5
LEVELS = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    tail = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(tail, r"^([^/?#]*)", 1)
    path = F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def asked_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Keys of a url, each the host's suffix and the path's prefix, the longest key first."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    prefixes = F.array_compact(
        F.array(*[
            F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(set(lengths), reverse=True)
        ])
    )
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    by_size = F.array_sort(
        F.array_distinct(keys), lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).otherwise(0)
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(by_size)


@dataclass
class Level:
    bits: np.ndarray
    hashes: int


@dataclass
class Cascade:
    """Levels of bits; a key is listed if the number of levels it passes in a row is odd."""

    levels: list[Level] = field(default_factory=list)

    @property
    def bytes(self) -> int:
        return sum(level.bits.nbytes for level in self.levels)

    def listed(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        depth, live = np.zeros(len(first), np.int64), np.ones(len(first), bool)
        for n, level in enumerate(self.levels):
            live &= passes(level, n, first, second)
            depth += live
        return depth % 2 == 1


def spots(words: int, hashes: int, number: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Bit numbers of keys in level ``number``: double hashing of two 64-bit hashes."""
    a = first.astype(np.uint64) * np.uint64(2 * number + 1) + np.uint64(number * 0x9E3779B97F4A7C15 % 2**64)
    a ^= a >> np.uint64(31)
    b = second.astype(np.uint64) | np.uint64(1)
    k = np.arange(hashes, dtype=np.uint64)
    mixed = a[:, None] + k[None, :] * b[:, None]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))) % np.uint64(64 * words)


def passes(level: Level, number: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    at = spots(len(level.bits), level.hashes, number, first, second)
    return ((level.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("_h1", "_h2"))


def make_level(keys: DataFrame, count: int, rate: float, number: int) -> Level | None:
    """Bits of the keys, set on executors and gathered by word; None if the filter would be too large."""
    words = max(1, math.ceil(-count * math.log(rate) / math.log(2) ** 2 / 64))
    if words * 8 > MOST_BYTES:
        return None
    hashes = max(1, round(-math.log2(rate)))

    def set_bits(batches):
        for batch in batches:
            at = spots(words, hashes, number, *_hashes(batch)).ravel()
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_pydict({"w": word, "b": bit.view(np.int64)})

    rows = (
        keys.select("_h1", "_h2").mapInArrow(set_bits, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b"))
    ).toArrow()
    bits = np.zeros(words, np.uint64)
    bits[rows["w"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
    return Level(bits, hashes)


def build(universe: DataFrame, listed: DataFrame) -> Cascade | None:
    """Cascade for ``listed`` over ``universe``: both have one row a key with ``_h1`` and ``_h2``.

    Listed keys that nothing in the universe asks for are left out. None if a filter gets too large.
    """
    wanted = listed.join(universe, ["_h1", "_h2"], "left_semi")
    others = universe.join(listed, ["_h1", "_h2"], "left_anti")
    sides, cascade, spark = [store(wanted, "listed"), store(others, "others")], Cascade(), universe.sparkSession
    for number in range(LEVELS):
        inside, outside = sides[number % 2], sides[1 - number % 2]
        count = inside.count()
        if not count:
            return cascade
        level = make_level(inside, count, FIRST_RATE if number == 0 else LATER_RATE, number)
        if level is None or cascade.bytes + level.bits.nbytes > MOST_BYTES:
            return None
        cascade.levels.append(level)
        shared = spark.sparkContext.broadcast(level)

        def wrong(batches, shared=shared, number=number):
            for batch in batches:
                yield batch.filter(pa.array(passes(shared.value, number, *_hashes(batch))))

        sides[1 - number % 2] = store(
            outside.select("_h1", "_h2").mapInArrow(wrong, "_h1 long, _h2 long"), "passed"
        )
    return None


def key_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit("second"), key).alias("_h2")]


def listed_flags(keys: Column, cascade: Cascade, spark) -> Column:
    """For an array of keys whether each is listed; the keys must belong to the universe."""
    shared = spark.sparkContext.broadcast(cascade)

    @F.arrow_udf("array<boolean>")
    def flags(h1: pa.Array, h2: pa.Array) -> pa.Array:
        first, second = (h.flatten().to_numpy(zero_copy_only=False).view(np.uint64) for h in (h1, h2))
        counts = np.diff(h1.offsets.to_numpy())
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(shared.value.listed(first, second)))

    return flags(
        F.transform(keys, lambda k: F.xxhash64(k)), F.transform(keys, lambda k: F.xxhash64(F.lit("second"), k))
    )


def judge_pages(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``rules``: verdict, host, path. ``page_id, host, path, rule, verdict``."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    lengths = [len(p) for _, _, p in rules] or [0]
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    asked = split.withColumn("_keys", asked_keys(F.col("host"), F.col("path"), lengths))
    universe = store(
        asked.select(F.explode("_keys").alias("_k")).select(*key_hashes(F.col("_k"))).distinct(), "universe"
    )
    verdicts = {h + p: v for v, h, p in sorted(rules)}
    listed = spark.createDataFrame([(k, v) for k, v in verdicts.items()], "_k string, _v string")
    hits = {}
    for verdict in ("allow", "block"):
        keys = listed.where(F.col("_v") == verdict).select(*key_hashes(F.col("_k")))
        cascade = build(universe, keys)
        if cascade is None:
            return judge_by_join(asked, listed)
        hits[verdict] = listed_flags(F.col("_keys"), cascade, spark)
    flagged = asked.withColumn("_allow", hits["allow"]).withColumn("_block", hits["block"])
    # Keys go from the longest to the shortest, so the first that is listed on either side decides.
    first = F.get(
        F.filter(
            F.arrays_zip("_keys", "_allow", "_block"), lambda x: x["_allow"] | x["_block"]
        ), F.lit(0),
    )
    return flagged.withColumn("_hit", first).select(
        "page_id", "host", "path", F.col("_hit._keys").alias("rule"),
        F.when(F.col("_hit._block"), "block").otherwise("allow").alias("verdict"),
    )


def judge_by_join(asked: DataFrame, listed: DataFrame) -> DataFrame:
    """The same verdicts by a join, for lists whose filters are too large to broadcast."""
    rows = asked.withColumn("_n", F.monotonically_increasing_id())
    rows = store(rows, "asked")
    found = (
        rows.select("_n", F.explode("_keys").alias("_k"))
        .join(listed, "_k")
        .groupBy("_n")
        .agg(F.max_by(F.struct("_k", "_v"), F.length("_k")).alias("_hit"))
    )
    return rows.join(found, "_n", "left").select(
        "page_id", "host", "path", F.col("_hit._k").alias("rule"), F.coalesce("_hit._v", F.lit("allow")).alias("verdict")
    )
