"""SimHash near duplicates by a generalised pigeonhole principle.

A fingerprint has one bit for each position that is set in over half of a text's shingle hashes.
Texts with equal fingerprints meet in one grouping; everything below works on distinct fingerprints.

Bits are grouped into partitions, correlated bits together (greedily, on a bounded sample). A query
fingerprint gets a threshold per partition, at least -1 (skipped), with thresholds plus one summing to
radius plus one: two fingerprints within the radius then agree, in some partition, within that
partition's threshold. The thresholds are chosen per query by dynamic programming over candidate
counts estimated on the sample, so values that many fingerprints share are skipped where others are
rarer. Each fingerprint is indexed once a partition, is probed with all values within the thresholds,
and candidates are verified on all bits. Nothing is capped: the sample only steers costs.

Groups are connected components by alternating large and small stars over the links.

A text without a word has fingerprint zero and is linked like any other. Null texts are empty texts. A
group whose ids are all null has a null component. Rows with equal ids count separately. An empty table
gives an empty result. Extra columns are ignored by ``near_groups`` and carried by ``keep_one``. Texts are
read whole, however long: their hashes are counted in chunks.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascata.llm.common import release, spare, store, text_key

SEED = 42
SAMPLE = 2048
CHUNK = 1 << 15
#: Odd factors that turn one 64-bit hash into further ones, for fingerprints of over 64 bits.
SPREAD = (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words, repeats included; of all words if there are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[: len(words) - width + 1].tolist(), end[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last)), np.uint64, len(first))


def fingerprint(hashes: np.ndarray, words: int = 1) -> list[int]:
    """``words`` times 64 bits as signed integers; zero without hashes."""
    out = []
    for factor in SPREAD[:words]:
        total = np.zeros(64, np.int64)
        for at in range(0, len(hashes), CHUNK):
            part = hashes[at : at + CHUNK]
            if factor != 1:
                part = (part ^ (part >> np.uint64(32))) * np.uint64(factor)
                part ^= part >> np.uint64(29)
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.sum(axis=0, dtype=np.int64)
        mask = np.packbits(2 * total > len(hashes), bitorder="little").view(np.int64)[0]
        out.append(int(mask))
    return out


def fingerprint_column(text: Column, width: int, words: int = 1, distinct: bool = False) -> Column:
    @F.arrow_udf("array<bigint>")
    def fingerprints(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            hashes = shingle_hashes(t.as_py(), width)
            rows.append(fingerprint(np.unique(hashes) if distinct else hashes, words))
        flat = np.array(rows, dtype=np.int64).reshape(-1)
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * words
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return fingerprints(text)


def matrix(arrays: pa.Array, words: int) -> np.ndarray:
    return arrays.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, words)


def bits_of(rows: np.ndarray) -> np.ndarray:
    """One 0/1 column a bit."""
    return np.unpackbits(np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), 8 * rows.shape[1]), axis=1, bitorder="little")


def correlated_partitions(bits: np.ndarray, count: int) -> list[list[int]]:
    """Bits in ``count`` groups of near equal size; each starts with one and takes those most like it."""
    n = bits.shape[1]
    if len(bits) > 1:
        centred = bits - bits.mean(axis=0)
        norm = np.sqrt((centred**2).sum(axis=0)) + 1e-9
        like = np.abs(centred.T @ centred) / np.outer(norm, norm)
    else:
        like = np.zeros((n, n))
    left, groups = list(range(n)), []
    for k in range(count):
        size = len(left) // (count - k)
        group = [max(left, key=lambda b: (like[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (like[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


@dataclass
class Probing:
    """Partitions, the sample's values in each, and what is needed to choose thresholds."""

    parts: list[list[int]]
    sample: np.ndarray
    total: int
    radius: int
    words: int

    @classmethod
    def of(cls, sample: np.ndarray, total: int, radius: int, words: int, count: int) -> Probing:
        probing = cls(correlated_partitions(bits_of(sample).astype(float), count), sample, total, radius, words)
        probing.sample = probing.values(sample)
        return probing

    def values(self, rows: np.ndarray) -> np.ndarray:
        """Value of each partition, a column a partition."""
        bits = bits_of(rows).astype(np.uint64)
        return np.stack([
            (bits[:, p] << np.arange(len(p), dtype=np.uint64)).sum(axis=1, dtype=np.uint64) for p in self.parts
        ], axis=1)

    def most(self) -> int:
        """Largest threshold that is considered for one partition."""
        return min(self.radius, 2)

    def thresholds(self, values: np.ndarray) -> np.ndarray:
        """A threshold a row and partition by dynamic programming over estimated costs.

        A cost is the values to probe plus the candidates expected: those of the sample scaled up, plus
        what evenly spread bits would give.
        """
        rows, count, most = len(values), len(self.parts), self.most()
        costs = np.zeros((rows, count, most + 2))
        for p, part in enumerate(self.parts):
            apart = np.bitwise_count(values[:, p, None] ^ self.sample[None, :, p])
            for t in range(most + 1):
                ball = sum(comb(len(part), k) for k in range(t + 1))
                near = (apart <= t).sum(axis=1) * (self.total / max(1, len(self.sample)))
                costs[:, p, t + 1] = ball + near + self.total * ball / 2.0 ** len(part)
        need = self.radius + 1
        best = np.full((rows, need + 1), np.inf)
        best[:, 0] = 0
        taken = np.zeros((rows, count, need + 1), np.int8)
        for p in range(count):
            new = np.full_like(best, np.inf)
            for units in range(most + 2):
                cost = best[:, : need + 1 - units] + costs[:, p, units, None]
                better = cost < new[:, units:]
                new[:, units:][better] = cost[better]
                taken[:, p, units:][better] = units
            best = new
        left, out = np.full(rows, need), np.zeros((rows, count), np.int64)
        for p in range(count - 1, -1, -1):
            out[:, p] = taken[np.arange(rows), p, left]
            left -= out[:, p]
        return out - 1

    def masks(self, part: int, threshold: int) -> np.ndarray:
        """All differences of at most ``threshold`` bits."""
        size = len(self.parts[part])
        return np.array(
            [sum(1 << b for b in c) for k in range(threshold + 1) for c in combinations(range(size), k)], np.uint64
        )


def probing_of(prints: DataFrame, radius: int, words: int, partitions: int | None = None) -> Probing:
    """Partitions and costs for ``prints``, from a sample of at most ``SAMPLE`` fingerprints."""
    total = prints.count()
    sample = prints.orderBy(F.xxhash64("print"), "node").limit(SAMPLE).select("print").toArrow()["print"]
    rows = matrix(sample.combine_chunks(), words) if total else np.zeros((0, words), np.uint64)
    if partitions is None:
        # About as many bits a partition as the number of fingerprints has.
        partitions = max(radius // 3 + 1, round(64 * words / max(16.0, np.log2(max(2, total)))))
    return Probing.of(rows, total, radius, words, min(partitions, radius + 1))


def keys_of(prints: DataFrame, probing: Probing, probed: bool) -> DataFrame:
    """``part, value`` and the other columns: once a partition, or all values within the thresholds."""
    words = probing.words
    columns = prints.columns

    def entries(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                rows = matrix(piece.column("print"), words)
                values = probing.values(rows)
                limits = probing.thresholds(values) if probed else np.zeros(values.shape, np.int64)
                part, value, row = [], [], []
                for p in range(values.shape[1]):
                    for t in np.unique(limits[:, p]):
                        if t < 0:
                            continue
                        mask, at_t = probing.masks(p, int(t)), np.flatnonzero(limits[:, p] == t)
                        value.append((values[at_t, p, None] ^ mask[None, :]).ravel())
                        row.append(np.repeat(at_t, len(mask)))
                        part.append(np.full(len(at_t) * len(mask), p, np.int32))
                if not row:
                    continue
                row = np.concatenate(row)
                carried = {c: piece.column(c).take(pa.array(row)) for c in columns}
                yield pa.RecordBatch.from_pydict(
                    {"part": np.concatenate(part), "value": np.concatenate(value).view(np.int64), **carried}
                )

    carried = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prints.schema.fields)
    return prints.mapInArrow(entries, f"part int, value long, {carried}")


def distance(a: Column, b: Column, words: int) -> Column:
    parts = [F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(words)]
    return sum(parts[1:], parts[0])


def candidates(prints: DataFrame, radius: int, words: int, partitions: int | None = None, within: int | None = None) -> DataFrame:
    """Pairs ``a < b`` of nodes whose fingerprints differ in at most ``within`` bits.

    ``prints`` has ``node`` and ``print``, one row a distinct fingerprint. Complete up to ``radius``;
    beyond it, up to ``within``, pairs that happen to meet are given as well.
    """
    prints = prints.select("node", "print")
    probing = probing_of(prints, radius, words, partitions)
    index, probe = keys_of(prints, probing, False), keys_of(prints, probing, True)
    a, b = probe.alias("a"), index.alias("b")
    met = a.join(
        b,
        (F.col("a.part") == F.col("b.part")) & (F.col("a.value") == F.col("b.value"))
        & (F.col("a.node") < F.col("b.node"))
        & (distance(F.col("a.print"), F.col("b.print"), words) <= (radius if within is None else within)),
    )
    return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of a link; the root is the least node of its component.

    Alternates large and small stars; every round is written, the one before is deleted.
    """
    edges = store(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = store(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large"
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        stars = store(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
            .union(least.select("u", "m")).distinct(), "stars",
        )
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        release(edges, large)
        edges = stars
        if now == before:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(edges.select(F.col("v"), F.col("v")).distinct())
        before = now


def linked_prints(documents: DataFrame, width: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, _h1, _h2, node, print`` for every row, and ``node, least, root`` for every distinct fingerprint."""
    prints = store(
        documents.select("doc_id", *text_key(F.col("text")), fingerprint_column(F.col("text"), width).alias("print")),
        "prints",
    ).select("doc_id", "_h1", "_h2", F.get("print", F.lit(0)).alias("node"), "print")
    distinct = store(
        prints.groupBy("node").agg(F.first("print").alias("print"), F.min("doc_id").alias("least")), "distinct"
    )
    roots = store(components(candidates(distinct, radius, 1)), "roots")
    linked = distinct.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return prints, linked.select("node", "least", "root")


def near_groups(documents: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row, linked at ``radius`` or fewer bits."""
    prints, linked = linked_prints(documents, width, radius)
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "root").select("node", "component_id")
    return prints.join(named, "node").select(
        "doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(documents: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """One document of each group of ``near_groups``: the one with the least id that the group has.

    Of several texts with that id the one with the least hash stays. Rows that share id and text are one
    document, of which one row stays. Without any id in a group, one of its rows stays.
    """
    prints, linked = linked_prints(documents, width, radius)
    # One row a fingerprint before the groups are joined, so a large group of copies is one row a task.
    order = F.struct(F.col("doc_id").isNull().alias("_z"), "doc_id", "_h1", "_h2")
    best = prints.groupBy("node").agg(F.min(order).alias("_c")).join(linked.select("node", "root"), "node")
    chosen = store(best.groupBy("root").agg(F.min("_c").alias("_c")).select("_c.*"), "chosen")
    k1, k2 = spare(documents, "_k1"), spare(documents, "_k2")
    named = documents.withColumns(dict(zip((k1, k2), _names(F.col("doc_id"), *text_key(F.col("text"))))))
    names = [n.alias(k) for n, k in zip(_names(F.col("doc_id"), F.col("_h1"), F.col("_h2")), (k1, k2))]
    # The join has rows of one document together, so dropping repeats moves nothing again.
    kept = named.join(chosen.select(*names).hint("merge"), [k1, k2], "left_semi")
    return kept.dropDuplicates([k1, k2]).drop(k1, k2)


def _names(doc_id: Column, h1: Column, h2: Column) -> list[Column]:
    """128 bits that name a document: its id and text."""
    return [F.xxhash64(doc_id, h1), F.xxhash64(F.lit("second"), doc_id, h2)]
