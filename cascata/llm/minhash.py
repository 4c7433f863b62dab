"""Document fingerprints by MinHash, near duplicates by signature bands.

A text's words (split at ASCII blanks, A-Z lower-cased) give the set of its five-word shingles; fewer words
are one shingle, no word gives the empty set. A fingerprint holds, for each of 128 universal hash functions
``(a x + b mod 2**64) >> 32``, the least value over the set. The share of places in which two fingerprints
agree estimates the Jaccard similarity of the sets. The empty set has the greatest value in every place.

Near duplicates: texts that agree in all values of a band meet, and are linked if the exact Jaccard
similarity of their sets is 0.8 or more. With 10 bands of 4 values a pair of just 0.8 meets in 995 of 1,000
cases. Equal texts are one from the start. First every text of a band value is compared with the hub of the
value, the text that meets most others; after that the texts of band values that hold several groups meet by
their rarest shingles, where all pairs of different groups that can be alike enough are found and compared, so
a large group is not paired with itself and no pair that could join two groups is left out.

The next document is the one before in the order of ids, that is by falling id, null ids last, and among
equal ids by text hash; the first one follows the last. Rows that share id and text are one document: each
gets the same result. Null texts are empty texts. Texts are read whole. An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascata.llm.common import release, store, text_key, tidy
from cascata.llm.simhash import components
from cascata.llm.url_filters import MOST_BYTES, make_level, passes

WIDTH = 5
PERMUTATIONS = 128
BANDS, ROWS = 10, 4
SIMILARITY = 0.8
SEED = 11
#: Counters of shingles, a power of two; they put rare shingles first.
COUNTERS = 1 << 17
#: Words that are hashed at once, and words whose hashes are remembered.
WORDS, WORDS_KEPT = 200_000, 300_000
#: Texts that are compressed and sent at once.
TEXTS = 256
#: Texts remembered in a task, to send each of several copies once.
SEEN = 1 << 16
_WORDS: dict[bytes, int] = {}


@lru_cache(1)
def factors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``a`` and ``b`` of the hash functions, and odd factors of the words of a shingle."""
    drawn = np.random.Generator(np.random.PCG64(SEED)).integers(0, 2**64, (3, PERMUTATIONS), dtype=np.uint64)
    return drawn[0], drawn[1], drawn[2] | np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values stirred one to one."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return values ^ (values >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    found = list(map(_WORDS.get, words))
    if None in found:
        if len(_WORDS) > WORDS_KEPT:
            _WORDS.clear()
        for k, h in enumerate(found):
            if h is None:
                found[k] = _WORDS[words[k]] = xxhash.xxh64_intdigest(words[k], SEED)
    return np.array(found, np.uint64)


def shingles(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of all texts, repeats included, and where those of each text begin."""
    cut = [t.encode().lower().split() for t in texts]
    count = np.fromiter(map(len, cut), np.int64, len(cut))
    words = word_hashes([w for c in cut for w in c])
    many = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    edges = np.concatenate([[0], np.cumsum(many)])
    owner = np.repeat(np.arange(len(cut)), many)
    start = (np.concatenate([[0], np.cumsum(count)])[:-1] - edges[:-1])[owner] + np.arange(edges[-1])
    total, odd = np.zeros(edges[-1], np.uint64), factors()[2]
    size = np.minimum(count, width)[owner]
    padded = np.append(words, np.zeros(width, np.uint64))
    for k in range(width):
        total += np.where(k < size, padded[start + k] * odd[k], np.uint64(0))
    return mixed(total + size.astype(np.uint64)), edges


def batches_of(texts: list[str]):
    """Texts in lists of some ``WORDS`` words."""
    held, room = [], 6 * WORDS
    for t in texts:
        held.append(t)
        room -= len(t)
        if room <= 0:
            yield held
            held, room = [], 6 * WORDS
    if held:
        yield held


def signatures(texts: list[str], width: int = WIDTH, many: int = PERMUTATIONS) -> np.ndarray:
    """One row of ``many`` 32-bit values a text."""
    a, b, _ = factors()
    out = [np.zeros((0, many), np.uint32)]
    for part in batches_of(texts):
        hashes, edges = shingles(part, width)
        x = hashes >> np.uint64(32)
        rows = np.full((len(part), many), 2**32 - 1, np.uint32)
        some = np.flatnonzero(np.diff(edges))
        if len(some):
            at, value = edges[:-1][some], np.empty_like(x)
            for k in range(many):
                np.multiply(x, a[k], out=value)
                value += b[k]
                rows[some, k] = np.minimum.reduceat(value, at) >> np.uint64(32)
        out.append(rows)
    return np.concatenate(out)


def agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left == right).mean(axis=1)


def as_text(rows: np.ndarray) -> list[str]:
    """Eight hex digits a value."""
    return [r.tobytes().hex() for r in rows.astype(">u4")]


def fingerprint_column(text: Column) -> Column:
    """The fingerprint of a text as hex digits."""

    @F.arrow_udf("string")
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array(as_text(signatures(texts.to_pylist())), pa.string())

    return prints(F.coalesce(text, F.lit("")))


# ---- near duplicates -----------------------------------------------------------------------


def band_keys(texts: DataFrame) -> DataFrame:
    """``key, node`` for every band of every text; ``texts`` has ``node, text``."""

    def entries(batches):
        odd, seen = factors()[2][:ROWS], set()
        place = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            nodes, wanted = batch.column("node").to_pylist(), []
            for k, node in enumerate(nodes):
                if node not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(node)
                    wanted.append(k)
            for at in range(0, len(wanted), 1024):
                some = pa.array(wanted[at : at + 1024])
                rows = signatures(batch.column("text").take(some).to_pylist(), many=BANDS * ROWS)
                bands = rows.reshape(len(rows), BANDS, ROWS).astype(np.uint64) * odd
                keys = mixed(bands.sum(axis=2, dtype=np.uint64) + mixed(place + np.uint64(1)))
                carried = batch.column("node").take(pa.array(np.repeat(np.array(some), BANDS)))
                yield pa.RecordBatch.from_pydict({"key": keys.ravel().view(np.int64), "node": carried})

    return texts.mapInArrow(entries, "key long, node binary")


def shingle_set(text: Column) -> Column:
    """Sorted distinct hashes of the shingles of a text."""

    @F.arrow_udf("array<bigint>")
    def hashed(texts: pa.Array) -> pa.Array:
        sets = []
        for part in batches_of(texts.to_pylist()):
            hashes, edges = shingles(part)
            sets += [np.unique(hashes[a:b].view(np.int64)) for a, b in zip(edges[:-1], edges[1:])]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*sets, np.zeros(0, np.int64)])))

    return hashed(F.coalesce(text, F.lit("")))


def jaccard(a: pa.Array, b: pa.Array) -> pa.Array:
    """Similarity of sorted distinct hash lists; two empty ones are alike."""
    out = []
    for x, y in zip(a, b):
        x, y = x.values.to_numpy(), y.values.to_numpy()
        both = len(np.intersect1d(x, y, assume_unique=True))
        union = len(x) + len(y) - both
        out.append(both / union if union else 1.0)
    return pa.array(out, pa.float64())


def parities(values: Column) -> Column:
    """One bit a bucket of a set's hashes: whether an odd number falls into it; four to eight buckets a hash."""

    @F.arrow_udf("binary")
    def folded(sets: pa.Array) -> pa.Array:
        out = []
        for s in sets:
            hashes = s.values.to_numpy()
            size = 1 << max(6, (4 * len(hashes) - 1).bit_length())
            odd = np.bincount(hashes & (size - 1), minlength=size) & 1
            out.append(np.packbits(odd.astype(np.uint8), bitorder="little").tobytes())
        return pa.array(out, pa.binary())

    return folded(values)


def least_difference(a: pa.Array, b: pa.Array) -> pa.Array:
    """Hashes that at least are in one of two sets only, from their parities; the longer one is folded."""
    out = []
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
        if len(x) < len(y):
            x, y = y, x
        while len(x) > len(y):
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        out.append(int(np.bitwise_count(x ^ y).sum()))
    return pa.array(out, pa.int64())


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets are so alike; sets are moved only for pairs that their sizes and parities allow."""
    a, b = (sets.select(F.col("node").alias(x), F.col("n").alias("n" + x), F.col("bits").alias("b" + x)) for x in "ab")
    differ = F.arrow_udf(least_difference, "long")("ba", "bb")
    both = F.col("na") + F.col("nb")
    allowed = (
        pairs.join(a, "a").join(b, "b").where(F.least("na", "nb") >= similarity * F.greatest("na", "nb") - 1e-9)
        .where(differ <= (1 - similarity) / (1 + similarity) * both + 1e-9).select("a", "b")
    )
    a, b = (sets.select(F.col("node").alias(x), F.col("set").alias("s" + x)) for x in "ab")
    alike = F.arrow_udf(jaccard, "double")("sa", "sb") >= similarity
    return store(allowed, "allowed").join(a, "a").join(b, "b").where(alike).select("a", "b")


def open_nodes(index: DataFrame, roots: DataFrame) -> DataFrame:
    """``node, root`` of all texts in a band value that holds texts of several groups."""
    keyed = index.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = keyed.groupBy("key").agg(F.min("root").alias("_a"), F.max("root").alias("_z")).where("_a < _z").select("key")
    return keyed.join(several, "key").select("node", "root").distinct()


def counters_of(sets: DataFrame) -> np.ndarray:
    """How many hashes of all sets fall into each of ``COUNTERS`` cells; counted in tasks, added by cell."""

    def counted(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("set").flatten().to_numpy() & (COUNTERS - 1), minlength=COUNTERS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"c": some, "v": total[some]})

    found = sets.select("set").mapInArrow(counted, "c long, v long").groupBy("c").agg(F.sum("v").alias("v")).toArrow()
    cells = np.zeros(COUNTERS, np.int64)
    cells[found["c"].to_numpy()] = found["v"].to_numpy()
    return cells


def first_shingles(sets: Column, cells, similarity: float) -> Column:
    """The first ``n - ceil(s n) + 1`` shingles of a set, those of the least counters first, with their places.

    A counter of one tells that a shingle is in no other set; it takes a place but is left out.
    """

    @F.arrow_udf("array<struct<token: bigint, p: int>>")
    def first(values: pa.Array) -> pa.Array:
        tokens, place, ends = [], [], [0]
        for s in values:
            hashes = s.values.to_numpy()
            count = cells.value[hashes & (COUNTERS - 1)]
            order = np.lexsort((hashes, count))[: len(hashes) - math.ceil(similarity * len(hashes) - 1e-9) + 1]
            kept = np.flatnonzero(count[order] > 1)
            tokens.append(hashes[order[kept]])
            place.append(kept.astype(np.int32))
            ends.append(ends[-1] + len(kept))
        pairs = pa.StructArray.from_arrays(
            [pa.array(np.concatenate([*tokens, np.zeros(0, np.int64)])), pa.array(np.concatenate([*place, np.zeros(0, np.int32)]))],
            ["token", "p"],
        )
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)

    return first(sets)


def pairs_between(opened: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs of texts of different groups that can be ``similarity`` alike; no such pair is missing.

    The shingles of each set are put in order, rare ones first by counters of fixed number, which steer costs
    only. A pair so alike shares a shingle among the first ones of both: among the first
    ``n - ceil(2 s n / (1 + s)) + 1`` of the smaller set and the first ``n - ceil(s n) + 1`` of the larger.
    What is left of the sets from the first shared place on must reach the overlap needed. Texts that only
    share a passage, or copies edited more than that, differ in rare shingles and do not meet. Sets without
    shingles share all band values, so their hub has linked them.
    """
    # Read twice, so stored: the sets are moved once.
    held = store(opened.join(sets, "node").select("node", "root", "n", "set"), "held")
    cells = opened.sparkSession.sparkContext.broadcast(counters_of(held))
    placed = held.select("node", "root", "n", F.explode(first_shingles(F.col("set"), cells, similarity)).alias("_t"))
    needed = F.col("n") - F.ceil(2 * similarity / (1 + similarity) * F.col("n") - 1e-9) + 1
    rows = store(placed.select("_t.token", "_t.p", "node", "root", "n", (F.col("_t.p") < needed).alias("short")), "prefixes")
    a, b = rows.where("short").alias("a"), rows.alias("b")
    left = F.least(F.col("a.n") - F.col("a.p"), F.col("b.n") - F.col("b.p"))
    met = a.join(
        b,
        (F.col("a.token") == F.col("b.token")) & (F.col("a.root") != F.col("b.root"))
        & (F.struct("a.n", "a.node") < F.struct("b.n", "b.node")) & (F.col("a.n") >= similarity * F.col("b.n") - 1e-9)
        & (left >= similarity / (1 + similarity) * (F.col("a.n") + F.col("b.n")) - 1e-9),
    )
    # Stored, so that Spark knows how few they are before it plans how sets are met with them.
    pairs = met.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()
    close = store(pairs, "close")
    release(rows, held)
    return close


def node_of(text: Column) -> Column:
    """128 bits that name a text."""
    h1, h2 = text_key(text)
    return F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in (h1, h2)]))


def likely(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts whose name may be among the wanted ones, by a Bloom filter of at most ``MOST_BYTES``.

    It spares the move of most other texts; the join that follows decides. More names than the filter can hold
    at one false hit in a hundred only let more others pass.
    """
    halves = [F.conv(F.hex(F.substring("node", at, 8)), 16, -10).cast("long") for at in (1, 9)]
    names = wanted.select(halves[0].alias("_h1"), halves[1].alias("_h2"))
    count = names.count()
    if not count:
        return texts.limit(0)
    bits = min(10 * count, 8 * MOST_BYTES - 64)
    level = texts.sparkSession.sparkContext.broadcast(make_level(names, count, math.exp(-bits * math.log(2) ** 2 / count), 0))

    @F.arrow_udf("boolean")
    def held(first: pa.Array, second: pa.Array) -> pa.Array:
        h1, h2 = (h.to_numpy(zero_copy_only=False).view(np.uint64) for h in (first, second))
        return pa.array(passes(level.value, 0, h1, h2))

    return texts.where(held(*halves))


def linked_texts(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``node, root`` of every text that is linked to a different text; the root names the group."""
    texts = documents.select(node_of(F.col("text")).alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    keys = store(band_keys(texts), "bands")
    # One half of a name tells whether a key has several texts; the rare keys are then joined back.
    half = F.xxhash64("node")
    shared = keys.groupBy("key").agg(F.min(half).alias("_a"), F.max(half).alias("_z")).where("_a < _z").select("key")
    index = store(keys.join(shared, "key").distinct(), "index")
    release(keys)
    # The weight of a text is the number of texts that it meets: the middle of a group of near copies has the most.
    # Stored first, so that Spark knows its size before it plans how texts are met with it.
    sizes = index.groupBy("key").agg(F.count("*").alias("_k"))
    wanted = store(index.join(sizes, "key").groupBy("node").agg(F.sum("_k").alias("weight")), "wanted")
    sets = store(
        likely(texts, wanted).join(wanted.select("node"), "node", "left_semi").select("node", shingle_set(F.col("text")).alias("set"))
        .groupBy("node").agg(F.first("set").alias("set"))
        .select("node", "set", F.size("set").alias("n"), parities(F.col("set")).alias("bits")), "sets",
    )
    roots = store(components(verified(hub_pairs(index, wanted), sets, similarity)), "roots")
    opened = store(open_nodes(index, roots), "open")
    release(index)
    close = pairs_between(opened, sets, similarity)
    more = verified(close, sets, similarity)
    found = store(components(more.unionByName(inner_links(roots))), "linked")
    release(sets, wanted, opened, close)
    return found


def inner_links(roots: DataFrame) -> DataFrame:
    return roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def hub_pairs(index: DataFrame, weights: DataFrame) -> DataFrame:
    """Each node of a key with the key's hub, its node of the greatest weight.

    At most one pair a node and key, so a large group costs no more than its rows.
    """
    keyed = index.join(weights, "node")
    hub = F.max(F.struct("weight", "node")).alias("h")
    met = keyed.join(keyed.groupBy("key").agg(hub), "key").where("node != h.node")
    return met.select(F.least("node", "h.node").alias("a"), F.greatest("node", "h.node").alias("b")).distinct()


def near_classes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, node, class_id`` of every document that has a copy or a near copy; one row for equal rows.

    The class is named by its least id that is not null, if it has one.
    """
    ids = documents.select("doc_id", node_of(F.col("text")).alias("node")).distinct()
    copies = store(ids.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("_n")), "copies")
    linked = copies.join(linked_texts(documents, similarity), "node", "left").where("_n > 1 or root is not null")
    linked = linked.withColumn("root", F.coalesce("root", "node"))
    least = linked.groupBy("root").agg(F.min("least").alias("class_id"))
    named = store(linked.join(least, "root").select("node", "class_id"), "classes")
    return ids.join(named, "node")


# ---- fingerprints of documents and of their edited texts ------------------------------------


def place_of(nulls: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Keys whose byte order is: not null first, falling id, rising text hash."""
    out = np.zeros((len(ids), 17), np.uint8)
    out[:, 0] = nulls
    out[:, 1:9] = (~(ids.view(np.uint64) ^ np.uint64(1 << 63))).astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 9:] = (hashes.view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view("S17").ravel()


def places(batch: pa.RecordBatch) -> np.ndarray:
    ids = batch.column("doc_id")
    return place_of(
        ids.is_null().to_numpy(zero_copy_only=False),
        ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
        batch.column("_h1").to_numpy(zero_copy_only=False).astype(np.int64),
    )


DEALT = "part int, kind int, doc_id long, _h1 long, node binary, text binary, class_id long, n long"
DOCUMENT, NEXT_ONLY = 1, 2


def packed(texts: pa.Array) -> pa.Array:
    """Texts as they are moved: compressed, behind their length in bytes."""
    codec = pa.Codec("zstd", compression_level=3)
    raw = (t.as_buffer() for t in texts)
    return pa.array([None if r is None else r.size.to_bytes(8, "little") + codec.compress(r, asbytes=True) for r in raw], pa.binary())


def unpacked(text: bytes | None) -> str | None:
    if text is None:
        return None
    size = int.from_bytes(text[:8], "little")
    return pa.Codec("zstd").decompress(text[8:], size, asbytes=True).decode() if size else ""


def in_order() -> list[Column]:
    """Ranges one after another; what is only followed comes last, as it opens the next range."""
    follows = F.col("kind") == NEXT_ONLY
    return [F.col("part"), follows, F.col("doc_id").desc_nulls_last(), F.col("_h1"), F.col("node"), F.col("kind")]



def range_starts(documents: DataFrame, count: int) -> np.ndarray:
    """First key of each of ``count`` ranges of documents, from a sort of ids and hashes alone."""
    ids = documents.select("doc_id", text_key(F.col("text"))[0])
    order = [F.col("doc_id").desc_nulls_last(), F.col("_h1")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), F.bitwise_not("doc_id").alias("d"), "_h1"))
    dealt = ids.repartitionByRange(count, *order).groupBy(F.spark_partition_id().alias("p")).agg(first.alias("f"))
    rows = [r.f for r in dealt.collect()]
    if not rows:
        return np.zeros(0, "S17")
    return np.sort(place_of(
        np.array([r.z for r in rows]), np.array([0 if r.d is None else ~r.d for r in rows], np.int64), np.array([r._h1 for r in rows], np.int64)
    ))


def dealer(starts: np.ndarray):
    """Rows with the number of their range; the first document of a range goes to the range before as well.

    Of rows that share id and text a task sends the first with its text, and later only their number.
    """

    def deal(batches):
        seen: Counter = Counter()
        count = len(starts)

        def made(batch, rows, part, kind, n):
            for at in range(0, len(rows), TEXTS):
                some = slice(at, at + TEXTS)
                taken = batch.take(pa.array(rows[some]))
                columns = {"part": pa.array(part[some], pa.int32()), "kind": pa.array([kind] * len(taken), pa.int32())}
                columns |= {c: taken.column(c) for c in ("doc_id", "_h1", "node")} | {"text": packed(taken.column("text"))}
                yield pa.RecordBatch.from_pydict(
                    {**columns, "class_id": pa.nulls(len(taken), pa.int64()), "n": pa.array([n] * len(taken), pa.int64())}
                )

        def repeats():
            many = [(p, d, h, node, n) for (p, d, h, node), n in seen.items() if n]
            seen.clear()
            if many:
                part, ids, hashes, nodes, n = zip(*many)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(part, pa.int32()), "kind": pa.array([DOCUMENT] * len(many), pa.int32()),
                    "doc_id": pa.array(ids, pa.int64()), "_h1": pa.array(hashes, pa.int64()),
                    "node": pa.array(nodes, pa.binary()), "text": pa.nulls(len(many), pa.binary()),
                    "class_id": pa.nulls(len(many), pa.int64()), "n": pa.array(n, pa.int64()),
                })

        for batch in batches:
            key = places(batch)
            part = np.searchsorted(starts, key, side="right") - 1
            edge = starts[part] == key
            names = zip(part.tolist(), *(batch.column(c).to_pylist() for c in ("doc_id", "_h1", "node")))
            rows = []
            for k, name in enumerate(names):
                if name in seen:
                    seen[name] += 1
                else:
                    seen[name] = 0
                    rows.append(k)
            rows = np.array(rows, np.int64)
            if len(rows):
                yield from made(batch, rows, part[rows], DOCUMENT, 1)
            rows = rows[edge[rows]]
            if len(rows):
                yield from made(batch, rows, (part[rows] - 1) % count, NEXT_ONLY, 0)
            if len(seen) >= SEEN:
                yield from repeats()
        yield from repeats()

    return deal


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first ones of the text that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, class_id long"
)


def compared(batches):
    """Results of the documents of whole ranges, which come in order; see ``DEALT``."""
    held: list = []  # part, id, node, class, rows, text, whether it is a document

    def results(docs):
        texts = [d[5] for d in docs]
        own = signatures(texts)
        live = [k for k in range(len(docs) - 1) if docs[k][6] and docs[k][0] == docs[k + 1][0]]
        changed = [edited(texts[k], texts[k + 1]) for k in live]
        other = signatures(changed)
        many = [docs[k][4] for k in live]
        index = np.repeat(np.arange(len(live)), many)
        at = np.array(live, np.int64)
        shown, changed_shown = as_text(own[at]), as_text(other)
        rows = {
            "doc_id": [docs[k][1] for k in live], "n_chars": [len(texts[k]) for k in live],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": shown, "edited_fingerprint": changed_shown,
            "near_edited": agreement(own[at], other), "near_next": agreement(own[at], own[at + 1]),
            "class_id": [docs[k][3] for k in live],
        }
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
        table = pa.RecordBatch.from_pydict({c: pa.array(v, t) for (c, v), t in zip(rows.items(), kinds)})
        return table.take(pa.array(index))

    room, marks = 0, {}
    for batch in batches:
        columns = [batch.column(c) for c in ("part", "kind", "doc_id", "node", "text", "class_id", "n")]
        for part, kind, doc_id, node, text, class_id, n in zip(*(c.to_pylist() for c in columns)):
            name = (part, doc_id, node)
            if kind == 0:
                marks = {name: class_id}
                continue
            again = held and held[-1][:3] == [*name]
            if again and held[-1][6] == (kind == DOCUMENT):
                held[-1][4] += n
                held[-1][5] = unpacked(text) if held[-1][5] is None else held[-1][5]
                continue
            if len(held) > 1 and room > 6 * WORDS:
                yield results(held)
                held, room = held[-1:], 0
            text = unpacked(text)
            held.append([*name, marks.get(name, doc_id), n, text, kind == DOCUMENT])
            room += len(text or "")
    if len(held) > 1:
        yield results(held)


def fingerprint_documents(documents: DataFrame, partitions: int | None = None) -> DataFrame:
    """Every document's fingerprint, that of its edited text, how alike they and the next one's are, its class.

    ``class_id`` is the least id of its near duplicates, itself included. Texts are moved once, compressed, to ranges
    of ids of about equal numbers of documents; classes travel with them.
    """
    spark = documents.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with tidy(spark):
        classes = store(near_classes(documents), "classes")
        starts = range_starts(documents, count)
    if not len(starts):
        return documents.sparkSession.createDataFrame([], RESULT)
    rows = documents.select(
        "doc_id", text_key(F.col("text"))[0], node_of(F.col("text")).alias("node"), F.coalesce("text", F.lit("")).alias("text")
    )
    dealt = rows.mapInArrow(dealer(starts), DEALT)

    @F.arrow_udf("int")
    def range_of(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        key = places(pa.RecordBatch.from_pydict({"doc_id": ids, "_h1": hashes}))
        return pa.array(np.searchsorted(starts, key, side="right") - 1, pa.int32())

    half = F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("long")
    marks = classes.select("doc_id", half.alias("_h1"), "node", "class_id").select(
        range_of("doc_id", "_h1").alias("part"), F.lit(0).alias("kind"), "doc_id", "_h1", "node",
        F.lit(None).cast("binary").alias("text"), "class_id", F.lit(0).cast("long").alias("n"),
    )
    ordered = dealt.unionByName(marks).repartitionById(count, F.col("part")).sortWithinPartitions(*in_order())
    return ordered.mapInArrow(compared, RESULT)
