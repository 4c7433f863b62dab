"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

Words are runs of letters and digits, lower-cased. A document overlaps an item if, at one alignment, a
window of twelve words agrees in at least ten, so up to two words may be substituted anywhere in it.
Two fixed masks of five selected positions find every such window: whichever two of twelve places
differ, one of the masks fits between them at some shift. Hashes of the selected words of documents
and items are joined; each hit gives an alignment, whose windows are then compared word by word.

Items of fewer than twelve words have to occur whole and unchanged. Items without a word match
nothing. Null and empty texts overlap nothing. Rows that share id and text are one document; an item
is known by id and text. The result has one row a document and item. Extra columns are ignored.

The item seeds are broadcast if they are at most ``MOST_SEEDS`` rows (counted first, 32 bytes each);
a larger benchmark is joined by shuffling hashes. Texts are read again for the documents that were hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascata.llm.common import spare, store, text_key

WINDOW, AGREE = 12, 10
MASKS = ((0, 1, 3, 4, 5), (0, 1, 4, 6, 7))
MOST_SEEDS = 1_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def seeds_of(hashes: Column, mask: tuple[int, ...], number: int) -> Column:
    """Hash of the selected words at every shift of a mask."""
    shifts = F.size(hashes) - mask[-1]
    found = F.transform(
        F.sequence(F.lit(0), shifts - 1),
        lambda i: F.xxhash64(F.lit(number), *[F.get(hashes, i + k) for k in mask]),
    )
    return F.when(shifts > 0, found).otherwise(F.array().cast("array<bigint>"))


def named_items(benchmark: DataFrame) -> DataFrame:
    """``_i, item_id, _iw``: a number, the id and the words of each item that has any."""
    items = benchmark.select("item_id", F.col("text").alias("_t")).distinct()
    return items.select(
        F.xxhash64("item_id", "_t").alias("_i"), "item_id", words_of(F.col("_t")).alias("_iw")
    ).where(F.size("_iw") > 0)


def named_documents(documents: DataFrame) -> DataFrame:
    """Adds ``_d``, a number for a document's id and text."""
    return documents.withColumn("_d", F.xxhash64("doc_id", *text_key(F.col("text"))))


def alignments(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct ``_d, _i, _at``: word 0 of the item would stand at word ``_at`` of the document."""
    short = [
        r[0] for r in items.select(F.size("_iw")).where(F.size("_iw") < WINDOW).distinct().collect()
    ]
    # A mask for long items and, for each length of short ones that occurs (at most eleven), all words.
    masks = [*MASKS, *[tuple(range(n)) for n in sorted(short)]]
    hashed = items.withColumn("_ih", F.transform("_iw", lambda w: F.xxhash64(w)))
    sides = []
    for number, mask in enumerate(masks):
        long = number < len(MASKS)
        fits = F.size("_iw") >= WINDOW if long else F.size("_iw") == len(mask)
        sides.append(
            hashed.where(fits).select("_i", F.posexplode_outer(seeds_of(F.col("_ih"), mask, number)).alias("_p", "_s"))
            .where("_s is not null")
            .select("_s", "_i", "_p", F.lit(number).alias("_m"))
        )
    seeds = sides[0]
    for side in sides[1:]:
        seeds = seeds.unionByName(side)
    seeds = store(seeds.distinct(), "seeds")
    words = named_documents(documents.select("doc_id", "text")).select("_d", words_of(F.col("text")).alias("_w"))
    hashes = words.select("_d", F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    arrays = hashes.select(
        "_d", F.size("_h").alias("_n"),
        F.concat(*[seeds_of(F.col("_h"), mask, n) for n, mask in enumerate(masks)]).alias("_all"),
    )
    # Outer: for the plain form Spark adds a filter that works all hashes out anew for each of them.
    asked = arrays.select("_d", "_n", F.posexplode_outer("_all").alias("_q", "_s"))
    if seeds.count() <= MOST_SEEDS:
        seeds = F.broadcast(seeds)
    # Seeds of one mask follow those of the masks before it.
    before, offset = F.lit(0), F.lit(0)
    for number, mask in enumerate(masks):
        offset = F.when(F.col("_m") == number, before).otherwise(offset)
        before = before + F.greatest(F.col("_n") - mask[-1], F.lit(0))
    return asked.join(seeds, "_s").select("_d", "_i", (F.col("_q") - offset - F.col("_p")).alias("_at")).distinct()


def overlaps(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, doc_start, doc_end, item_start, agreeing, _d``: word ranges, ends excluded."""
    items = store(named_items(benchmark), "items")
    hits = store(alignments(documents, items), "hits")
    texts = named_documents(documents.select("doc_id", "text"))
    # By shuffling at every size: hit lists grow with the documents.
    found = texts.join(hits.hint("merge"), "_d").join(items, "_i")
    # The words go in as an argument, not into a function: there Spark would cut the text for each word.
    lead = F.greatest(-F.col("_at"), F.lit(0))
    beside = F.slice(words_of(F.col("text")), F.greatest(F.col("_at"), F.lit(0)) + 1, F.size("_iw") - lead)
    agree = F.zip_with(
        F.slice("_iw", lead + 1, F.size("_iw")), beside, lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0))
    )
    aligned = store(
        found.select(
            "doc_id", "item_id", "_d", "_i", "_at", F.size("_iw").alias("_n"),
            F.concat(F.array_repeat(F.lit(0), lead), agree).alias("_ok"),
        ), "aligned",
    )
    width = F.least(F.col("_n"), F.lit(WINDOW))
    least = F.when(F.col("_n") < WINDOW, F.col("_n")).otherwise(F.lit(AGREE))
    starts = F.filter(
        F.sequence(F.lit(0), F.col("_n") - width),
        lambda i: F.aggregate(F.slice("_ok", i + 1, width), F.lit(0), lambda s, x: s + x) >= least,
    )
    verified = aligned.withColumn("_s", starts).where(F.size("_s") > 0).select(
        "doc_id", "item_id", "_d", "_i",
        (F.col("_at") + F.array_min("_s")).alias("doc_start"),
        (F.col("_at") + F.array_max("_s") + width).alias("doc_end"),
        F.array_min("_s").alias("item_start"),
        F.aggregate("_ok", F.lit(0), lambda s, x: s + x).alias("agreeing"),
    )
    best = verified.groupBy("_d", "_i").agg(
        F.max_by(
            F.struct("doc_id", "item_id", "doc_start", "doc_end", "item_start", "agreeing"),
            F.struct("agreeing", -F.col("doc_start")),
        ).alias("_r")
    )
    return best.select("_r.*", "_d")


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that overlap no item."""
    dirty = store(overlaps(documents, benchmark).select("_d").distinct(), "dirty")
    name = spare(documents, "_d")
    named = documents.withColumn(name, F.xxhash64("doc_id", *text_key(F.col("text"))))
    return named.join(dirty.withColumnRenamed("_d", name).hint("merge"), name, "left_anti").drop(name)
