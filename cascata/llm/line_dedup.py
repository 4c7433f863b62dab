"""Removal of repeated line runs by prefix doubling over line-ID sequences, in DataFrame functions only.

A document is the sequence of its lines that hold a word. Lines are numbered in order of their hashes;
lines that occur once cannot lie in a repeated run and cut the sequences. Each round sorts the suffixes
by twice as many first lines: the distinct pairs (rank, rank 2^k lines on) are sorted over all
partitions and numbered in that order, which is the suffix array by first lines, where suffixes that
share a rank are an interval whose longest common prefix has at least 2^(k+1) lines. Suffixes alone in
their interval drop out.

A run counts if it holds at least ``min_words`` words. Every such run is the union of its least windows
that reach so many words from a line forwards or from a line backwards, so the intervals of these
windows say it all: a window of m lines is named by the ranks of its first and of its last 2^k lines
(2^k the largest power up to m). Of the windows of one interval the first, by document id and line,
stays; the lines of all others are removed. Overlapping windows join to maximal repeated runs.

Lines without a word belong to no run and stay. Short repeated lines stay, unless they lie in a repeated
run. Null and empty texts stay as they are. Rows that share id and text are one document and are treated
alike, so they are not removed against each other. A document can lose all its lines; it then has an
empty text. Null ids come first. Extra columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cascata.llm.common import BLANK, release, spare, store, text_key

MIN_WORDS = 50


def number_of(documents: DataFrame) -> Column:
    """A number for a document's id and text."""
    return F.xxhash64("doc_id", *text_key(F.col("text")))


def lines_of(documents: DataFrame) -> DataFrame:
    """``doc_id, _d, line, n, _l1, _l2, words`` of lines with a word; ``n`` counts only those."""
    named = documents.select("doc_id", "text", number_of(documents).alias("_d"))
    split = named.select("doc_id", "_d", F.posexplode_outer(F.split("text", "\n")).alias("line", "_t"))
    counted = split.withColumn(
        "words", F.size(F.array_remove(F.split("_t", BLANK), ""))
    ).where("words > 0")
    return counted.select("doc_id", "_d", "line", *text_key(F.col("_t")), "words").withColumnsRenamed(
        {"_h1": "_l1", "_h2": "_l2"}
    )


def ranked(keys: DataFrame, names: list[str], rank: str) -> DataFrame:
    """Number distinct keys in their order: sorted over all partitions, then counted upwards."""
    return store(keys.orderBy(*names).select(*names, F.monotonically_increasing_id().alias(rank)), rank)


def repeated_lines(documents: DataFrame, min_words: int) -> DataFrame:
    """Positions of lines that occur again, in stretches of enough words: ``doc_id, _d, line, _s, n, r0, words, c``.

    ``_s`` numbers the stretch in its document and ``c`` is the running number of words in it.
    """
    # Rows that repeat a document are one: each of its lines is counted and numbered once. Written once, as
    # both the count and the numbering read it.
    lines = store(lines_of(documents).dropDuplicates(["_d", "line"]), "lines")
    again = lines.groupBy("_l1", "_l2").agg(F.count("*").alias("k")).where("k > 1")
    ids = ranked(again, ["_l1", "_l2"], "r0")
    # Lines that stand alone keep their place in the count, so that stretches break at them.
    inside = Window.partitionBy("_d").orderBy("line")
    placed = (
        lines.join(ids, ["_l1", "_l2"], "left")
        .select("doc_id", "_d", "line", "words", "r0")
        .withColumn("n", F.row_number().over(inside))
        .withColumn("_s", F.sum(F.col("r0").isNull().cast("int")).over(inside))
        .where("r0 is not null")
    )
    stretch = Window.partitionBy("_d", "_s")
    kept = placed.withColumn("_all", F.sum("words").over(stretch)).where(F.col("_all") >= min_words)
    positions = kept.withColumn("c", F.sum("words").over(stretch.orderBy("n"))).drop("_all")
    stored = store(positions, "positions")
    release(lines)
    return stored


def windows(positions: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, _d, n, m``: least windows of at least ``min_words`` words from each line on, and up to each."""
    stretch = Window.partitionBy("_d", "_s").orderBy("n")
    reach = positions.select(
        "doc_id", "_d", "n", "c", "words",
        F.collect_list("c").over(stretch.rowsBetween(0, min_words - 1)).alias("_on"),
        F.collect_list(F.col("c") - F.col("words")).over(stretch.rowsBetween(1 - min_words, 0)).alias("_back"),
    )
    # A line has a word at least, so min_words lines always reach.
    on = F.size(F.filter("_on", lambda x: x < F.col("c") - F.col("words") + min_words)) + 1
    back = F.size(F.filter("_back", lambda x: F.col("c") - x < min_words)) + 1
    sizes = reach.select("doc_id", "_d", "n", F.size("_on").alias("_no"), F.size("_back").alias("_nb"), on.alias("_mo"), back.alias("_mb"))
    forward = sizes.where("_mo <= _no").select("doc_id", "_d", "n", F.col("_mo").alias("m"))
    backward = sizes.where("_mb <= _nb").select("doc_id", "_d", (F.col("n") - F.col("_mb") + 1).alias("n"), F.col("_mb").alias("m"))
    return store(forward.unionByName(backward).distinct(), "windows")


def doubled(positions: DataFrame, levels: int) -> DataFrame:
    """Positions with ranks by the first 1, 2, 4, ... lines; null where no other suffix shares them."""
    for k in range(levels):
        stretch = Window.partitionBy("_d", "_s").orderBy("n")
        old, new = f"r{k}", f"r{k + 1}"
        pairs = store(positions.withColumn("_next", F.lead(old, 1 << k).over(stretch)), "pairs")
        keys = (
            pairs.where(F.col(old).isNotNull() & F.col("_next").isNotNull())
            .groupBy(old, "_next").agg(F.count("*").alias("k")).where("k > 1")
        )
        ranks = ranked(keys, [old, "_next"], new)
        after = store(pairs.join(ranks, [old, "_next"], "left").drop("_next"), "positions")
        release(pairs, ranks, positions)
        positions = after
    return positions


def later_copies(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``_d, n``-ranges to remove as ``_d, line`` rows: all lines of windows that an earlier one equals."""
    positions = repeated_lines(documents, min_words)
    found = windows(positions, min_words)
    longest = found.agg(F.max("m")).first()[0] or 1
    levels = longest.bit_length() - 1
    positions = doubled(positions, levels)
    ranks = [f"r{k}" for k in range(levels + 1)]
    power = F.floor(F.log2("m") + 1e-9).cast("int")
    wanted = found.withColumn("k", power).withColumn("e", (F.col("n") + F.col("m") - F.expr("shiftleft(1, k)")))

    start = positions.select("_d", "n", F.array(*ranks).alias("_ra"))
    end = positions.select("_d", F.col("n").alias("e"), F.array(*ranks).alias("_rb"))
    named = store(
        wanted.join(start, ["_d", "n"]).join(end, ["_d", "e"])
        .select("doc_id", "_d", "n", "m", F.get("_ra", F.col("k")).alias("a"), F.get("_rb", F.col("k")).alias("b"))
        .where("a is not null and b is not null"), "named",
    )
    order = F.struct("doc_id", "_d", "n")
    firsts = named.groupBy("m", "a", "b").agg(F.min(order).alias("_first"), F.count("*").alias("_c")).where("_c > 1")
    copies = named.join(firsts, ["m", "a", "b"]).where(order != F.col("_first"))
    covered = copies.select("_d", F.explode(F.sequence(F.col("n"), F.col("n") + F.col("m") - 1)).alias("n")).distinct()
    return covered.join(positions.select("_d", "n", "line"), ["_d", "n"]).select("_d", "line")


def removed_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``_d, removed``: sorted line numbers to remove, one row a document that loses any."""
    return store(
        later_copies(documents, min_words).groupBy("_d").agg(F.sort_array(F.collect_set("line")).alias("removed")),
        "removed",
    )


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS, counts: bool = False) -> DataFrame:
    """The documents with later copies of line runs removed from ``text``; ``counts`` adds two numbers."""
    removed = removed_lines(documents, min_words)
    number, gone, lines = (spare(documents, n) for n in ("_number", "_gone", "_lines"))
    # Always by shuffling, so that disk and time grow evenly and no list of documents is broadcast.
    joined = documents.withColumn(number, number_of(documents)).join(
        removed.select(F.col("_d").alias(number), F.col("removed").alias(gone)).hint("merge"), number, "left"
    )
    # Two uses of the split lines in one select keep Spark from splitting again for every line.
    joined = joined.withColumn(lines, F.split("text", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    )
    size = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    added = {"n_lines": size, "n_removed": F.coalesce(F.size(gone), F.lit(0))} if counts else {}
    return joined.withColumns({**added, "text": text}).select(*documents.columns, *added)
