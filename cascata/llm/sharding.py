"""Contiguous shards of near equal bytes from a global prefix sum.

Rows (without their texts) are range-partitioned and sorted by id, text checksum and size. Each
partition gives its total; the running sums of the totals are the partitions' offsets, so with the
running sum inside a partition every row knows its place in the whole. The whole is cut at equal
targets: a row belongs to the shard that holds its middle byte.

Only sizes and checksums move; one row a partition and one a shard come to the driver. A running number
tells equal rows apart, so a repeated id spreads over partitions and repeated rows have places of their
own. Null texts have size 8; null ids come first. An empty table gives an empty result. A text larger
than a target can leave neighbouring shards empty. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cascata.llm.common import store

OVERHEAD = 8


def places(documents: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id, size, text_crc32, _start, _row``: first byte and number in the whole; and all bytes."""
    spark = documents.sparkSession
    by = ["doc_id", "text_crc32", "size", "_n"]
    ranged = (
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
            F.monotonically_increasing_id().alias("_n"),
        )
        .repartitionByRange(*by)
        .withColumn("_part", F.spark_partition_id())
    )
    # Written once, so that every later pass sees the same ranges.
    ranged = store(ranged, "ranges")
    totals = ranged.groupBy("_part").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    offsets, at, row = [], 0, 0
    for t in sorted(totals, key=lambda t: t["_part"]):
        offsets.append((t["_part"], at, row))
        at, row = at + t["b"], row + t["n"]
    starts = spark.createDataFrame(offsets, "_part int, _bytes long, _rows long")
    inside = Window.partitionBy("_part").orderBy(*by)
    running = ranged.select(
        "*",
        (F.sum("size").over(inside) - F.col("size")).alias("_before"),
        (F.row_number().over(inside) - 1).alias("_at"),
    )
    placed = running.join(F.broadcast(starts), "_part").select(
        "doc_id", "size", "text_crc32",
        (F.col("_bytes") + F.col("_before")).alias("_start"), (F.col("_rows") + F.col("_at")).alias("_row"),
    )
    return placed, at


def shard_documents(documents: DataFrame, shards: int = 24) -> DataFrame:
    placed, whole = places(documents)
    # The middle byte decides; a decimal product cannot overflow.
    middle = (2 * F.col("_start") + F.col("size")).cast("decimal(38,0)") * shards
    shard = F.least(F.floor(F.try_divide(middle, F.lit(2 * whole))), F.lit(shards - 1)).cast("int")
    cut = store(placed.withColumn("shard", shard), "cut")
    rows = {r["shard"]: r["count"] for r in cut.groupBy("shard").count().collect()}
    firsts, row = [], 0
    for s in sorted(rows):
        firsts.append((s, row))
        row += rows[s]
    first = cut.sparkSession.createDataFrame(firsts, "shard int, _first long")
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_row") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
