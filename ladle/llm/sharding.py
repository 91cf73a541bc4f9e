"""Contiguous, balanced shards from global byte-size prefix sums. Built-in column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import partitions, stored


def row_size(text: str | Column = "text") -> Column:
    """UTF-8 bytes of the text (none for null) plus 1, so that every row has weight."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def contiguous_shards(rows: DataFrame, size: str, order: list[str], shards: int) -> DataFrame:
    """rows with shard (0 to shards - 1) and slot (gapless from 0 within a shard), contiguous in the given order.

    Rows are range-partitioned by the order (the row's input position last, so that equal rows split) and stored.
    Each partition's total gives its offset in the global prefix sum; one row per partition is all that the window
    over totals sees. A row goes to the shard in which its middle byte lies, so a shard misses its equal target by one
    row at most. Nulls sort first; an empty table gives no rows; a size of null or below 1 counts as 1. Other columns are
    kept whatever their names; columns named shard or slot are replaced.
    """
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    weight = F.greatest(F.coalesce(F.col(size), F.lit(1)), F.lit(1)).cast("long")
    names = [f"order_{i}" for i in range(len(order))]
    keyed = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), *[F.col(f"`{c}`").alias(n) for c, n in zip(order, names, strict=True)],
                        weight.alias("weight"), F.monotonically_increasing_id().alias("tie"))
    fixed = stored(keyed.repartitionByRange(partitions(rows.sparkSession), *names, "tie").withColumn("part", F.spark_partition_id()))
    totals = fixed.groupBy("part").agg(F.sum("weight").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"), F.sum("bytes").over(everything).alias("total"))
    inside = Window.partitionBy("part").orderBy(*[F.col(c).asc_nulls_first() for c in names], "tie")
    placed = (
        fixed.withColumn("start", F.sum("weight").over(inside) - F.col("weight"))
        .withColumn("nth", F.row_number().over(inside) - 1)
        .join(offsets, "part")
        .withColumn("start", F.col("start") + F.col("bytes_before"))
        .withColumn("nth", F.col("nth") + F.col("rows_before"))
        .withColumn("shard", F.expr(f"cast(((2 * start + weight) * {int(shards)}) div (2 * total) as int)"))
    )
    firsts = placed.groupBy("shard").agg(F.min("nth").alias("first"))
    return (placed.join(firsts, "shard").withColumn("slot", (F.col("nth") - F.col("first")).cast("long"))
            .select(*[F.col("row")[c].alias(c) for c in kept], "shard", "slot"))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32 (of no bytes for a null text), shard and slot of every document, in order of doc_id.

    Documents of one id are ordered by size and checksum; equal rows are interchangeable. Only ids, sizes and
    checksums are shuffled, never a text.
    """
    rows = docs.select("doc_id", row_size("text").alias("size"), F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"))
    return contiguous_shards(rows, "size", ["doc_id", "size", "text_crc32"], shards)
