"""Contiguous shards of about equal bytes, by global prefix sums.

Rows are range-partitioned on their order. Each partition's byte total and row
count give it a global start; a running sum inside the partition does the rest.
So no task sees more than its own range of thin rows, and no driver code sees
any. A row goes to the shard in which the middle of its byte interval lies, so
the shards' sizes differ from the target by less than the largest row.

Nulls: a null text has no bytes and the checksum of the empty text; null order
keys come first. Rows equal in every order key, size and checksum may change
places with each other, which changes no shard's bytes. An empty table gives an
empty result. Other columns are not carried along; join on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.session import written_once

#: Columns made here; the input may have columns of these names.
_ORDERED = ("doc_id", "size", "text_crc32")


def sized(docs: DataFrame) -> DataFrame:
    """Key, bytes plus one and checksum of each document; texts are not carried on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def shards(rows: DataFrame, count: int = 16, order: tuple[str, ...] = _ORDERED, size: str = "size") -> DataFrame:
    """Rows with ``shard`` (0 to count - 1), ``slot`` in the shard, and ``byte_start``."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    # Written once: a range partitioning worked out anew could be cut elsewhere.
    ranged = written_once(ranged, "shards")
    totals = ranged.groupBy("_part").agg(F.sum(size).alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    # One row for each partition, so this window is over a few thousand rows at most.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    starts = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte_0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row_0"),
        F.sum("_bytes").over(whole).alias("_all"),
    )
    here = Window.partitionBy("_part").orderBy(*order)
    places = (
        ranged.withColumn("_run", F.sum(size).over(here.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_nth", F.row_number().over(here))
        .join(F.broadcast(starts), "_part")
        .withColumn("byte_start", F.col("_byte_0") + F.col("_run") - F.col(size))
        .withColumn("_row", F.col("_row_0") + F.col("_nth") - 1)
        # Whole numbers throughout: twice the middle, times the count, over twice the total.
        .withColumn(
            "shard",
            F.expr(f"cast((2 * byte_start + `{size}`) * cast({count} as decimal(10,0)) div (2 * _all) as int)"),
        )
    )
    firsts = places.groupBy("shard").agg(F.min("_row").alias("_first"))
    return (
        places.join(F.broadcast(firsts), "shard")
        .withColumn("slot", F.col("_row") - F.col("_first"))
        .drop("_part", "_run", "_nth", "_byte_0", "_row_0", "_all", "_row", "_first")
    )


def op2_byte_shards(docs: DataFrame, count: int = 16) -> DataFrame:
    """All documents in ``count`` shards of near equal bytes, in order of their key."""
    return shards(sized(docs), count).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
