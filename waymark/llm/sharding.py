"""Contiguous shards of equal bytes from a global prefix sum (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.llm.storage import materialize


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus one for the record's end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(1)


def assign_shards(
    rows: DataFrame, size_col: str, order_cols: list[str], n_shards: int = 8
) -> DataFrame:
    """Add ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Law: ``bytes``.  Rows are put in the order of ``order_cols`` by one range shuffle; each
    partition reports its total, the totals' prefix sums give every row its global byte
    offset, and the byte axis is cut at equal targets.  A row belongs to the shard that holds
    its middle byte, so no shard misses its target by more than one row's size.

    Cost: one range shuffle and one hash shuffle of ``rows`` as passed, so pass narrow rows;
    the per-partition totals (one row a partition) are the only thing that is broadcast.

    Nulls in order columns sort first.  Rows that tie on all order columns are dealt in
    either order; if they are equal the result is the same.  Old columns named shard or
    slot are replaced.  An empty table gives an empty result.  Products of bytes and shards must stay below 2**62.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    order = [f"_o{i}" for i in range(len(order_cols))]
    work = rows.select(
        F.struct(*kept).alias("_row"),
        F.col(size_col).alias("_size"),
        *[F.col(c).alias(o) for c, o in zip(order_cols, order)],
    )
    placed = materialize(
        work.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()),
        "shard-order",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        placed.groupBy("_part")
        .agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte_base"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row_base"),
            F.sum("_bytes").over(Window.partitionBy()).alias("_total"),
        )
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    ends = placed.select(
        "_row",
        "_part",
        "_size",
        F.sum("_size").over(upto).alias("_end"),
        F.row_number().over(inside).alias("_place"),
    ).join(F.broadcast(totals), "_part")
    # twice the middle byte, to stay with whole numbers
    twice = "(2 * (_byte_base + _end) - _size)"
    dealt = ends.selectExpr(
        "_row",
        f"cast(least({n_shards - 1}, ({twice} * {n_shards}) div (2 * _total)) as int) as shard",
        "_row_base + _place - 1 as _index",
    )
    firsts = dealt.groupBy("shard").agg(F.min("_index").alias("_first"))
    return dealt.join(F.broadcast(firsts), "shard").select(
        "_row.*", "shard", (F.col("_index") - F.col("_first")).alias("slot")
    )


def shard_documents(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    Null texts have size 1 and the checksum of no bytes.  Order: doc_id (null first), size,
    checksum.  ``grown_shard`` belongs to another law and is null.
    """
    narrow = docs.select(
        F.col("doc_id"),
        record_bytes(F.col("text")).alias("size"),
        F.crc32(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    return assign_shards(narrow, "size", ["doc_id", "size", "text_crc32"], n_shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
