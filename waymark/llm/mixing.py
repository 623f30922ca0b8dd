"""Mixing sources to target weights by hash-random order and distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.llm.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the random key that choose a range; 16**6 ranges at most.
RANGE_DIGITS = 6


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-space characters; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = 3
) -> DataFrame:
    """From (source, source_size, n_docs) to the same rows with ``target``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share the sum of
    all sizes.  A target stops at ``limit`` times its source's size and the excess is shared
    again by weight until no target is above.  That ends where every source has
    min(limit * size, level * weight) with one common level; sources sorted by
    size / weight fill up in that order, so the level follows from prefix sums over the
    sources.  Works on one row a source, never on documents.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("_turn"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = (
        totals.withColumn("source_rank", F.row_number().over(by_name))
        .withColumn("_turn", ((F.col("source_rank") - 1) % len(weights) + 1).cast("int"))
        .withColumn("_weight", weight.cast("double"))
    )
    fill = Window.orderBy((F.col("source_size") / F.col("_weight")).asc(), "source_rank")
    full = F.coalesce(
        F.sum("source_size").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rest = F.sum("_weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    # the level rises with every source that fills up and falls after that: its peak holds
    level = (F.sum("source_size").over(Window.partitionBy()) - limit * full) / rest
    peak = F.max("_level").over(Window.partitionBy())
    return (
        ranked.withColumn("_level", level)
        .withColumn("_peak", peak)
        .select(
            "source",
            "source_rank",
            "source_size",
            "n_docs",
            F.least(
                (limit * F.col("source_size")).cast("double"), F.col("_peak") * F.col("_weight")
            ).alias("target"),
        )
    )


def mix_sources(
    sized: DataFrame,
    key_col: str = "doc_id",
    size_col: str = "size",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    limit: int = 3,
    seed: str = "mix",
    rows_per_range: int = 2048,
) -> DataFrame:
    """Add source_size, target, ``copies`` (0 to ``limit``) and ``taken`` to every row.

    Each row gets a random key (a hash of seed and ``key_col``), its source is ordered by
    that key, and prefix sums of sizes say which rows fall inside the budget.  A budget of
    more than the source is met by whole epochs plus a part of one: a row is in the part if
    its middle lies inside the remainder, so a source misses its target by half a row at
    most.

    Hash keys are uniform, so cutting a source's key range into equal ranges gives even
    ranges however large the source is; prefix sums run inside a range, and the ranges'
    totals give the offsets.  Nulls: a null source is a source, a null key is hashed as
    such.  Equal keys are ordered by size; equal rows are interchangeable.  Rows of size 0
    or null take nothing.  Other columns stay; of the names that are added, old columns are
    replaced.  Empty input gives an empty result.
    """
    made = ("source_size", "target", "copies", "taken")
    work = sized.select(
        F.struct(*[c for c in sized.columns if c not in made]).alias("_row"),
        F.col(source_col).alias("_name"),
        F.coalesce(F.col(size_col), F.lit(0)).cast("long").alias("_size"),
        F.col(key_col).cast("string").alias("_id"),
    )
    totals = work.groupBy(F.col("_name").alias("source")).agg(
        F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    targets = materialize(source_targets(totals, weights, limit), "mix-targets")
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.lit(rows_per_range))).cast("long")
    text_key = F.md5(
        F.concat_ws(":", F.lit(seed), F.coalesce("_id", F.lit("null"))).cast(
            "binary"
        )
    )
    top_digits = f"cast(conv(substring(_key, 1, {RANGE_DIGITS}), 16, 10) as bigint)"
    right = targets.select(
        F.col("source").alias("_source"),
        F.col("source_rank").alias("_rank"),
        "source_size",
        "target",
        ranges.alias("_ranges"),
    )
    if small_enough(targets):
        right = F.broadcast(right)
    keyed = (
        work.withColumn("_key", text_key)
        .join(right, F.col("_name").eqNullSafe(F.col("_source")))
        .withColumn("_range", F.expr(f"({top_digits} * _ranges) div {16**RANGE_DIGITS}"))
    )
    order = Window.partitionBy("_rank", "_range").orderBy("_key", "_size")
    local = keyed.withColumn(
        "_end", F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    before = Window.partitionBy("_rank").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("_rank", "_range")
        .agg(F.sum("_size").alias("_sum"))
        .select("_rank", "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    )
    placed = local.join(offsets, ["_rank", "_range"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    part = F.col("target") - epochs * F.col("source_size")
    middle = F.col("_base") + F.col("_end") - F.col("_size") / F.lit(2)
    inside = (F.col("_size") > 0) & (middle < part)
    copies = F.least(F.lit(limit), epochs + F.when(inside, 1).otherwise(0)).cast("int")
    return placed.withColumn("copies", copies).select(
        "_row.*",
        "source_size",
        "target",
        "copies",
        (F.col("_size") * F.col("copies")).cast("long").alias("taken"),
    )


def small_enough(targets: DataFrame, most_rows: int = 20000) -> bool:
    """Whether a table of one row a source is small enough to broadcast."""
    return targets.limit(most_rows + 1).count() <= most_rows


def row_key(doc_id: Column, text: Column) -> Column:
    """A row's own key: its id, or a hash of its text where it has none, so that rows
    without id are spread like all others."""
    nameless = F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.coalesce(doc_id.cast("string"), nameless)


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every document.

    A null text has size 0 and is never taken; rows that share id and text are
    interchangeable.  Words are counted once and kept as numbers.
    """
    sized = docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        row_key(F.col("doc_id"), F.col("text")).alias("key"),
    )
    return mix_sources(materialize(sized, "sizes"), key_col="key").drop("key")
