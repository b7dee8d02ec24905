"""Ordered text of the values of a group, in chunks, for groups of any size.

Joining a group's values in one row would gather the group in one task. Here the rows are sorted by ranges, which part
a large group as well; a value's place in its group's text is the running total of the lengths before it; and values are
joined by the chunk that their place falls in, so that no task and no row holds more than a chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import use_checkpoint_dir

#: Characters of a chunk.
CHUNK = 8192


def running_total(rows: DataFrame, order: Sequence[str], amount: Column, name: str) -> DataFrame:
    """Every row with ``name``: the sum of ``amount`` (never null) over all rows before it in the given order.

    A sum over the whole table would sort it in one task. Rows are sorted by ranges and checkpointed when this is called,
    which pins the ranges; a window sums inside each range, and the totals of the ranges, one row each, are added. Rows
    that tie are told apart by a hash of their content, so a hot value may span ranges.
    """
    use_checkpoint_dir(rows.sparkSession)
    counted = rows.select("*", amount.cast("bigint").alias("_amount"), F.xxhash64(*rows.columns).alias("_content"))
    placed = (
        counted.orderBy(*order, "_content")
        .checkpoint()
        .select(
            *rows.columns,
            "_amount",
            F.spark_partition_id().alias("_range"),
            F.monotonically_increasing_id().alias("_place"),
        )
    )
    # One row per range, so this window holds no more rows than there are partitions.
    ranges_before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_range").agg(F.sum("_amount").alias("_total")).select(
        "_range", F.coalesce(F.sum("_total").over(ranges_before), F.lit(0)).alias("_start")
    )
    rows_before = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_amount").over(rows_before), F.lit(0))
    return (
        placed.withColumn("_inside", inside)
        .join(F.broadcast(starts), "_range")
        .select(*rows.columns, (F.col("_start") + F.col("_inside")).alias(name))
    )


def ordered_text(
    rows: DataFrame,
    value: str,
    by: Sequence[str] = (),
    order: Sequence[str] | None = None,
    separator: str = ", ",
    chunk: int = CHUNK,
) -> DataFrame:
    """The values of each group ``by``, joined in ``order`` (by default their own), in chunks of text.

    One row per chunk: the columns ``by``, part, first_char, n_values, text. A value is in the chunk that its first
    character falls in, so a text is at most ``chunk`` characters and one value long; texts in the order of part, joined
    by the separator, are the whole text, and first_char (from 0) is where one begins in it. A value longer than a chunk
    leaves numbers of parts unused. Null values are left out, a null in ``by`` is a value like any other, and repeated
    values stay. No rows give no chunks.
    """
    order = list(order or [value])
    columns = list(dict.fromkeys([*by, *order, value]))
    known = rows.select(*columns).filter(F.col(value).isNotNull())
    length = F.greatest(F.length(F.col(value).cast("string")) + len(separator), F.lit(1))
    placed = running_total(known, [*by, *order], length, "_before")
    if by:
        first = placed.groupBy(*by).agg(F.min("_before").alias("_first"))
        # A null-safe join gives both sides a shuffle of their own, so a hot group can be split (see ``spread_join``).
        named = first.select("_first", *[F.col(name).alias(f"_of{name}") for name in by])
        same = reduce(lambda left, right: left & right, [F.col(name).eqNullSafe(F.col(f"_of{name}")) for name in by])
        placed = placed.join(named, same).select(*columns, "_before", "_first")
    else:
        placed = placed.withColumn("_first", F.lit(0))
    held = placed.withColumn("_at", F.col("_before") - F.col("_first")).withColumn(
        "part", F.floor(F.col("_at") / chunk).cast("bigint")
    )
    ordered = F.array_sort(F.collect_list(F.struct("_at", F.col(value).cast("string").alias("_text"))))
    return held.groupBy(*by, "part").agg(
        F.min("_at").alias("first_char"),
        F.count(F.lit(1)).alias("n_values"),
        F.array_join(F.transform(ordered, lambda one: one["_text"]), separator).alias("text"),
    )
