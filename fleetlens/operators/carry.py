"""What a header says, carried down to the rows below it, in files of any size.

A window over all rows of a file would sort them in one task. Here rows are cut into blocks by their number. A block's
headers are gathered, no more than it has rows, and each row picks the last one at or above it. What holds when a
block begins is found in the same way among blocks, by blocks of blocks, until a window over the few that are left
is enough.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import use_checkpoint_dir

#: Rows of a block, and blocks of a block of blocks.
BLOCK = 256
#: How often blocks are put together before a window runs over what is left.
LEVELS = 2


def _joined(rows: DataFrame, blocks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with the columns of their block; a null in ``by`` is a value like any other."""
    named = blocks.select([F.col(name).alias(f"_of{name}" if name in (*by, "_block") else name) for name in blocks.columns])
    same = [F.col(name).eqNullSafe(F.col(f"_of{name}")) for name in by]
    met = reduce(lambda left, right: left & right, same, F.col("_block") == F.col("_of_block"))
    return rows.join(named, met, "left").drop(*[f"_of{name}" for name in (*by, "_block")])


def _gathered(rows: DataFrame, value: Column, by: Sequence[str], order: str, block: int) -> tuple[DataFrame, DataFrame]:
    """(rows with the number of their block, blocks with their headers)."""
    placed = rows.withColumn("_block", F.floor(F.col(order) / block).cast("bigint"))
    head = F.when(value.isNotNull(), F.struct(F.col(order).alias("at"), value.alias("value")))
    return placed, placed.groupBy(*by, "_block").agg(F.collect_list(head).alias("_heads"))


def _last(heads: Column) -> Column:
    """The header with the greatest number; null of none."""
    return F.reduce(
        heads, F.get(heads, F.lit(0)), lambda best, head: F.when(head["at"] > best["at"], head).otherwise(best)
    )


def _before(blocks: DataFrame, by: Sequence[str], block: int, levels: int) -> DataFrame:
    """Blocks with ``_opens``: what the last header of an earlier block says, in a struct."""
    ended = blocks.withColumn("_end", _last(F.col("_heads")))
    if levels == 0:
        earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        return ended.withColumn("_opens", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
    numbered = ended.withColumnRenamed("_block", "_number").select(
        *by, "_number", F.col("_heads").alias("_own"), "_end"
    )
    placed, above = _gathered(numbered, F.col("_end"), by, "_number", block)
    found = _joined(placed, _before(above, by, block, levels - 1), by)
    inside = _last(F.filter("_heads", lambda head: head["at"] < F.col("_number")))
    return found.select(
        *by,
        F.col("_number").alias("_block"),
        F.col("_own").alias("_heads"),
        F.coalesce(inside["value"], F.col("_opens.value")).alias("_opens"),
    )


def carry_down(
    rows: DataFrame,
    value: Column,
    by: Sequence[str],
    order: str,
    name: str,
    block: int = BLOCK,
    levels: int = LEVELS,
) -> DataFrame:
    """Every row with ``name``: the last value at or above it that is not null.

    Rows are told apart by the columns ``by`` (nulls are one group) and the whole number ``order``, 0 or more and
    unique inside its group; numbers may be left out. Rows above the first value have null. The blocks with their
    headers are checkpointed when this is called, so the rows are read once for them and once for the result.
    """
    use_checkpoint_dir(rows.sparkSession)
    placed, blocks = _gathered(rows, value, by, order, block)
    found = _joined(placed, _before(blocks.checkpoint(), by, block, levels), by)
    inside = _last(F.filter("_heads", lambda head: head["at"] <= F.col(order)))
    return found.select(*rows.columns, F.coalesce(inside["value"], F.col("_opens.value")).alias(name))
