"""Pages of an ordered entity list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import use_checkpoint_dir

PAGE_SIZE = 100  # fixed value: rows per page
# Rows that one task may sort for a page; later pages come from page numbers.
NEAR_ROWS = 100_000


def page(entities: DataFrame, number: int, order: list[str], size: int = PAGE_SIZE) -> DataFrame:
    """One page, counted from 1; empty past the last one.

    An early page is a top-k. A later one, which a top-k would gather with all
    rows before it in one task, is found by its number. Both tell rows that tie
    apart by a hash of their content, so pages neither overlap nor lose a row.
    """
    keys = [*order, F.xxhash64(*entities.columns)]
    if number * size <= NEAR_ROWS:
        return entities.orderBy(*keys).offset((number - 1) * size).limit(size)
    return with_page_number(entities, order, size).filter(F.col("page") == number).drop("page").orderBy(*keys)


def page_after(entities: DataFrame, key: str, last: object | None, size: int = PAGE_SIZE) -> DataFrame:
    """The page that follows a key, for walking deep lists of unique keys.

    The key test reaches the scan, so page one million costs what page two does.
    """
    rest = entities if last is None else entities.filter(F.col(key) > F.lit(last))
    return rest.orderBy(key).limit(size)


def row_numbers(entities: DataFrame, order: list[str], name: str) -> DataFrame:
    """Every row with its number from 0 on in the given order.

    A row number over the whole list would sort it in one task. Here the rows are
    sorted by ranges and checkpointed, each range is counted, and a row's number is
    its place in the range plus the rows of the ranges before it. The checkpoint
    runs when this is called; it pins the ranges, so a lost executor cannot move
    rows between them. Rows that tie are told apart by a hash of their content, so
    a hot value may span ranges. The rows themselves are numbered, so none is lost
    or taken for another.
    """
    use_checkpoint_dir(entities.sparkSession)
    content = F.xxhash64(*entities.columns)
    ranges = entities.select("*", content.alias("_content")).orderBy(*order, "_content").checkpoint()
    placed = ranges.select(
        *entities.columns,
        F.spark_partition_id().alias("_range"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_place"),
    )
    counts = placed.groupBy("_range").agg(F.count("*").alias("_rows"))
    # One row per range, so this window holds no more rows than there are partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    number = F.col("_start") + F.col("_place")
    return placed.join(F.broadcast(starts), "_range").select(*entities.columns, number.alias(name))


def with_page_number(entities: DataFrame, order: list[str], size: int = PAGE_SIZE) -> DataFrame:
    """Every row with its page number: see ``row_numbers``."""
    numbered = row_numbers(entities, order, "_number")
    page_number = (F.floor(F.col("_number") / size) + 1).cast("bigint")
    return numbered.select(*entities.columns, page_number.alias("page"))


def landed_pages(rows: DataFrame, page: str = "page") -> DataFrame:
    """Entities of landed pages: their columns, first_page, times and taken.

    Pages are counted from 1. A reader that asks for one page after the other ends at the first that has no row, so
    ``taken`` holds for entities of an earlier page only. Where pages shift while they are read, an entity is on
    two of them; it is one row here, with the number of ``times`` it was read. A page number without its
    successor is found by an anti join of distinct numbers, so the pages are never sorted.
    """
    columns = [name for name in rows.columns if name != page]
    numbers = rows.select(F.col(page).cast("bigint").alias("_page")).filter("_page > 0").distinct()
    none = rows.sparkSession.range(1).select(F.col("id").alias("_page"))
    follows = none.union(numbers).select((F.col("_page") + 1).alias("_page"))
    hole = follows.join(numbers, "_page", "left_anti").agg(F.min("_page").alias("hole")).scalar()
    return (
        rows.groupBy(*columns)
        .agg(F.min(F.col(page).cast("bigint")).alias("first_page"), F.count(F.lit(1)).alias("times"))
        .select(*columns, "first_page", "times", F.coalesce(F.col("first_page") < hole, F.lit(False)).alias("taken"))
    )
