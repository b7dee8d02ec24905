"""As-of lookup in a table of points: for each row the last point at or before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .carry import carry_down
from .paging import row_numbers
from .spread import spread_join


def as_of(rows: DataFrame, points: DataFrame, key: str, valid_from: str, by: Sequence[str] = ()) -> DataFrame:
    """The rows with the other columns of the last point whose ``valid_from`` is not after their ``key``.

    Only points that are equal in the columns ``by`` count. Rows above the first point, or with a null among these
    columns, get nulls. Of points that start together the greatest counts. Both tables may be of any size: the distinct
    keys of the rows, so that a hot key is one, are sorted together with the points, by ranges; points are carried down
    over the numbered list, also across its ranges; and the answers are joined back to the rows, where a hot key is
    split.
    """
    names = [name for name in points.columns if name != valid_from and name not in by]
    places = [*by, "_at"]
    asked = rows.select(*by, F.col(key).alias("_at")).dropna().distinct()
    given = (
        points.select(*by, F.col(valid_from).alias("_at"), F.struct(*names).alias("_point"))
        .dropna(subset=places)
        .groupBy(*places)
        .agg(F.max("_point").alias("_point"))
    )
    both = given.withColumn("_asks", F.lit(0)).unionByName(
        asked.withColumn("_asks", F.lit(1)), allowMissingColumns=True
    )
    numbered = row_numbers(both, [*places, "_asks"], "_row")
    point = F.when(F.col("_asks") == 0, F.struct(*by, "_point"))
    carried = carry_down(numbered, point, [], "_row", "_found").filter("_asks = 1")
    same = [F.col(f"_found.{column}") == F.col(column) for column in by]
    fits = F.col("_found").isNotNull()
    for one in same:
        fits &= one
    answers = carried.select(
        *by,
        F.col("_at").alias(key),
        *[F.when(fits, F.col(f"_found._point.{name}")).alias(name) for name in names],
    )
    return spread_join(rows, answers, [*by, key], "left")
