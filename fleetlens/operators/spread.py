"""Joins of many rows to few keyed ones that stay even when one key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(rows: DataFrame, small: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``rows`` joined to ``small`` so that adaptive execution can split a hot key.

    Splitting needs a shuffle right below the join on both sides, and a side that
    has just been aggregated by the key has none. A hash of the key as a second
    key gives both sides one. Nothing is repeated up front: at run time the
    partitions that turn out to be large are read in parts, and only their
    counterparts are read again.
    """
    spread = F.xxhash64(*keys)
    joined = rows.withColumn("_spread", spread).join(small.withColumn("_spread", spread), [*keys, "_spread"], how)
    added = [name for name in joined.columns if name != "_spread" and name not in rows.columns]
    return joined.select(*rows.columns, *added)
