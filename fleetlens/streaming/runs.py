"""Runs as their events land: keyed state that late and repeated events do not spoil."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.settings import effective_settings
from ..operators.status import run_outcome
from .landing import landed

EVENT = "run_id bigint, seq bigint, status_set int, ends boolean"


def run_outcome_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = EVENT) -> DataFrame:
    """The outcome of each run so far, to be written in update or complete mode.

    It is the batch job over a streaming read. The state is one row a run: the last status by ``seq``, the worst one,
    and the first end. Each of these is a maximum or minimum, so events may come late, twice, or in any cut into
    batches, and once a run has ended no event changes what it came to. Runs have no time after which they are done, so
    state is kept for each of them.
    """
    return run_outcome(landed(spark, path, schema, fmt))


def effective_settings_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", **options) -> DataFrame:
    """The settings in force so far, to be written in update or complete mode; the state is one row a run and key."""
    return effective_settings(landed(spark, path, schema, fmt), **options)
