"""Row-wise jobs over landing folders.

Each is the batch job itself over a streaming read: none keeps state, so there
is no watermark and a late file is handled like any other.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..operators.drift import clock_drift
from ..operators.logs import parse_log_lines, route_records
from ..operators.redact import redact_rows
from ..operators.select import selection_predicate

PROBE = "probe_id bigint, host string, host_time_raw string, engine_time timestamp"


def landed(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """A landing folder as a stream of rows."""
    return spark.readStream.format(fmt).schema(schema).load(path)


def drift_stream(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Clock drift of probes as they land."""
    return clock_drift(landed(spark, path, PROBE, fmt))


def redacted_stream(
    spark: SparkSession, path: str, schema: str, keys: Iterable[str], column: str, fmt: str = "parquet"
) -> DataFrame:
    """Report rows with the values of sensitive keys masked."""
    return redact_rows(landed(spark, path, schema, fmt), keys, column)


def log_stream(spark: SparkSession, path: str, minimum: str = "INFO") -> DataFrame:
    """Log lines of text files, parsed and routed."""
    lines = spark.readStream.text(path).withColumnRenamed("value", "line")
    return route_records(parse_log_lines(lines), minimum)


def selected_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", **options) -> DataFrame:
    """Inventory rows that pass the row-wise selection options."""
    return landed(spark, path, schema, fmt).filter(selection_predicate(**options))
