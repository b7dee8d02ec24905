"""Writing reports, listings, manifests and routed log records.

Every writer takes ``mode``. By default it fails where something is written
already; ``overwrite`` replaces it, and where rows go to a folder each, only the
folders that get rows now.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bundle import host_files
from ..operators.drift import drift_report
from ..operators.listing import listing_report

# Rows of one folder that are worth a file of their own.
ROWS_PER_FILE = 1_000_000


def write_drift_report(probes: DataFrame, path: str, mode: str = "errorifexists", ordered: bool = True) -> None:
    """The drift report of clock probes as text, titles first, in part files, sorted unless told otherwise."""
    drift_report(probes, ordered).select("line").write.mode(mode).text(path)


def write_listing(
    selected: DataFrame,
    path: str,
    mode: str = "errorifexists",
    hosts: Iterable[str] | None = None,
    datacenters: Iterable[str] | None = None,
    clusters: Iterable[str] | None = None,
) -> None:
    """The host listing as text, selection and titles first, in sorted part files."""
    listing_report(selected, hosts, datacenters, clusters).select("line").write.mode(mode).text(path)


def _write_folders(rows: DataFrame, by: str, path: str, fmt: str, mode: str) -> None:
    """One folder per value of ``by``, with a file for every ROWS_PER_FILE rows or so.

    Rows are dealt by the value and a part number: a value with few rows has one
    part, one with a large share of all rows is written by many tasks.
    """
    counts = rows.groupBy(by).agg(F.ceil(F.count("*") / ROWS_PER_FILE).cast("int").alias("_parts"))
    placed = rows.join(counts.withColumnRenamed(by, "_by"), F.col(by).eqNullSafe(F.col("_by")), "left").withColumn(
        "_part", F.pmod(F.xxhash64(*rows.columns), F.col("_parts"))
    )
    placed.repartition(by, "_part").select(*rows.columns).write.mode(mode).option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(by).format(fmt).save(path)


def write_host_files(reports: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """One folder per host with the names its reports are kept by."""
    _write_folders(host_files(reports), "host", path, fmt, mode)


def write_manifest(manifest: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """A file or bundle manifest as a table."""
    manifest.write.mode(mode).format(fmt).save(path)


def write_routed(records: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Routed log records, one folder per sink."""
    _write_folders(records, "route", path, fmt, mode)


def write_checksums(manifest: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``<sha256>  <name>`` lines of a file manifest, sorted by name."""
    line = F.concat_ws("  ", "sha256", "name")
    manifest.orderBy("name", "sha256").select(line.alias("line")).write.mode(mode).text(path)
