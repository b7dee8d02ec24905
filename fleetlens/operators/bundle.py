"""Manifests of collected files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import host_file, prefixed
from ..functions.text import base_name, megabytes

ADVICE_BYTES = 1000 << 20  # fixed value: from this size on, narrower filters are advised
DATABASE_PREFIX = "postgresql"  # fixed value
SIDECARS = ("md5", "sha256")  # fixed values, preferred first


def file_manifest(files: DataFrame) -> DataFrame:
    """One row per file: bundle, name, length, SHA-256 of the whole content."""
    content = F.col("content").cast("binary")
    return files.select(
        "bundle",
        base_name(F.col("path")).alias("name"),
        F.octet_length(content).cast("bigint").alias("length"),
        F.sha2(content, 256).alias("sha256"),
    )


def bundle_manifest(files: DataFrame) -> DataFrame:
    """One row per bundle: files, bytes, size text and whether to advise filters.

    Needs (bundle, length). Lengths are summed before the shuffle, so one bundle
    may hold any share of the files.
    """
    return files.groupBy("bundle").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    ).select(
        "bundle",
        "files",
        "bytes",
        megabytes(F.col("bytes")).alias("size"),
        (F.col("bytes") >= ADVICE_BYTES).alias("advise_filters"),
    )


def bundle_checksums(manifest: DataFrame) -> DataFrame:
    """One checksum per bundle from its file manifest: (bundle, checksum), 60 hex digits.

    It depends on every file's name and content and on nothing else, neither
    order nor packing. Each file's line ``<sha256>  <name>`` is hashed and the
    hashes are combined by exclusive or, so a bundle of any size is summed before
    the shuffle. Repeated lines would cancel out, so their number goes in as well.
    """
    line = F.sha2(F.concat_ws("  ", "sha256", "name"), 256)
    lines = manifest.groupBy("bundle", line.alias("_line")).agg(F.count("*").alias("_times"))
    marked = F.sha2(F.concat_ws(" ", "_line", "_times"), 256)
    words = [
        F.bit_xor(F.conv(F.substring(marked, 1 + 15 * part, 15), 16, 10).cast("bigint")).alias(f"_{part}")
        for part in range(4)
    ]
    digits = [F.lpad(F.lower(F.hex(f"_{part}")), 15, "0") for part in range(4)]
    return lines.groupBy("bundle").agg(*words).select("bundle", F.concat(*digits).alias("checksum"))


def bundle_messages(manifest: DataFrame, folder: str) -> DataFrame:
    """What is said about each finished bundle: (bundle, checksum, size, message).

    ``manifest`` is the file manifest (bundle, name, length, sha256).
    """
    sizes = bundle_manifest(manifest.select("bundle", "length"))
    path = F.concat(F.lit(folder.rstrip("/") + "/"), F.col("bundle"))
    # The message and the advice.
    message = F.concat(
        F.lit("Log files have been collected and placed in "),
        path,
        F.lit("\nThe sha256 for this file is "),
        F.col("checksum"),
        F.lit(" and its size is "),
        F.col("size"),
        F.when(
            F.col("advise_filters"),
            "\nYou can use the following filters -c, -d, -H in the next execution to limit the number of Datacenters,"
            "\nClusters or Hosts that are collected in order to reduce the archive size.",
        ).otherwise(""),
    )
    return sizes.join(bundle_checksums(manifest), "bundle").select(
        "bundle", "checksum", "size", message.alias("message")
    )


def host_files(reports: DataFrame) -> DataFrame:
    """Where each host's report goes: its own folder, with the host in the name."""
    return reports.select("host", "path", host_file(F.col("host"), F.col("path")).alias("name"))


def database_files(files: DataFrame) -> DataFrame:
    """Database reports and their checksum files under the names they are kept by.

    Input is a listing (path). A report is a path that is no checksum file. Of
    its checksum files the first kind in :data:`SIDECARS` counts; without any
    the sidecar columns are null.
    """
    kinds = "|".join(SIDECARS)
    report = F.regexp_extract("path", rf"(?s)\A(.*)\.({kinds})\z", 1)
    kind = F.regexp_extract("path", rf"(?s)\A(.*)\.({kinds})\z", 2)
    preference = F.lit(len(SIDECARS))
    for rank, name in enumerate(SIDECARS):
        preference = F.when(kind == name, rank).otherwise(preference)
    is_sidecar = kind != ""
    owner = F.when(is_sidecar, report).otherwise(F.col("path"))
    return (
        files.groupBy(owner.alias("path"))
        .agg(
            F.bool_or(~is_sidecar).alias("_report"),
            F.min(F.when(is_sidecar, F.struct(preference.alias("rank"), F.col("path").alias("path")))).alias("_side"),
        )
        .filter("_report")
        .select(
            "path",
            prefixed(DATABASE_PREFIX, F.col("path")).alias("kept_as"),
            F.col("_side.path").alias("sidecar"),
            prefixed(DATABASE_PREFIX, F.col("_side.path")).alias("sidecar_kept_as"),
        )
    )
