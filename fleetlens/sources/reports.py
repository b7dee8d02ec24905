"""Report output, credential files and collected files as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import base_name
from ..operators.reports import report_lines
from ..operators.sections import ADMIN_MARKER, section_lookup
from .listing import RANGE, list_files, tree_manifest, whole_sums
from .settings import empty_files, read_files


def read_reports(spark: SparkSession, *paths: str) -> DataFrame:
    """Landed report output, one row per file, also of an empty one: (report_id, text).

    The id is the file's path, so a folder per host keeps hosts apart.
    """
    return read_files(spark, *paths).withColumnRenamed("file", "report_id")


def read_report_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Landed report output of any size as numbered lines: (report_id, line_no, line).

    Large files are read in blocks by many tasks. A line's number is its place in
    its block after the lines of the file's blocks before it. Lines end at line
    feeds and carriage returns; a file without content has no line.
    """
    read = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("report_id"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )
    blocks = read.groupBy("report_id", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_lines"))
    # One row per block of a file.
    before = Window.partitionBy("report_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "report_id", "_block", "_first", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_before")
    )
    return read.join(starts, ["report_id", "_block"]).select(
        "report_id", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "line"
    )


def host_listings(files: DataFrame) -> DataFrame:
    """(host, file, text) of listings landed as ``<host>/.../<file>``: (file, text).

    The host is the name of the folder two levels above the file, as the
    collector lays it out. An empty listing keeps its row.
    """
    return files.select(F.element_at(F.split("file", "/"), -3).alias("host"), "file", "text")


def read_host_listings(spark: SparkSession, *paths: str) -> DataFrame:
    """Landed directory listings as lines per host; ``host_listings`` also keeps the empty ones."""
    return report_lines(host_listings(read_files(spark, *paths)).select("host", "text"))


def read_credentials(
    spark: SparkSession, *paths: str, marker: str = ADMIN_MARKER, user: str | None = None
) -> DataFrame:
    """host, port, admin and pass of credential files: one row per file."""
    return section_lookup(read_files(spark, *paths), marker, user)


def collected_files(files: DataFrame, path: str) -> DataFrame:
    """(bundle, path, length, content) of files (path, length, content) below a folder.

    The bundle is the first folder below ``path``.
    """
    return files.select(_bundle(path), "path", "length", "content")


def read_collected(spark: SparkSession, path: str) -> DataFrame:
    """Files of finished collections, also empty ones: (bundle, path, length, content).

    Content is only read by jobs that use it. A file over 2 GiB fails the job
    that reads its content; its length can be read all the same, and
    ``read_manifest`` gives its checksum.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # The listing escapes names as in URLs, where a plus sign stands for itself; ``path`` is the plain name.
    plain = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
    nothing = empty_files(spark, path, recursiveFileLookup="true").select(
        plain.alias("path"), F.lit(0).cast("bigint").alias("length"), F.unhex(F.lit("")).alias("content")
    )
    return collected_files(files.select("path", "length", "content").unionByName(nothing), path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``file_manifest`` of finished collections straight from storage, for files of any size: (bundle, name, length,
    sha256).

    A file's sum is made by one task, which holds a megabyte of it at a time.
    """
    sums = whole_sums(list_files(spark, path, recursive=True))
    return sums.select(_bundle(path), base_name(F.col("path")).alias("name"), "length", "sha256")


def read_tree_manifest(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """The same with a checksum that many tasks make of one file: (bundle, name, length, feeds, tree).

    ``tree`` is made of the sums of ranges of ``size`` bytes; ``feeds`` is the number of line feeds.
    """
    trees = tree_manifest(list_files(spark, path, recursive=True), size)
    return trees.select(_bundle(path), base_name(F.col("path")).alias("name"), "length", "feeds", "tree")


def _bundle(path: str) -> Column:
    return F.regexp_extract("path", rf"\A.*?{_quoted(path)}/([^/]+)/", 1).alias("bundle")


def _quoted(path: str) -> str:
    bare = path.split(":", 1)[-1].rstrip("/")
    return "".join(char if char.isalnum() or char == "/" else "\\" + char for char in bare)
