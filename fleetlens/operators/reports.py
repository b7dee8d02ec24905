"""Report text: lines, first matches, and the files a report names.

Each job comes in two shapes. On landed reports (one row per report) it is a
plain projection without a shuffle, and also works on a stream. On a table of
lines, which may cut one report into any number of rows, it is an aggregation
over the matching lines only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.globs import glob, longest_literal
from ..functions.text import absolute, after, base_name, explode_lines, lines, strip

# The lines that name a report's archive and its checksum.
ARCHIVE_LINE = "*sosreport-*tar*"
CHECKSUM_LINE = "The sha256sum is*"


def report_lines(reports: DataFrame, text: str = "text") -> DataFrame:
    """One row per line, numbered from 1 inside its report."""
    return explode_lines(reports, text, "line", "line_no")


def first_match(line_table: DataFrame, predicate: Column, by: str = "report_id") -> DataFrame:
    """Per report the first line that fulfils the predicate (over ``line``)."""
    return (
        line_table.filter(predicate)
        .groupBy(by)
        .agg(F.min(F.struct("line_no", "line")).alias("_first"))
        .select(by, "_first.line_no", "_first.line")
    )


def _refs(archive: Column, checksum: Column, folder: Column | str) -> list[Column]:
    path = strip(archive)
    return [
        base_name(path).alias("filename"),
        absolute(path, folder).alias("path"),
        F.when(archive.isNotNull(), after(checksum, ": ")).alias("checksum"),
        archive.isNull().alias("missing_report"),
    ]


def report_refs(reports: DataFrame, folder: Column | str, text: str = "text") -> DataFrame:
    """File name, path and checksum that each report's output names.

    The first archive line and the first checksum line count. A relative path is
    taken to lie in the folder. Without an archive line the report is missing.
    """
    rest = [name for name in reports.columns if name != text]

    def first(pattern: str) -> Column:
        literal = longest_literal(pattern)
        return F.get(F.filter("_lines", lambda line: line.contains(literal) & glob(line, pattern)), F.lit(0))

    # Text that holds neither pattern's literal is not cut into lines at all.
    relevant = F.col(text).contains(longest_literal(ARCHIVE_LINE)) | F.col(text).contains(
        longest_literal(CHECKSUM_LINE)
    )
    return (
        reports.select(*rest, F.when(relevant, lines(F.col(text))).alias("_lines"))
        .select(*rest, first(ARCHIVE_LINE).alias("_archive"), first(CHECKSUM_LINE).alias("_checksum"))
        .select(*rest, *_refs(F.col("_archive"), F.col("_checksum"), folder))
    )


def report_refs_of_lines(line_table: DataFrame, folder: Column | str, by: str = "report_id") -> DataFrame:
    """The same over a table of lines.

    One aggregate over all lines finds the numbers of the two lines, which keeps
    reports without a match. The text is then taken from the matching lines only.
    """
    archive, checksum = glob(F.col("line"), ARCHIVE_LINE), glob(F.col("line"), CHECKSUM_LINE)
    numbers = line_table.groupBy(by).agg(
        F.min(F.when(archive, F.col("line_no"))).alias("_archive_no"),
        F.min(F.when(checksum, F.col("line_no"))).alias("_checksum_no"),
    )

    def texts(condition: Column, name: str) -> DataFrame:
        return line_table.filter(condition).select(by, F.col("line_no").alias(f"{name}_no"), F.col("line").alias(name))

    return (
        numbers.join(texts(archive, "_archive"), [by, "_archive_no"], "left")
        .join(texts(checksum, "_checksum"), [by, "_checksum_no"], "left")
        .select(by, *_refs(F.col("_archive"), F.col("_checksum"), folder))
    )
