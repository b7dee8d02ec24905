"""Credential lines found after a marker.

A file holds lines ``host:port:database:user:password``, ``#`` comments, and one
line with the marker. The first entry after the marker counts for every field.
For the password alone, an entry of the wanted user ahead of the marker wins.
Blank lines are skipped and every field is stripped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, lines, strip
from .spread import spread_join

ADMIN_MARKER = "DB ADMIN credentials"  # fixed value


def _is_entry(line: Column, marker: str) -> Column:
    return ~line.startswith("#") & ~line.contains(marker) & ~is_blank(line)


def _field(line: Column, index: int) -> Column:
    return F.get(F.split(line, ":", 5), F.lit(index))


def _of_user(line: Column, user: Column | str | None) -> Column:
    if user is None:
        return F.lit(False)
    user = F.lit(user) if isinstance(user, str) else user
    return F.coalesce((_field(line, 3) == user) & _field(line, 4).isNotNull(), F.lit(False))


def _fields(entry: Column, early: Column) -> list[Column]:
    return [
        strip(_field(entry, 0)).alias("host"),
        strip(_field(entry, 1)).alias("port"),
        strip(_field(entry, 3)).alias("admin"),
        strip(_field(F.coalesce(early, entry), 4)).alias("pass"),
    ]


def section_lookup(
    files: DataFrame,
    marker: str = ADMIN_MARKER,
    user: Column | str | None = None,
    text: str = "text",
) -> DataFrame:
    """One row per file with its host, port, admin and pass; null where not found.

    A projection over whole texts: no shuffle, and fit for streams.
    """
    rest = [name for name in files.columns if name != text]
    # Only text that can hold an answer is cut into lines.
    relevant = F.col(text).contains(marker)
    if user is not None:
        relevant = relevant | F.col(text).contains(user)
    marked = files.select(*rest, F.when(relevant, lines(F.col(text))).alias("_lines")).select(
        *rest,
        "_lines",
        F.array_position(F.transform("_lines", lambda line: line.contains(marker)), True)
        .cast("int")
        .alias("_marker"),
    )
    at = F.col("_marker")
    tail = F.when(at > 0, F.slice("_lines", at + 1, F.size("_lines") - at))
    head = F.when(at > 0, F.slice("_lines", F.lit(1), at - 1)).otherwise(F.col("_lines"))
    entry = F.get(F.filter(tail, lambda line: _is_entry(line, marker)), F.lit(0))
    early = F.get(
        F.filter(head, lambda line: _is_entry(line, marker) & _of_user(line, user)), F.lit(0)
    )
    return marked.select(*rest, entry.alias("_entry"), early.alias("_early")).select(
        *rest, *_fields(F.col("_entry"), F.col("_early"))
    )


def section_lookup_of_lines(
    line_table: DataFrame,
    marker: str = ADMIN_MARKER,
    user: str | None = None,
    by: str = "report_id",
) -> DataFrame:
    """The same over a table of lines, for files cut into any number of rows.

    Files with neither an entry behind a marker nor one of the user give no row.
    Only line numbers are joined and aggregated; the text comes last, of at most
    two lines per file. Entries meet their file's marker in a join that splits a
    file with a third of all lines.
    """
    line, number = F.col("line"), F.col("line_no")
    is_entry = _is_entry(line, marker)
    marks = (
        line_table.groupBy(by)
        .agg(
            F.min(F.when(line.contains(marker), number)).alias("_marker"),
            F.min(F.when(is_entry & _of_user(line, user), number)).alias("_early"),
        )
        .filter("_marker is not null or _early is not null")
    )
    behind = (
        spread_join(line_table.filter(is_entry).select(by, "line_no"), marks.filter("_marker is not null"), [by], "inner")
        .filter("line_no > _marker")
        .groupBy(by)
        .agg(F.min("line_no").alias("_no"))
    )
    # An entry of the user behind the marker is never ahead of the first entry there.
    ahead = marks.filter("_early is not null and (_marker is null or _early < _marker)")
    wanted = behind.select(by, F.col("_no").alias("line_no"), F.lit(True).alias("_behind")).unionByName(
        ahead.select(by, F.col("_early").alias("line_no"), F.lit(False).alias("_behind"))
    )
    return (
        line_table.filter(is_entry)
        .join(wanted, [by, "line_no"])
        .groupBy(by)
        .agg(
            F.max(F.when(F.col("_behind"), line)).alias("_entry"), F.max(F.when(~F.col("_behind"), line)).alias("_early")
        )
        .select(by, *_fields(F.col("_entry"), F.col("_early")))
    )
