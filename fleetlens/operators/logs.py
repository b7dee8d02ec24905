"""Log lines ``time::level::module::line::logger:: message``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import explode_lines, strings
from .carry import carry_down

# Log levels and their ranks.
LEVELS = {"DEBUG": 10, "INFO": 20, "WARNING": 30, "ERROR": 40, "CRITICAL": 50}


def severity(level: Column) -> Column:
    """The rank of a level name; null for any other text."""
    rank = F.lit(None).cast("int")
    for name, value in LEVELS.items():
        rank = F.when(level == name, value).otherwise(rank)
    return rank


def parse_log_lines(rows: DataFrame, column: str = "line") -> DataFrame:
    """Each line with its six fields and severity; row-wise.

    A ``::`` inside the message is kept. A line with fewer fields, such as the
    further lines of a message, has ``parsed`` false and null fields.
    """
    rest = rows.columns
    parts = F.split(F.col(column), "::", 6)

    def part(index: int) -> Column:
        return F.when(F.size("_parts") == 6, F.get("_parts", F.lit(index)))

    return rows.select(*rest, parts.alias("_parts")).select(
        *rest,
        F.coalesce(F.size("_parts") == 6, F.lit(False)).alias("parsed"),
        part(0).alias("time"),
        part(1).alias("level"),
        part(2).alias("module"),
        part(3).try_cast("int").alias("lineno"),
        part(4).alias("logger"),
        F.regexp_replace(part(5), r"\A ", "").alias("message"),
        severity(part(1)).alias("severity"),
    )


def log_records(
    rows: DataFrame, by: Sequence[str] = ("file",), order: str = "line_no", column: str = "line"
) -> DataFrame:
    """Each line with the record it is of: the further lines of a message, such as a traceback, keep its fields.

    Gives (by, order, line, record_no, part, time, level, module, lineno, logger, message, severity): ``record_no`` is
    the number of the record's first line, ``part`` the line's place in it from 0 on, and ``message`` this line's part
    of the text. Lines above a file's first record are of none and have nulls. The fields are carried down over
    blocks of lines, so a record may hold a third of all lines; its lines stay rows.
    """
    by = list(by)
    fields = ["time", "level", "module", "lineno", "logger", "severity"]
    parsed = parse_log_lines(rows.select(*by, order, column), column)
    first = F.when(F.col("parsed"), F.struct(F.col(order).alias("record_no"), *fields))
    carried = carry_down(parsed.select(*by, order, column, "parsed", "message", *fields), first, by, order, "_record")
    number = F.col("_record.record_no")
    return carried.select(
        *by,
        order,
        column,
        number.alias("record_no"),
        (F.col(order) - number).alias("part"),
        *[F.col(f"_record.{name}").alias(name) for name in fields[:-1]],
        F.when(F.col("parsed"), F.col("message")).when(number.isNotNull(), F.col(column)).alias("message"),
        F.col("_record.severity").alias("severity"),
    )


def message_lines(records: DataFrame, column: str = "message") -> DataFrame:
    """One record per line of a message, numbered from 1."""
    return explode_lines(records, column, column, "part")


def routes(minimum: str = "INFO", quiet: bool = False, log_file: bool = True) -> Column:
    """Where a record goes, as an array over ``file``, ``stderr``, ``stdout`` and ``unparsed``.

    Errors go to stderr and the rest, from the minimum level on, to stdout. A log
    file takes everything from the minimum level on. Quiet runs write to the file
    alone, or without one only errors to stderr. What has no known level is kept
    apart as ``unparsed``, whatever the options.
    """
    rank = F.col("severity")
    error, shown = rank >= LEVELS["ERROR"], rank >= LEVELS[minimum]

    def route(condition: Column, name: str) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), strings([name])).otherwise(strings([]))

    to_file = route(shown, "file") if log_file else strings([])
    unparsed = route(rank.isNull(), "unparsed")
    if quiet:
        return F.concat(to_file if log_file else route(error, "stderr"), unparsed)
    return F.concat(to_file, route(error, "stderr"), route(shown & ~error, "stdout"), unparsed)


def route_records(
    records: DataFrame, minimum: str = "INFO", quiet: bool = False, log_file: bool = True
) -> DataFrame:
    """One row per record and sink it goes to, with the sink in ``route``."""
    return records.withColumn("route", F.explode(routes(minimum, quiet, log_file)))
