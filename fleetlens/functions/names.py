"""File and bundle names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import base_name


def bundle_name(tool: str, created: Column, ticket: Column | None = None, extension: str = "tar.xz") -> Column:
    """``sosreport-<tool>[-<ticket>]-<yyyymmddHHMMSS>.<extension>``."""
    ticket = F.lit(None).cast("string") if ticket is None else F.nullif(ticket.cast("string"), F.lit(""))
    stem = F.concat_ws(
        "-", F.lit("sosreport"), F.lit(tool), ticket, F.date_format(created, "yyyyMMddHHmmss")
    )
    return F.concat_ws(".", stem, F.lit(extension))


def without_extension(name: Column) -> Column:
    """The name without its last extension; leading dots do not start one."""
    return F.regexp_replace(name, r"(?s)\A((?:.*/)?\.*[^/.][^/]*)\.[^/.]*\z", "$1")


def stem(path: Column) -> Column:
    """The base name up to its first dot."""
    return F.substring_index(base_name(path), ".", 1)


def host_file(host: Column, path: Column) -> Column:
    """The name of a report inside its host's folder: ``<host>-<base name>``."""
    return F.concat_ws("-", host, base_name(path))


def prefixed(prefix: str, path: Column) -> Column:
    """``<prefix>-<base name>``; null stays null."""
    return F.concat(F.lit(prefix + "-"), base_name(path))
