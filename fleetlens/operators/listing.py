"""The host listing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import python_bool

# The line of the selection, the line format and the column titles of the listing.
LISTING_SELECTION = "Host list (datacenter=%s, cluster=%s, host=%s):"
LISTING_FORMAT = "%-20s | %-20s | %-20s | %-7s | %s"
LISTING_TITLES = ("Data Center", "Cluster", "Hostname/IP Address", "SPM", "Up")
LISTING_HEADER = LISTING_FORMAT % LISTING_TITLES


def listing_line() -> Column:
    """One inventory row as a fixed-width line."""
    return F.format_string(
        LISTING_FORMAT,
        "datacenter",
        "cluster",
        "address",
        python_bool(F.col("is_spm")),
        python_bool(F.col("is_up")),
    )


def list_hosts(selected: DataFrame) -> DataFrame:
    """Chosen hosts sorted by address, with their listing line.

    The other columns break ties, which also lets a hot address span ranges.
    """
    return selected.orderBy("address", "datacenter", "cluster", "cluster_id").select(
        "datacenter", "cluster", "address", "is_spm", "is_up", listing_line().alias("line")
    )


def selection_line(
    hosts: Iterable[str] | None = None,
    datacenters: Iterable[str] | None = None,
    clusters: Iterable[str] | None = None,
) -> str:
    """The line above the titles: what was asked for. An option that was not given reads None."""
    shown = [None if values is None else ",".join(values) for values in (datacenters, clusters, hosts)]
    return LISTING_SELECTION % tuple(shown)


def listing_report(
    selected: DataFrame,
    hosts: Iterable[str] | None = None,
    datacenters: Iterable[str] | None = None,
    clusters: Iterable[str] | None = None,
) -> DataFrame:
    """The listing as it is printed: the selection, the titles, then the hosts in order.

    ``part`` is 0 for the selection, 1 for the titles and 2 for hosts.
    """
    heads = F.array(F.lit(selection_line(hosts, datacenters, clusters)), F.lit(LISTING_HEADER))
    keys = ("address", "datacenter", "cluster", "cluster_id")
    header = selected.sparkSession.range(1).select(F.posexplode(heads).alias("part", "line")).select(
        "part", *[F.lit(None).cast("string").alias(name) for name in keys], "line"
    )
    body = selected.select(F.lit(2), *keys, listing_line())
    return header.union(body).orderBy("part", *keys).select("part", "address", "line")
