"""Clock drift between hosts and the management node."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import iso_time, lacks_offset, shown_instant, shown_iso, signed_duration

# The line format and the column titles of the drift report.
DRIFT_FORMAT = "%-17s : %-33s : %-33s : %-35s"
DRIFT_TITLES = ("Node", "Node Time", "Engine Time", "Clock Drift Between Engine and Node")
DRIFT_HEADER = DRIFT_FORMAT % DRIFT_TITLES


def _parsed(probes: DataFrame) -> DataFrame:
    """Probes with the host's instant; null where its text is no time with offset.

    A generator over one value stands between the steps: no filter on a result is
    pushed below it, where it would parse every text again.
    """
    return probes.select(
        "probe_id",
        "host",
        "host_time_raw",
        F.col("engine_time").cast("timestamp"),
        F.explode_outer(F.array(iso_time(F.col("host_time_raw")))).alias("_iso"),
    ).select("*", F.explode_outer(F.array(F.try_to_timestamp("_iso"))).alias("host_time"))


def _drift_us() -> Column:
    return F.unix_micros("host_time") - F.unix_micros("engine_time")


def clock_drift(probes: DataFrame) -> DataFrame:
    """One row per probe (probe_id, host, host_time_raw, engine_time), row-wise.

    ``outcome`` is ``ok``, ``skipped`` for text that is no time, or ``warn`` for
    a time without an offset. Drift is null unless the outcome is ``ok``; it is
    positive when the host's clock is ahead.
    """
    ok = F.col("host_time").isNotNull()
    # One projection per step, so that each step's result is computed once.
    return (
        _parsed(probes)
        .select("*", _drift_us().alias("drift_us"))
        .select(
            "probe_id",
            "host",
            "host_time",
            F.when(ok, shown_iso(F.col("_iso"))).alias("host_time_text"),
            "engine_time",
            shown_instant(F.col("engine_time")).alias("engine_time_text"),
            "drift_us",
            signed_duration(F.col("drift_us")).alias("drift"),
            F.when(ok, "ok")
            .when(lacks_offset(F.col("host_time_raw")), "warn")
            .otherwise("skipped")
            .alias("outcome"),
        )
    )


def drift_report(probes: DataFrame, ordered: bool = True) -> DataFrame:
    """The drift report: titles as part 0, then one line per ``ok`` probe, by host if ``ordered``.

    A global sort reads its input twice, so only the times are sorted and the
    texts are made afterwards. Unordered, it is a projection without a shuffle.
    """
    header = probes.sparkSession.range(1).selectExpr(
        "0 as part",
        "cast(null as string) as host",
        "cast(null as bigint) as probe_id",
        "cast(null as timestamp) as engine_time",
        "cast(null as string) as _iso",
        "cast(null as timestamp) as host_time",
    )
    body = (
        _parsed(probes)
        .filter("host_time is not null")
        .selectExpr("1", "cast(host as string)", "cast(probe_id as bigint)", "engine_time", "_iso", "host_time")
    )
    line = F.format_string(
        DRIFT_FORMAT,
        F.concat("host", F.lit(" ")),
        shown_iso(F.col("_iso")),
        shown_instant(F.col("engine_time")),
        signed_duration(F.col("drift_us")),
    )
    rows = header.union(body)
    return (
        (rows.orderBy("part", "host", "probe_id") if ordered else rows)
        .select("*", _drift_us().alias("drift_us"))
        .select("part", "host", F.when(F.col("part") == 0, DRIFT_HEADER).otherwise(line).alias("line"))
    )
