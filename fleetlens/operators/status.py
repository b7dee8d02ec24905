"""The final status of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK, CRITICAL, WARN = 0, 1, 2  # fixed values


def run_status(events: DataFrame) -> DataFrame:
    """Per run the last status written, 0 if none was: (run_id, status, worst_status).

    The last write wins even when it is milder; ``worst_status`` keeps the most
    severe one, where 1 is worse than 2. Events go by ``seq``, not by arrival, and an
    event that comes twice counts once, so this also holds for a stream
    (``streaming.runs``), whose state is one row a run.
    """
    return _folded(events, F.lit(False)).drop("ended_at")


def run_outcome(events: DataFrame) -> DataFrame:
    """The same where an event may end its run: (run_id, status, worst_status, ended_at).

    An event with ``ends`` is the direct exit of a run, which is critical whatever was written before; what has a
    later ``seq`` is not of the run any more. ``ended_at`` is the seq of the first such event, else null.
    """
    return _folded(events, F.coalesce("ends", F.lit(False)))


def _folded(events: DataFrame, ends: Column) -> DataFrame:
    """One aggregate: the first end decides, as what is written before it does not show and after it does not count."""
    severity = F.when(F.col("status_set") == CRITICAL, 2).when(F.col("status_set") == WARN, 1).otherwise(0)
    worst = F.max(severity)
    written = F.col("status_set").isNotNull()
    last = F.max_by("status_set", F.when(written, F.col("seq")))
    ended = F.col("_ended").isNotNull()
    found = events.groupBy("run_id").agg(
        last.alias("_last"), worst.alias("_worst"), F.min(F.when(ends, F.col("seq"))).alias("_ended")
    )
    columns = [
        "run_id",
        F.when(ended, CRITICAL).otherwise(F.coalesce("_last", F.lit(OK))).alias("status"),
        F.when(ended | (F.col("_worst") == 2), CRITICAL)
        .when(F.col("_worst") == 1, WARN)
        .otherwise(OK)
        .alias("worst_status"),
    ]
    return found.select(*columns, F.col("_ended").alias("ended_at"))
