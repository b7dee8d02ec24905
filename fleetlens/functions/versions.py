"""Version text as something that compares in version order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def version_key(version: Column) -> Column:
    """``struct(major, minor)`` of a dotted version; null when it has no number.

    Compared as a struct, 3.10 is later than 3.2, which neither text order nor
    dropping the dots would give.
    """
    parts = F.split(version, r"\.")
    major = F.get(parts, F.lit(0)).try_cast("int")
    minor = F.coalesce(F.get(parts, F.lit(1)), F.lit("0")).try_cast("int")
    return F.when(
        major.isNotNull() & minor.isNotNull(),
        F.struct(major.alias("major"), minor.alias("minor")),
    )


def at_least(version: Column, major: int, minor: int) -> Column:
    """The version is major.minor or later; False when it is unknown."""
    key = version_key(version)
    return F.coalesce(
        (key["major"] > major) | ((key["major"] == major) & (key["minor"] >= minor)),
        F.lit(False),
    )
