"""Clock text, instants and signed differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An ISO time, white space around it aside; date and time may go without separators, seconds may
# be missing, a fraction may follow a point or a comma. The groups are the parts of ``_plain``.
_PARTS = r"(\d{4})-?(\d{2})-?(\d{2})[Tt ]?(\d{2}):?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?"
_OFFSET = r"[ ]?([Zz]|[+-]\d{2}(?::?\d{2})?)"
ISO_LOCAL = rf"\A\s*{_PARTS}\s*\z"
ISO_TIME = rf"\A\s*{_PARTS}{_OFFSET}\s*\z"
_DAY = 86_400_000_000
_HOUR = 3_600_000_000
_MINUTE = 60_000_000
_SECOND = 1_000_000


def _plain(text: Column, pattern: str, offset: str) -> Column:
    """``date time.fraction[offset]`` of text that fits the pattern; other text as it is."""
    # Absent seconds and fractions read as nothing, so a zero before them changes no value.
    spread = F.regexp_replace(text, pattern, rf"$1-$2-$3 $4:$5:0$6.$7{offset}")
    seconds = F.regexp_replace(spread, r"\A(.{17})0(\d\d)", "$1$2")
    whole = F.regexp_replace(seconds, r"\A(.{17})0\.", "$100.")
    bare = F.regexp_replace(whole, r"\.(?=\z|[Zz+-])", "")
    return F.regexp_replace(bare, r"z\z", "Z")


def iso_time(text: Column) -> Column:
    """An ISO time with offset as ``date time[.fraction]offset``; other text is empty."""
    return F.when(text.rlike(ISO_TIME), _plain(text, ISO_TIME, "$8")).when(text.isNotNull(), "")


def lacks_offset(text: Column) -> Column:
    """The text is a valid ISO time but for its missing offset."""
    return F.when(text.rlike(ISO_LOCAL), F.try_to_timestamp(_plain(text, ISO_LOCAL, "")).isNotNull()).otherwise(False)


def shown_iso(time: Column) -> Column:
    """An ISO time with offset as ``date time[.ffffff]+HH:MM``, as its own clock showed it."""
    local = time.try_cast("timestamp_ntz").cast("string")
    hours = F.regexp_extract(time, r"([+-]\d{2})(?::?(\d{2}))?\z", 1)
    minutes = F.regexp_extract(time, r"([+-]\d{2})(?::?(\d{2}))?\z", 2)
    return F.concat(
        F.when(F.length(local) > 19, F.rpad(local, 26, "0")).otherwise(local),
        F.when(time.endswith("Z"), "+00:00").otherwise(
            F.concat(hours, F.lit(":"), F.when(minutes == "", "00").otherwise(minutes))
        ),
    )


def shown_instant(time: Column) -> Column:
    """A timestamp as ``date time[.ffffff]offset`` in the session zone."""
    return F.replace(F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"), F.lit(".000000"), F.lit(""))


def _div(value: Column, size: int) -> Column:
    return ((value - value % size) / size).cast("bigint")


def _digits(value: Column, size: int) -> Column:
    return F.lpad(value.cast("string"), size, "0")


def duration(micros: Column) -> Column:
    """Non-negative microseconds as ``[D day[s], ]H:MM:SS[.ffffff]``."""
    days, rest, fraction = _div(micros, _DAY), micros % _DAY, micros % _SECOND
    return F.concat(
        F.when(days == 0, "").when(days == 1, "1 day, ").otherwise(F.concat(days.cast("string"), F.lit(" days, "))),
        _div(rest, _HOUR).cast("string"),
        F.lit(":"),
        _digits(_div(rest % _HOUR, _MINUTE), 2),
        F.lit(":"),
        _digits(_div(rest % _MINUTE, _SECOND), 2),
        F.when(fraction == 0, "").otherwise(F.concat(F.lit("."), _digits(fraction, 6))),
    )


def signed_duration(micros: Column) -> Column:
    """The same with a sign in front: ``+`` only above zero, so zero prints ``-``."""
    return F.concat(F.when(micros > 0, "+").otherwise("-"), duration(F.abs(micros)))
