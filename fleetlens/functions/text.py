"""Text helpers over columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The line breaks of a report (the set Python calls line boundaries),
# as a pattern and, all but the plain newline, as single characters.
LINE_BREAK = "\\r\\n|[\\n\\x0b\\x0c\\r\\x1c-\\x1e\\x85\\u2028\\u2029]"
_RARE_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
_SPACE = r"[\s\x1c-\x1f]"


def strip(column: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.regexp_replace(column, rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


def is_blank(column: Column) -> Column:
    """True for text of white space alone, or none."""
    return ~column.rlike(rf"(?U)[^{_SPACE[1:]}")


def lines(text: Column) -> Column:
    """Text cut into an array of lines; a final line break opens no new line.

    Most text only has plain newlines, and splitting at one fixed character is
    several times faster than at a pattern. Put this in a projection of its own:
    a generator or a lambda around it may evaluate it more than once.
    """
    rare = reduce(lambda left, right: left | right, (text.contains(char) for char in _RARE_BREAKS))
    plain = F.when(text.endswith("\n"), text.substr(F.lit(1), F.length(text) - 1)).otherwise(text)
    return (
        F.when(rare, F.split(F.regexp_replace(text, rf"(?:{LINE_BREAK})\z", ""), LINE_BREAK))
        .when(text == "", F.array().cast("array<string>"))
        .otherwise(F.split(plain, "\n"))
    )


def explode_lines(df: DataFrame, text: str, line: str, number: str, first: int = 1) -> DataFrame:
    """One row per line of a text column, numbered; the other columns are kept.

    The outer generator and the filter on its own number cut every text once: for
    a plain generator Spark infers a filter on its input, which cuts again.
    """
    rest = [name for name in df.columns if name != text]
    cut = df.select(*rest, lines(F.col(text)).alias("_lines"))
    return (
        cut.select(*rest, F.posexplode_outer("_lines").alias("_at", line))
        .filter(F.col("_at").isNotNull())
        .select(*rest, (F.col("_at") + first).alias(number), line)
    )


def base_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(path, "/", -1)


def absolute(path: Column, folder: Column | str) -> Column:
    """An absolute path as it is; otherwise its base name inside the folder."""
    folder = F.lit(folder) if isinstance(folder, str) else folder
    return F.when(path.startswith("/"), path).otherwise(F.concat(folder, F.lit("/"), base_name(path)))


def after(column: Column, separator: str) -> Column:
    """What follows the first separator; empty when there is none."""
    at = F.instr(column, F.lit(separator))
    return F.when(column.isNull(), None).otherwise(
        F.when(at > 0, column.substr(at + F.lit(len(separator)), F.length(column))).otherwise("")
    )


def first_word(column: Column) -> Column:
    """The first white-space separated word."""
    return F.regexp_extract(column, r"\S+", 0)


def comma_list(column: Column) -> Column:
    """A comma list as an array of trimmed items."""
    return F.transform(F.split(column, ","), strip)


def key_list(column: Column) -> Column:
    """A comma list of keys in the colon form the reporters take."""
    return F.replace(column, F.lit(","), F.lit(":"))


def options(*parts: Column | str) -> Column:
    """The parts that are set, joined by one space."""
    return F.concat_ws(" ", *[F.lit(part) if isinstance(part, str) else part for part in parts])


def only_if(condition: Column, *values: Column | str) -> Column:
    """An array of the values when the condition holds, else an empty array."""
    items = F.array(*[F.lit(value) if isinstance(value, str) else value for value in values])
    return F.when(condition, items).otherwise(F.array().cast("array<string>"))


def strings(values) -> Column:
    """A literal array<string>, possibly empty; the values hold no comma."""
    return F.split(F.lit(",".join(values)), ",") if values else F.array().cast("array<string>")


def python_bool(column: Column) -> Column:
    """True / False as text."""
    return F.when(column, "True").when(~column, "False")


def megabytes(total: Column) -> Column:
    """Bytes as MiB text with one decimal, e.g. ``12.3M``.

    Rounding is half-to-even on the exact value, done on whole numbers so that
    it does not depend on how a double prints.
    """
    scaled = total.cast("bigint") * 10
    whole = F.shiftright(scaled, 20)
    rest = scaled - F.shiftleft(whole, 20)
    half = 1 << 19
    tenths = whole + ((rest > half) | ((rest == half) & (whole % 2 == 1))).cast("bigint")
    return F.format_string("%d.%dM", F.floor(tenths / 10), tenths % 10)
