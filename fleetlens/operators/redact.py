"""Masking the values of sensitive keys."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spread import spread_join

MASK = "********"

# Words that name how the next word is to be read, as in ``Authorization: Bearer <secret>``.
SCHEMES = ("Basic", "Bearer", "Digest", "Negotiate", "Token")


def sensitive_keys(*lists: str | None) -> list[str]:
    """Comma or colon lists of keys as one list, each key once; None is empty."""
    keys = (key.strip() for text in lists if text for key in re.split("[,:]", text))
    return list(dict.fromkeys(key for key in keys if key))


# What may stand for a key in a line, ahead of ``=`` or ``:``.
_CANDIDATE = r"""([0-9A-Za-z_][0-9A-Za-z_.\-]*)["']?[ \t]*[=:]"""


def _quoted(quote: str) -> str:
    """A quoted string with escapes; one that is never closed runs to the end of the line."""
    inside = rf"(?:[^{quote}\\\r\n]|\\[^\r\n])*+"
    return rf"{quote}{inside}(?:{quote}|[^\r\n]*)"


def _value() -> str:
    schemes = "|".join(SCHEMES)
    return rf"(?:{_quoted(chr(34))}|{_quoted(chr(39))}|(?i:{schemes})[ \t]+[^ \t\r\n]+|[^ \t\r\n]+)"


def redact(
    text: Column,
    keys: Iterable[str],
    include_sensitive: bool = False,
    case_sensitive: bool = True,
    whole_line: Iterable[str] = (),
) -> Column:
    """The text with the values of the keys masked.

    A value is what follows ``key =`` or ``key:`` on the line: a quoted string
    with its quotes and escapes, an unclosed quote up to the line's end, a scheme
    word such as Bearer with the word after it, or else everything up to the next
    white space. Keys in ``whole_line`` lose the rest of the line. The key may be
    quoted itself, as in JSON. It must stand alone, so ``token`` does not touch
    ``broken``. Text that names no key at all skips the pattern.
    """
    whole_line = set(whole_line)
    keys = list(dict.fromkeys([*keys, *sorted(whole_line)]))
    if include_sensitive or not keys:
        return text
    some = [key for key in keys if key not in whole_line]
    value = _value()
    flag = "" if case_sensitive else "(?i)"

    def pattern(names: Iterable[str], held: str) -> str:
        either = "|".join(re.sub(r"([^0-9A-Za-z_])", r"\\\1", key) for key in sorted(names, key=len, reverse=True))
        return rf"{flag}((?:^|[^0-9A-Za-z_])(?:{either})[\"']?[ \t]*[=:][ \t]*){held}"

    masked = text
    if some:
        masked = F.regexp_replace(masked, pattern(some, value), f"$1{MASK}")
    if whole_line:
        masked = F.regexp_replace(masked, pattern(whole_line, r"[^\r\n]+"), f"$1{MASK}")
    searched = text if case_sensitive else F.lower(text)
    names = keys if case_sensitive else [key.lower() for key in keys]
    held = reduce(lambda left, right: left | right, (searched.contains(name) for name in names))
    return F.when(held, masked).otherwise(text)


def redact_rows(
    rows: DataFrame,
    keys: Iterable[str],
    column: str = "line",
    include_sensitive: bool = False,
    case_sensitive: bool = True,
    whole_line: Iterable[str] = (),
) -> DataFrame:
    """Rows with one text column masked; row-wise, so it also runs on streams."""
    return rows.withColumn(
        column, redact(F.col(column), keys, include_sensitive, case_sensitive, whole_line)
    )


def _candidates(text: Column) -> Column:
    """Every text of the line that could be a key; of ``a.b-c`` also ``b-c`` and ``c``."""

    def ends(run: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.length(run)),
            lambda i: (i == 1) | (run.substr(i - 1, F.lit(1)).isin(".", "-") & run.substr(i, F.lit(1)).rlike(r"\w")),
        )
        return F.transform(starts, lambda i: run.substr(i, F.length(run)))

    return F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(text, F.lit(_CANDIDATE), 1), ends)))


def redact_by_node(
    rows: DataFrame, keys: DataFrame, node: str, ids: Iterable[str], column: str = "line"
) -> DataFrame:
    """Rows with the values of their own node's keys masked, as ``redact`` does for one list of keys.

    ``keys`` is a table of (node, key) of any size; keys are of letters, digits, ``_``, ``.`` and ``-`` and begin
    with none of the last two. ``ids`` tell rows of a node apart. What could be a key in a line meets its node's keys
    in a join, which splits a hot node; the few keys that a line holds then make the pattern that rewrites it, in
    one pass from left to right. Rows without any are not touched. A null text stays null.
    """
    ids = [node, *(name for name in ids if name != node)]
    text = F.col(column)
    held = rows.filter(text.contains("=") | text.contains(":")).select(*ids, F.explode(_candidates(text)).alias("_key"))
    wanted = keys.select(node, F.col("key").alias("_key")).dropna().distinct()
    found = (
        spread_join(held, wanted, [node, "_key"], "left_semi").groupBy(*ids).agg(F.collect_set("_key").alias("_keys"))
    )
    # The longest first, as one may begin another.
    names = F.transform(
        F.array_sort(F.transform("_keys", lambda key: F.struct((-F.length(key)).alias("n"), key.alias("key")))),
        lambda x: F.regexp_replace(x["key"], r"([^0-9A-Za-z_])", r"\\$1"),
    )
    pattern = F.concat(
        F.lit("((?:^|[^0-9A-Za-z_])(?:"), F.array_join(names, "|"), F.lit(rf")[\"']?[ \t]*[=:][ \t]*){_value()}")
    )
    masked = F.when(F.col("_keys").isNotNull(), F.regexp_replace(text, pattern, F.lit(f"$1{MASK}"))).otherwise(text)
    return spread_join(rows, found, ids, "left").select(
        *[masked.alias(name) if name == column else F.col(name) for name in rows.columns]
    )
