"""Shell wildcards as Spark predicates.

``*``, ``?``, ``[seq]`` and ``[!seq]`` match the whole string, case-sensitively,
newlines included. A ``[`` that is never closed and a lone ``]`` stand for
themselves.

A pattern given as an argument becomes ``LIKE`` whenever it holds no character
class, so Catalyst can turn it into StartsWith / EndsWith / Contains and push it
into the scan. Only patterns with a class need ``RLIKE``. Patterns that sit in a
table are translated by column expressions instead (:func:`regex_of`).
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WILDCARDS = "*[]?"

# One token of a glob: a closed class, or any single character.
_TOKEN = r"(?s)\[!?+\]?+[^\]]*\]|."
# One item inside a class: a range, or any single character.
_ITEM = r"(?s).-.|."
_ESCAPE = re.compile(r"([^0-9A-Za-z\u0080-\U0010ffff])")


def is_pattern(text: str) -> bool:
    """True when the text holds any of ``* [ ] ?``."""
    return any(char in text for char in WILDCARDS)


def sift(values: Iterable[str] | None) -> tuple[list[str], list[str]]:
    """Split option values into (patterns, literals), each distinct and sorted."""
    distinct = set(values or ())
    patterns = {value for value in distinct if is_pattern(value)}
    return sorted(patterns), sorted(distinct - patterns)


def sift_column(values: Column) -> Column:
    """The same split for an array column: ``struct(patterns, literals)``."""
    held = F.array_distinct(F.coalesce(values, F.array().cast("array<string>")))

    def wild(value: Column) -> Column:
        return value.rlike(r"[*\[\]?]")

    return F.struct(
        F.filter(held, wild).alias("patterns"),
        F.filter(held, lambda value: ~wild(value)).alias("literals"),
    )


def _tokens(pattern: str) -> list[str]:
    return re.findall(_TOKEN, pattern)


def _is_class(token: str) -> bool:
    return len(token) > 1


def _quote(text: str) -> str:
    return _ESCAPE.sub(r"\\\1", text)


def _class_regex(token: str) -> str:
    body = token[1:-1]
    negated = body.startswith("!")
    items = []
    for item in re.findall(_ITEM, body[1:] if negated else body):
        if len(item) == 1:
            items.append(_quote(item))
        elif item[0] <= item[2]:
            items.append(f"{_quote(item[0])}-{_quote(item[2])}")
    if not items:
        return "." if negated else "(?!)"
    return f"[{'^' if negated else ''}{''.join(items)}]"


def to_like(pattern: str) -> str | None:
    """The LIKE form of a glob, or None when a character class forbids it."""
    out = []
    for token in _tokens(pattern):
        if _is_class(token):
            return None
        if token == "*":
            out.append("%")
        elif token == "?":
            out.append("_")
        elif token in "%_\\":
            out.append("\\" + token)
        else:
            out.append(token)
    return "".join(out)


def to_regex(pattern: str) -> str:
    """The anchored regular expression of a glob (Java and RE2 syntax)."""
    out = []
    for token in _tokens(pattern):
        if _is_class(token):
            out.append(_class_regex(token))
        elif token == "*":
            out.append(".*")
        elif token == "?":
            out.append(".")
        else:
            out.append(_quote(token))
    return r"(?s)\A" + "".join(out) + r"\z"


def longest_literal(pattern: str) -> str:
    """The longest text every match of the glob must contain (may be empty)."""
    runs, run = [""], ""
    for token in _tokens(pattern):
        if _is_class(token) or token in "*?":
            run = ""
        else:
            run += token
            runs.append(run)
    return max(runs, key=len)


def glob(column: Column, pattern: str) -> Column:
    """Predicate: the column matches the glob."""
    if not is_pattern(pattern):
        return column == F.lit(pattern)
    like = to_like(pattern)
    if like is not None:
        return column.like(like)
    # The literal ends beside the expression: a scan can test these.
    tokens = _tokens(pattern)
    wild = [i for i, token in enumerate(tokens) if _is_class(token) or token in "*?"]
    start, end = "".join(tokens[: wild[0]]), "".join(tokens[wild[-1] + 1 :])
    found = column.rlike(to_regex(pattern))
    for literal, test in ((end, column.endswith), (start, column.startswith)):
        if literal:
            found = test(literal) & found
    return found


def any_glob(column: Column, patterns: Iterable[str]) -> Column:
    """Predicate: the column matches at least one glob."""
    return reduce(lambda left, right: left | right, (glob(column, p) for p in patterns))


def _quote_column(text: Column) -> Column:
    return F.regexp_replace(text, r"([^0-9A-Za-z\u0080-\x{10ffff}])", r"\\$1")


def _item_column(item: Column) -> Column:
    low, high = item.substr(1, 1), item.substr(3, 1)
    return (
        F.when(F.length(item) == 1, _quote_column(item))
        .when(low <= high, F.concat(_quote_column(low), F.lit("-"), _quote_column(high)))
        .otherwise("")
    )


def _class_column(token: Column) -> Column:
    negated = token.startswith("[!")
    body = F.regexp_replace(token, r"(?s)\A\[!?|\]\z", "")
    items = F.array_join(F.transform(F.regexp_extract_all(body, F.lit(f"({_ITEM})"), 0), _item_column), "")
    return F.when(items == "", F.when(negated, ".").otherwise("(?!)")).otherwise(
        F.concat(F.when(negated, "[^").otherwise("["), items, F.lit("]"))
    )


def regex_of(pattern: Column) -> Column:
    """The anchored regular expression of a glob held in a column."""

    def translate(token: Column) -> Column:
        return (
            F.when(F.length(token) > 1, _class_column(token))
            .when(token == "*", ".*")
            .when(token == "?", ".")
            .otherwise(_quote_column(token))
        )

    tokens = F.regexp_extract_all(pattern, F.lit(f"({_TOKEN})"), 0)
    return F.concat(F.lit(r"(?s)\A"), F.array_join(F.transform(tokens, translate), ""), F.lit(r"\z"))


# What stands for itself in no match of a glob: a closed class or a wildcard.
_WILD = r"(?s)\[!?+\]?+[^\]]*\]|[*?]"


def literal_runs(pattern: Column) -> Column:
    """The texts between the wildcards and classes of a glob, in order; empty ones as well."""
    return F.split(F.regexp_replace(pattern, _WILD, "\x00"), "\x00")


def has_literal(pattern: Column) -> Column:
    """True when every match of the glob must hold some text."""
    return F.regexp_replace(pattern, _WILD, "") != ""


def literal_prefix(pattern: Column) -> Column:
    """The text every match of the glob must start with (may be empty)."""
    return F.regexp_extract(pattern, r"(?s)\A[^*?\[]*", 0)


def literal_suffix(pattern: Column) -> Column:
    """The text every match of the glob must end with (may be empty)."""
    return F.regexp_extract(pattern, r"(?s)[^*?\]]*\z", 0)
