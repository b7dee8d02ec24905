"""Ordered text in chunks and running totals, against plain Python."""

import itertools
import re

from pyspark.sql import functions as F

from fleetlens.operators.joined import ordered_text, running_total
from helpers import plan_of


def whole(chunks, separator):
    """{group: text} put together again, with each chunk where its first_char says."""
    texts = {}
    for group, found in itertools.groupby(sorted(chunks, key=lambda r: (str(r[0]), r["part"])), lambda r: r[0]):
        text = ""
        for row in found:
            text += separator if text else ""
            assert len(text) == row["first_char"]
            text += row["text"]
        texts[group] = text
    return texts


def test_running_total_over_a_hot_value(spark):
    table = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("name"), (F.col("id") % 7).alias("n")
    )
    got = running_total(table, ["name"], F.col("n"), "before").collect()
    total = 0
    for row in sorted(got, key=lambda r: (r["name"], r["before"], r["n"])):
        assert row["before"] == total
        total += row["n"]
    assert len(got) == 1000


def test_text_equals_the_whole(spark, rows):
    names = [(f"c{i % 2}" if i % 5 else None, "x" * (i % 11) + f"{i % 90:02d}") for i in range(600)]
    got = ordered_text(rows("cluster string, name string", *names), "name", ["cluster"], chunk=50).collect()
    expected = {}
    for cluster, name in sorted(names, key=lambda pair: pair[1]):
        expected.setdefault(cluster, []).append(name)
    assert whole(got, ", ") == {cluster: ", ".join(found) for cluster, found in expected.items()}
    assert sum(row["n_values"] for row in got) == 600
    assert all(len(row["text"]) <= 50 + 13 for row in got)


def test_order_by_another_column(rows):
    table = rows("g int, at int, name string", (1, 3, "a"), (1, 1, "c"), (1, 2, "b"), (2, 1, "z"))
    got = ordered_text(table, "name", ["g"], ["at"], separator="")
    assert {(r["g"], r["text"], r["n_values"]) for r in got.collect()} == {(1, "cba", 3), (2, "z", 1)}


def test_odd_values(rows):
    table = rows("g string, name string", ("a", None), ("a", ""), ("a", ""), ("a", "y" * 100), ("NULL", "n"), ("null", "n"), (None, "m"))
    got = ordered_text(table, "name", ["g"], separator="", chunk=10).collect()
    assert {r["g"]: r["text"] for r in got} == {"a": "y" * 100, "NULL": "n", "null": "n", None: "m"}
    assert ordered_text(table.filter("false"), "name", ["g"]).count() == 0


def test_group_spans_tasks(spark):
    """The only sort of rows is by ranges, and windows run inside a range or over one row per range."""
    table = spark.range(10_000).select(F.lit("hot").alias("g"), F.format_string("n%05d", "id").alias("name"))
    chunks = ordered_text(table, "name", ["g"], chunk=800)
    assert all("_range" in spec for spec in re.findall(r"Window \[[^\n]*", plan_of(chunks)))
    got = chunks.collect()
    assert len(got) == 100 and {r["n_values"] for r in got} == {100}
