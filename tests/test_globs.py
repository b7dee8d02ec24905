import fnmatch
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import plan_of
from fleetlens.functions import globs

ALPHABET = "ab-z[]!*?^\\%_.&~|{}$\n"
SPECIAL = [
    "", "*", "?", "[", "]", "[]", "[!]", "[]]", "[!]]", "[a", "a]", "[!a]", "[a-c]", "[c-a]", "[!c-a]", "[a-]", "[-a]",
    "[a-c-e]", "[^a]", "[!^a]", "[[]", "[\\]", "[a&&b]", "[!*]", "a%b", "a_b", "a\\b", "*.11", "100%*", "[%_]", "[--a]",
]


@settings(max_examples=1500, deadline=None)
@given(st.text(ALPHABET, max_size=8), st.text(ALPHABET, max_size=6))
def test_regex_is_fnmatch(pattern, text):
    python = globs.to_regex(pattern).removesuffix(r"\z") + r"\Z"
    assert bool(re.match(python, text)) == fnmatch.fnmatchcase(text, pattern)


def _pairs():
    rng = random.Random(5)

    def some(size):
        return "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(size)))

    texts = ["", "a", "b", "z", "ab", "a\nb", "]", "[", "\\", "^", "-", "!", "a%b", "axb", "10.0.0.11"]
    pairs = [(pattern, text) for pattern in SPECIAL for text in texts]
    return pairs + [(some(8), some(6)) for _ in range(3000)]


def test_pattern_column_is_fnmatch(spark):
    pairs = _pairs()
    df = spark.createDataFrame(pairs, "pattern string, text string")
    got = df.select("pattern", "text", F.rlike("text", globs.regex_of(F.col("pattern"))).alias("hit")).collect()
    assert len(got) == len(pairs)
    wrong = [row for row in got if row.hit != fnmatch.fnmatchcase(row.text, row.pattern)]
    assert wrong == []


def test_argument_glob_is_fnmatch(spark):
    texts = ["", "a", "b", "z", "ab", "a\nb", "]", "[", "\\", "^", "-", "!", "a%b", "axb", "a_b", "10.0.0.11", "100%x"]
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    got = df.select("text", *[globs.glob(F.col("text"), p).alias(f"p{i}") for i, p in enumerate(SPECIAL)]).collect()
    for row in got:
        for i, pattern in enumerate(SPECIAL):
            assert row[f"p{i}"] == fnmatch.fnmatchcase(row.text, pattern), (row.text, pattern)


def test_plain_wildcards_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "hosts")
    spark.createDataFrame([("a1",), ("b2",)], "address string").write.parquet(path)
    hosts = spark.read.parquet(path)
    for pattern, pushed in (("a*", "StringStartsWith"), ("*1", "StringEndsWith"), ("*a*", "StringContains"), ("a1", "EqualTo")):
        assert pushed in plan_of(hosts.filter(globs.glob(F.col("address"), pattern)))


def test_sift(spark):
    assert globs.sift(["a*", "b", "b", "c]", "d?", "[e"]) == (["[e", "a*", "c]", "d?"], ["b"])
    assert globs.sift(None) == ([], [])
    df = spark.createDataFrame([(["a*", "b", "b", "c]"],), (None,)], "v array<string>")
    got = [row.s for row in df.select(globs.sift_column(F.col("v")).alias("s")).collect()]
    assert [(row.patterns, row.literals) for row in got] == [(["a*", "c]"], ["b"]), ([], [])]


@settings(max_examples=500, deadline=None)
@given(st.text("ab[]!*?-", max_size=8), st.text("ab[]!-", max_size=6))
def test_longest_literal_is_in_every_match(pattern, text):
    if fnmatch.fnmatchcase(text, pattern):
        assert globs.longest_literal(pattern) in text
