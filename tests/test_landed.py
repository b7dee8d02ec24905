"""Files listed by the tasks, and read by ranges."""

import hashlib

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import bundle
from fleetlens.sources import listing
from fleetlens.sources.listing import (
    FAN_IN, TREE_LEVELS, can_list, file_ranges, file_uri, list_files, tree_manifest, whole_sums,
)
from fleetlens.sources.reports import read_collected, read_manifest, read_tree_manifest
from fleetlens.sources.settings import empty_files, read_files

FILES = {
    "main.conf": b"m",
    "main.conf.d/1.conf": b"p\nq\n",
    "main.conf.d/no.conf": b"",
    "main.conf.d/note.txt": b"t",
    "b 1/x y.log": b"1\n2",
    "b 1/\u00e9%+#.txt": b"",
    "b 1/deep/er/long": bytes(range(256)) * 40,
    "b 1/_hidden": b"h",
    "b 1/.dot": b"d",
    "b[2]/one,two": b"o",
}


@pytest.fixture
def landed(tmp_path):
    for name, data in FILES.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    return tmp_path


def below(files, folder):
    return sorted(row.path[len(str(folder)) + 1 :] for row in files.collect())


@pytest.mark.parametrize(
    "pattern, recursive, want",
    [
        ("", True, sorted(name for name in FILES if "hidden" not in name and "dot" not in name)),
        ("", False, ["main.conf"]),
        ("main.conf", False, ["main.conf"]),
        ("main.conf{,.d/*.conf}", False, ["main.conf", "main.conf.d/1.conf", "main.conf.d/no.conf"]),
        ("main.conf.d/{[0-9],n[^p-z]}*", False, ["main.conf.d/1.conf", "main.conf.d/no.conf", "main.conf.d/note.txt"]),
        ("*/d??p/*/l*", False, ["b 1/deep/er/long"]),
        ("b\\[2\\]/*", False, ["b[2]/one,two"]),
        ("none/*", False, []),
        ("none", True, []),
    ],
)
def test_paths_and_wildcards(spark, landed, pattern, recursive, want):
    path = f"{landed}/{pattern}"
    assert below(list_files(spark, path, recursive=recursive), landed) == want
    assert below(list_files(spark, f"file://{path}", path, recursive=recursive), landed) == want


@pytest.mark.parametrize("pattern", ["b 1", "main.conf{,.d/*.conf}", "main.conf.d", "*"])
def test_names_are_those_of_the_file_source(spark, landed, pattern):
    path = f"{landed}/{pattern}"
    strip = "^file:/+"
    ours = list_files(spark, path).select(F.regexp_replace(file_uri(), strip, "/").alias("f"))
    theirs = spark.read.format("binaryFile").load(path).inputFiles()
    assert sorted(row.f for row in ours.collect()) == sorted("/" + name.split(":", 1)[1].lstrip("/") for name in theirs)


def test_empty_files_without_a_list_in_the_driver(spark, landed):
    found = empty_files(spark, str(landed), recursiveFileLookup="true")
    assert sorted(row.file.rsplit("/", 1)[-1] for row in found.collect()) == ["no.conf", "\u00e9%25+%23.txt"]
    texts = read_files(spark, f"{landed}/main.conf.d")
    assert sorted(row.text for row in texts.collect()) == ["", "p\nq\n", "t"]


def test_what_arrow_does_not_know_is_left_to_spark(spark, landed, monkeypatch):
    assert can_list(spark, str(landed), f"file:{landed}") and not can_list(spark, "odd://x/y")
    assert not can_list(spark, "relative/path")
    monkeypatch.setattr("fleetlens.sources.settings.can_list", lambda *_: False)
    assert empty_files(spark, f"{landed}/main.conf.d").count() == 1


def test_ranges(spark):
    files = spark.createDataFrame([("r", "a", 0), ("r", "b", 10), ("r", "c", 11)], "root string, path string, length long")
    got = sorted((row.path, row.part, row.start, row.bytes) for row in file_ranges(files, 5).collect())
    assert got == [("a", 0, 0, 0), ("b", 0, 0, 5), ("b", 1, 5, 5), ("c", 0, 0, 5), ("c", 1, 5, 5), ("c", 2, 10, 1)]


def tree(data, size, fan_in):
    nodes = [hashlib.sha256(data[at : at + size]).digest() for at in range(0, max(len(data), 1), size)]
    for _ in range(TREE_LEVELS):
        nodes = [hashlib.sha256(b"".join(nodes[at : at + fan_in])).digest() for at in range(0, len(nodes), fan_in)]
    (root,) = nodes
    return root.hex()


def test_sums_of_files_read_by_many_tasks(spark, landed):
    seen = [name for name in FILES if "hidden" not in name and "dot" not in name]
    files = list_files(spark, str(landed), recursive=True)
    got = {row.path[len(str(landed)) + 1 :]: row for row in tree_manifest(files, 7).collect()}
    assert sorted(got) == sorted(seen)
    for name in seen:
        want = (len(FILES[name]), FILES[name].count(b"\n"), tree(FILES[name], 7, FAN_IN))
        assert (got[name].length, got[name].feeds, got[name].tree) == want
    whole = {row.path[len(str(landed)) + 1 :]: row.sha256 for row in whole_sums(files).collect()}
    assert whole == {name: hashlib.sha256(FILES[name]).hexdigest() for name in seen}
    # 10,240 bytes in ranges of seven: two digests meet above the first level, in order.
    assert len(FILES["b 1/deep/er/long"]) > 7 * FAN_IN


def test_a_file_is_read_by_more_than_one_task(spark, landed):
    files = list_files(spark, f"{landed}/b 1/deep/er/long")
    ranges = file_ranges(files, 512)
    sums = listing._range_sums(ranges, listing._tasks(ranges.count(), listing._TASK_RANGES))
    assert sums.select(F.spark_partition_id().alias("task")).distinct().count() > 5


def test_a_file_that_shrinks_is_an_error(spark, landed):
    files = list_files(spark, str(landed / "main.conf")).selectExpr("root", "path", "length + 1 length")
    with pytest.raises(Exception, match="shorter"):
        whole_sums(files).collect()


def test_manifest_equals_that_of_whole_files(spark, landed):
    path = str(landed)
    whole = bundle.file_manifest(read_collected(spark, path)).collect()
    ranged = read_manifest(spark, path)
    assert sorted(ranged.collect()) == sorted(whole)
    assert {row.bundle for row in bundle.bundle_messages(ranged, "/out").collect()} == {row.bundle for row in whole}
    trees = read_tree_manifest(spark, path, 100)
    assert trees.columns == ["bundle", "name", "length", "feeds", "tree"]
    assert trees.selectExpr("sum(length)").first()[0] == sum(row.length for row in whole)


def test_nothing_landed(spark, tmp_path):
    assert read_manifest(spark, str(tmp_path)).count() == 0
    assert read_tree_manifest(spark, str(tmp_path)).count() == 0
