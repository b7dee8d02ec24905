"""Landed files listed by the tasks, and read by ranges of bytes.

Folders are listed level by level: each is one row, so folders of one level are listed side by side and no list of files
goes through the driver. A file of any size is cut into ranges that many tasks read, a megabyte at a time.
"""

from __future__ import annotations

import fnmatch
import hashlib
import re
import sys
from collections.abc import Iterator
from functools import reduce
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import use_checkpoint_dir

#: Bytes of a range.
RANGE = 64 << 20
#: Digests that are put together into one, and how often: enough for 2^30 ranges a file.
FAN_IN = 1024
TREE_LEVELS = 3
_READ = 1 << 20
_TASK_RANGES = 16  # ranges a task takes on average, once there are many
_TASK_FOLDERS = 100
_LEAST_TASKS = 32
_WILD = re.compile(r"[*?\[\\]")
# Executors need not have this package: its functions travel with the jobs.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
_FOUND = "root string, path string, length bigint, rest array<string>"


def _braces(path: str) -> list[str]:
    """The paths that ``{a,b}`` stands for; braces may be nested, a backslash takes the next character as it is."""
    depth, start, cuts, at = 0, 0, [], 0
    while at < len(path):
        char = path[at]
        if char == "\\":
            at += 1
        elif char == "{":
            if depth == 0:
                start, cuts = at, [at]
            depth += 1
        elif char == "," and depth == 1:
            cuts.append(at)
        elif char == "}" and depth:
            depth -= 1
            if depth == 0:
                choices = [path[low + 1 : high] for low, high in zip(cuts, [*cuts[1:], at])]
                return [found for choice in choices for found in _braces(path[:start] + choice + path[at + 1 :])]
        at += 1
    return [path]


def _matches(name: str, pattern: str) -> bool:
    plain = re.sub(r"\\(.)", r"[\1]", pattern).replace("[^", "[!")
    return fnmatch.fnmatchcase(name, plain)


def _hidden(name: str) -> bool:
    """What Spark's file sources pass over as well."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _starts(spark: SparkSession, path: str) -> list[tuple[str, str, int, list[str]]]:
    """(root, folder, -, components below it) of a path: the folder is what comes before the first wildcard."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    found = re.match(r"\A([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)\Z", path, re.DOTALL)
    if found:
        root, below = f"{found[1]}://{found[2] or ''}", found[3]
    else:
        base = re.match(r"\A([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?", default)
        root, below = f"{base[1]}://{base[2] or ''}", path
    if not below.startswith("/"):  # a relative path: only Spark knows where it begins
        raise ValueError(f"not an absolute path: {path}")
    starts = []
    for one in _braces(below):
        parts = [part for part in one.split("/") if part]
        wild = next((at for at, part in enumerate(parts) if _WILD.search(part)), len(parts))
        starts.append((root, "/" + "/".join(parts[:wild]), -1, parts[wild:]))
    return starts


def can_list(spark: SparkSession, *paths: str) -> bool:
    """Whether ``pyarrow.fs`` knows the file systems of all paths; Hadoop knows some that it does not."""
    try:
        for path in paths:
            for root, *_ in _starts(spark, path):
                fs.FileSystem.from_uri(root + "/")
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def _open(root: str, stores: dict[str, tuple[fs.FileSystem, str]]) -> tuple[fs.FileSystem, str]:
    if root not in stores:
        store, base = fs.FileSystem.from_uri(root + "/")
        stores[root] = store, base.rstrip("/")
    return stores[root]


def _tasks(rows: int, each: int) -> int:
    return max(min(rows, _LEAST_TASKS), rows // each, 1)


def _children(recursive: bool, first: bool):
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores: dict[str, Any] = {}
        for batch in batches:
            for row in batch.to_pylist():
                rows = list(_below(row, stores, recursive, first))
                for at in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_pylist(rows[at : at + 10_000], _ARROW)

    return listed


_ARROW = pa.schema(
    [("root", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("rest", pa.list_(pa.string()))]
)


def _below(row: dict, stores: dict[str, Any], recursive: bool, first: bool) -> Iterator[dict]:
    """What one path leads to: files with their length, folders with -1."""
    store, base = _open(row["root"], stores)
    rest = row["rest"]
    if first and not rest:
        info = store.get_file_info(base + row["path"])
        if info.type == fs.FileType.File:
            yield {**row, "length": info.size}
            return
    for info in store.get_file_info(fs.FileSelector(base + row["path"], allow_not_found=True)):
        is_file = info.type == fs.FileType.File
        name = info.base_name
        if _hidden(name) or (rest and not _matches(name, rest[0])):
            continue
        after = rest[1:] if rest else []
        # Below the pattern come a folder's own files, and those of its folders only where that is asked for.
        wanted = not after if is_file else bool(rest) or recursive
        if wanted:
            path = row["path"].rstrip("/") + "/" + name
            yield {"root": row["root"], "path": path, "length": info.size if is_file else -1, "rest": after}


def list_files(spark: SparkSession, *paths: str, recursive: bool = False) -> DataFrame:
    """(root, path, length) of the files that the paths and wildcards lead to, each once, also the empty ones.

    ``root`` is scheme and authority, ``path`` the plain name below it. A path may be a file or a folder; of a folder
    its own files count, with ``recursive`` those of all folders below too. Paths that do not exist and names that begin
    with ``_`` or ``.`` give none, as in Spark's file sources. Each level of folders is one job, checkpointed.
    """
    use_checkpoint_dir(spark)
    level = spark.createDataFrame([start for path in paths for start in _starts(spark, path)], _FOUND)
    found, folders = [], level.count()
    while folders:
        spread = level.repartition(_tasks(folders, _TASK_FOLDERS), "root", "path")
        seen = spread.mapInArrow(_children(recursive, first=not found), _FOUND).checkpoint()
        found.append(seen.filter("length >= 0"))
        level = seen.filter("length < 0")
        folders = level.count()
    return reduce(DataFrame.unionByName, found).select("root", "path", "length").distinct()


def file_uri(root: str = "root", path: str = "path"):
    """The name under which Spark's sources give a file: what a URI cannot hold is escaped."""
    escaped = F.replace(path, F.lit("%"), F.lit("%25"))
    for char in ' "<>\\^`{|}#?[]':
        escaped = F.replace(escaped, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return F.concat(root, escaped)


def file_ranges(files: DataFrame, size: int = RANGE) -> DataFrame:
    """(root, path, length, part, start, bytes): the files cut into ranges; an empty file is one of no bytes."""
    last = F.greatest(F.ceil(F.col("length") / size) - 1, F.lit(0)).cast("bigint")
    return files.select(
        "root", "path", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("part")
    ).select(
        "*",
        (F.col("part") * size).alias("start"),
        F.least(F.lit(size), F.col("length") - F.col("part") * size).cast("bigint").alias("bytes"),
    )


def _read_range(row: dict, stores: dict[str, Any]) -> tuple[bytes, int]:
    """SHA-256 and line feeds of a range, in constant memory."""
    store, base = _open(row["root"], stores)
    digest, feeds, left = hashlib.sha256(), 0, row["bytes"]
    with store.open_input_file(base + row["path"]) as file:
        file.seek(row["start"])
        while left:
            piece = file.read(min(left, _READ))
            if not piece:
                raise OSError(f"{row['path']} is shorter than it was when it was listed")
            digest.update(piece)
            feeds += piece.count(b"\n")
            left -= len(piece)
    return digest.digest(), feeds


_SUMS = pa.schema([
    ("root", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("part", pa.int64()),
    ("digest", pa.binary()), ("feeds", pa.int64()),
])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stores: dict[str, Any] = {}
    for batch in batches:
        for row in batch.to_pylist():
            digest, feeds = _read_range(row, stores)
            kept = {name: row[name] for name in ("root", "path", "length", "part")}
            yield pa.RecordBatch.from_pylist([{**kept, "digest": digest, "feeds": feeds}], _SUMS)


def _range_sums(ranges: DataFrame, tasks: int) -> DataFrame:
    spread = ranges.repartition(tasks, F.xxhash64("root", "path", "part"))
    return spread.mapInArrow(_sums, "root string, path string, length bigint, part bigint, digest binary, feeds bigint")


def tree_manifest(files: DataFrame, size: int = RANGE) -> DataFrame:
    """(root, path, length, feeds, tree): line feeds and a checksum of files of any size, read by ranges.

    The SHA-256 of each range are put together in order, :data:`FAN_IN` at a time, and hashed again,
    :data:`TREE_LEVELS` times whatever the length is; so the checksum depends on content and ``size`` alone.
    A lost executor costs the ranges it was reading.
    """
    ranges = file_ranges(files, size)
    nodes = _range_sums(ranges, _tasks(ranges.count(), _TASK_RANGES))
    for _ in range(TREE_LEVELS):
        numbered = nodes.withColumnRenamed("part", "_at")
        above = numbered.withColumn("part", F.floor(F.col("_at") / FAN_IN).cast("bigint"))
        digests = F.transform(F.array_sort(F.collect_list(F.struct("_at", "digest"))), lambda held: F.hex(held["digest"]))
        nodes = above.groupBy("root", "path", "length", "part").agg(
            F.unhex(F.sha2(F.unhex(F.array_join(digests, "")), 256)).alias("digest"), F.sum("feeds").alias("feeds")
        )
    return nodes.select("root", "path", "length", "feeds", F.lower(F.hex("digest")).alias("tree"))


def whole_sums(files: DataFrame) -> DataFrame:
    """(root, path, length, sha256): the usual checksum of each file, read from end to end in constant memory.

    That sum has no parts, so a file is one task's; ``tree_manifest`` is the way that many tasks share.
    """
    whole = files.select(
        "root", "path", "length", F.lit(0).cast("bigint").alias("part"), F.lit(0).cast("bigint").alias("start"),
        F.col("length").alias("bytes"),
    )
    sums = _range_sums(whole, _tasks(files.count(), _TASK_RANGES))
    return sums.select("root", "path", "length", F.lower(F.hex("digest")).alias("sha256"))
