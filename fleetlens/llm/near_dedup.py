"""MinHash near-dedup: minima, banding, signature check, full-set check, connected components.

Texts with one and the same shingle set are one class from the start, so copies cost nothing more.
Classes that share a band are a bucket. Each class is first compared with the least class of one of its
buckets: a star, never all pairs. The links found give components. Where a bucket still holds several
components, strays become centres by rounds (``resolve``), so no pair of a bucket that could join two
components goes unseen.

The signature check leaves out pairs whose equal minima are DEVIATIONS standard deviations too few.
Every link is confirmed on the full sets. Rows per band follow from the threshold: of pairs exactly at
the threshold, less than one in a million shares no band (``banding``).

Defined results: a null or empty text, or one without words, has the empty set and is linked with
nothing; fewer words than a shingle are one shingle as a whole; rows that share an identifier are
one node, which joins what each of their texts is linked with; a row without identifier has component
null and is kept; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import drop_folder, few, kept, shared_folder, ship, stored, trimmed
from fleetlens.llm.components import components
from fleetlens.llm.resolve import contract, odd_sketch
from fleetlens.llm.text_hash import Minima, band_keys, shingle_hashes, steps, text_buffers, word_hashes

#: Identifiers that may be broadcast to pick texts (8 bytes each); beyond, the join shuffles.
BROADCAST_IDS = 1_000_000
#: The signature check leaves out pairs whose estimate is so many standard deviations too low.
DEVIATIONS = 6


def banding(threshold: float, miss: float = 1e-6, most: int = 200) -> tuple[int, int]:
    """(bands, rows): the longest rows whose bands, at most ``most`` minima in all, miss at most ``miss``."""
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))
        if rows * bands <= most:
            return bands, rows
    raise ValueError("no banding within so few minima")


def text_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = text_buffers(column)
    for first, last in steps(offsets):
        base = offsets[first]
        words, starts = word_hashes(data[base : offsets[last]], offsets[first : last + 1] - base)
        shingles, begins = shingle_hashes(words, starts, size)
        for i in range(last - first):
            yield np.unique(shingles[begins[i] : begins[i + 1]])


def sketches(docs: DataFrame, size: int, bands: int, rows: int, hashes: int | None = None) -> DataFrame:
    """Per document: number of shingles, digest of the set, minima, band keys.

    The bands take the first ``bands * rows`` of ``hashes`` minima, by default all there are.
    """
    hashes = hashes or bands * rows

    def sketch(batches):
        minima = kept(("minima", hashes), lambda: Minima(hashes))
        for batch in batches:
            counts, digests, signatures, keys, odds = [], [], [], [], []
            for shingles in text_sets(batch.column(1), size):
                counts.append(len(shingles))
                if not len(shingles):
                    for empty in (digests, signatures, keys, odds):
                        empty.append(None)
                    continue
                low = minima.of(shingles)
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                signatures.append(low.tobytes())
                keys.append(band_keys(low[: bands * rows], bands))
                odds.append(odd_sketch(shingles))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(odds, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_digest", "signature", "bands", "odd"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        trimmed(sketch),
        "doc_id long, n_shingles long, set_digest binary, signature binary, bands array<long>, "
        "odd array<long>",
    )


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, set) of the documents in ``wanted`` (node)."""

    def cut(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([shingles.tobytes() for shingles in text_sets(batch.column(1), size)], pa.binary()),
                ],
                names=["node", "shingles"],
            )

    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(wanted, "node", "left_semi")
    return texts.mapInArrow(trimmed(cut), "node long, shingles binary")


def _agree(pairs: DataFrame, signatures: DataFrame, minima: int, threshold: float) -> DataFrame:
    """The pairs whose signatures do not rule the threshold out."""
    least = threshold - DEVIATIONS * math.sqrt(threshold * (1 - threshold) / minima)

    def check(batches):
        for batch in batches:
            a, b = (_fixed(batch.column(i), minima) for i in (2, 3))
            same = (a == b).mean(axis=1) >= least if len(a) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(same)), batch.column(1).filter(pa.array(same))], names=["a", "b"]
            )

    left = signatures.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    right = signatures.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(trimmed(check), "a long, b long")


def _fixed(column: pa.Array, minima: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, minima)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold: 100 * intersection >= percent * union."""

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["u", "v"]
            )

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("pa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("pb"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", "pa", "pb")
        .mapInArrow(trimmed(check), "u long, v long")
        .distinct()
    )


def linked(
    docs: DataFrame, first: DataFrame, buckets: DataFrame, size: int, percent: int, minima: int, folder: str
) -> tuple[DataFrame, DataFrame]:
    """(links, the components they give): see ``resolve``.

    ``first`` has each class's node, n_shingles, signature, bands and odd; ``buckets`` is (band, center, node).
    """
    have: list[DataFrame] = []

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        near = stored(_agree(pairs, first, minima, percent / 100), f"{folder}/{name}-near")
        wanted = near.select(F.col("a").alias("node")).unionAll(near.select(F.col("b").alias("node"))).distinct()
        for sets in have:
            wanted = wanted.join(sets.select("node"), "node", "left_anti")
        n = near.count()
        wanted = stored(few(wanted, 2 * n), f"{folder}/{name}-wanted")
        if not wanted.isEmpty():
            have.append(stored(_sets(docs, wanted, size), f"{folder}/{name}-sets"))
        confirmed = _confirm(near, reduce(DataFrame.unionAll, have), percent) if have else near.toDF("u", "v")
        found = stored(few(confirmed, n), f"{folder}/{name}-links")
        for part in ("near", "wanted"):
            drop_folder(docs.sparkSession, f"{folder}/{name}-{part}")
        return found

    # Of a node's buckets the one with the least centre: one pair a node.
    stars = (
        buckets.groupBy("node").agg(F.min("center").alias("a")).filter("a <> node").select("a", F.col("node").alias("b"))
    )
    sized = first.select("node", "n_shingles", "odd", "bands")
    links, found = contract(stars, buckets, sized, verify, percent, folder)
    return reduce(DataFrame.unionAll, links), found


def _one_node(sketched: DataFrame, classes: DataFrame, folder: str) -> DataFrame:
    """Links (u, v) between the classes of rows that share an identifier but not their text."""
    held = sketched.filter("set_digest is not null and doc_id is not null").select("doc_id", "set_digest")
    again = held.groupBy("doc_id").agg(F.min("set_digest").alias("x"), F.max("set_digest").alias("y")).filter("x <> y")
    several = stored(
        held.join(again.select("doc_id"), "doc_id").join(classes, "set_digest").select("doc_id", "node").distinct(),
        f"{folder}/several",
    )
    least = stored(several.groupBy("doc_id").agg(F.min("node").alias("u")), f"{folder}/several-least")
    return several.join(least, "doc_id").select("u", F.col("node").alias("v")).filter("u <> v").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, folder: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (it is its component's least doc_id)."""
    spark = docs.sparkSession
    ship(spark)
    folder = folder or shared_folder(spark, "near")
    bands, rows = banding(percent / 100)
    sketched = stored(sketches(docs, size, bands, rows), f"{folder}/sketches")
    classes = stored(
        sketched.filter("set_digest is not null and doc_id is not null")
        .groupBy("set_digest")
        .agg(F.min("doc_id").alias("node")),
        f"{folder}/classes",
    )
    first = stored(
        sketched.join(classes, "set_digest")
        .filter("doc_id = node")
        .select("set_digest", "node", "n_shingles", "signature", "bands", "odd")
        .dropDuplicates(["set_digest"]),
        f"{folder}/first",
    )
    keyed = stored(first.select(F.explode("bands").alias("band"), "node"), f"{folder}/bands")
    centers = stored(
        keyed.groupBy("band").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("n")).filter("n > 1"),
        f"{folder}/centers",
    )
    buckets = stored(keyed.join(centers, "band").select("band", "center", "node"), f"{folder}/buckets")

    _, found = linked(docs, first, buckets, size, percent, bands * rows, folder)
    same = stored(_one_node(sketched, classes, folder), f"{folder}/same")
    if not same.isEmpty():
        edges = found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionAll(same)
        found = stored(components(edges, f"{folder}/joined"), f"{folder}/joined-all")
    named = classes.join(found, "node", "left").select(
        "set_digest", F.coalesce("component", "node").alias("component_id")
    )
    named = stored(named, f"{folder}/named")
    # Rows with one doc_id are one node: all of them go by the least component any of them has.
    return (
        sketched.select("doc_id", "n_shingles", "set_digest")
        .join(named, "set_digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
