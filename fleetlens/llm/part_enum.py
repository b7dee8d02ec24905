"""N-gram Jaccard join by PartEnum signatures: exact, no pair at the threshold or above is missed.

**Sizes.** Set sizes are cut into bands in which the largest size is the least one divided by the threshold, so two
sets that reach the threshold are of one band or of neighbouring ones. A set takes part in its own band and in the
next one, so such sets meet in a band. There they differ in at most ``k`` shingles, which follows from the largest
size of the band.

**Signatures.** The range of shingle hashes is cut into ``n1`` parts of equal width, so that sets which differ in at
most k places differ in at most SPARE places in one of the parts. That part is cut into PARTS smaller ones;
leaving out SPARE of them, in every possible way, leaves once what both sets have in common. A signature is a
hash of the band, the part, the smaller ones left out, and the shingles that lie in the rest. So similar sets share
a signature.

**Join.** Texts with one and the same set are one class. A task first combines its own classes by signature: of
those with one signature only the least meets those of other tasks, the others are tied to it, so a signature that a third of all
texts share meets as one row a task. Sets that share a signature are a bucket. Each class is compared with the least
of one of its buckets, and what is still apart in a bucket becomes a centre by rounds (``resolve``). Pairs that an exact bound
on sketches does not rule out are confirmed on full sets.

Defined results: a null or empty text, or one without words, has the empty set and is linked with nothing; fewer
words than a shingle are one shingle as a whole; rows that share an identifier are one node, which joins what each
of their texts is linked with; a row without identifier has component null; other columns are not read. Shingles and
classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import few, kept, shared_folder, ship, stored, trimmed
from fleetlens.llm.components import components
from fleetlens.llm.near_dedup import BROADCAST_IDS, text_sets
from fleetlens.llm.resolve import contract, odd_sketch, within_reach
from fleetlens.llm.text_hash import mix

#: Places in which sets may differ in the best part, and the smaller parts that it is cut into.
SPARE, PARTS = 1, 3
#: Signatures that a task combines at once.
COMBINED = 1 << 21

_RANGE = 1 << 64


def size_bands(percent: int, largest: int) -> list[int]:
    """The least size of each band, from 1 on, until one is beyond ``largest``."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(starts[-1] * 100 // percent + 1)
    return starts


def most_apart(size: int, percent: int) -> int:
    """In how many places sets of at most ``size`` shingles can differ and still reach the threshold."""
    return 2 * size * (100 - percent) // (100 + percent)


def first_parts(k: int, spare: int = SPARE) -> int:
    """The parts among which k differences leave one with at most ``spare``."""
    return -(-(k + 1) // (spare + 1))


class Signer:
    """Signatures of sets (sorted distinct hashes) for one threshold; the cuts of a band are made once."""

    def __init__(self, percent: int, spare: int = SPARE, parts: int = PARTS) -> None:
        self.percent, self.spare, self.parts = percent, spare, parts
        self.starts = size_bands(percent, 1000)
        self.left_out = np.array(list(combinations(range(parts), spare)), np.int64).reshape(-1, spare)
        self.cuts: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}

    def _band(self, band: int) -> tuple[int, np.ndarray, np.ndarray]:
        """(number of parts, the borders of all smaller parts, a salt for each signature) of a band."""
        if band not in self.cuts:
            n1 = first_parts(most_apart(self.starts[band + 1] - 1, self.percent), self.spare)
            cells = n1 * self.parts
            borders = np.array([-(-i * _RANGE // cells) for i in range(1, cells)], np.uint64)
            salts = mix(np.arange(n1 * len(self.left_out), dtype=np.uint64) + np.uint64((band + 1) << 32))
            self.cuts[band] = (n1, borders, salts)
        return self.cuts[band]

    def of(self, shingles: np.ndarray) -> np.ndarray:
        """All signatures of a set that is not empty."""
        n = len(shingles)
        if self.starts[-1] <= 2 * n:
            self.starts = size_bands(self.percent, 4 * n)
        own = bisect_right(self.starts, n) - 1
        sums = np.r_[np.uint64(0), np.cumsum(mix(shingles), dtype=np.uint64)]
        found = []
        for band in (own, own + 1):
            n1, borders, salts = self._band(band)
            at = np.r_[0, np.searchsorted(shingles, borders), n]
            cells = (sums[at[1:]] - sums[at[:-1]]).reshape(n1, self.parts)
            counts = np.diff(at).reshape(n1, self.parts)
            rest = cells.sum(axis=1, dtype=np.uint64)[:, None] - cells[:, self.left_out].sum(axis=2, dtype=np.uint64)
            left = counts.sum(axis=1)[:, None] - counts[:, self.left_out].sum(axis=2)
            found.append(mix(rest.ravel() + mix(salts + left.ravel().astype(np.uint64))))
        return np.concatenate(found).view(np.int64)


def _digest(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def classes_of(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_id (a hash of the set, null for the empty one) of each document."""

    def digest(batches):
        for batch in batches:
            counts, named = [], []
            for shingles in text_sets(batch.column(1), size):
                counts.append(len(shingles))
                named.append(_digest(shingles) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(named, pa.int64())],
                names=["doc_id", "n_shingles", "set_id"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return texts.mapInArrow(trimmed(digest), "doc_id long, n_shingles long, set_id long")


def _picked(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the documents in ``wanted`` (node)."""
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    return docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(wanted, "node", "left_semi")


def combined(signatures: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(signature, node, least node of the signature, whether it is the only one) of each distinct pair, in order."""
    order = np.lexsort((nodes, signatures))
    signatures, nodes = signatures[order], nodes[order]
    new = np.ones(len(order), bool)
    new[1:] = signatures[1:] != signatures[:-1]
    once = new.copy()
    once[1:] |= nodes[1:] != nodes[:-1]
    signatures, nodes, new = signatures[once], nodes[once], new[once]
    firsts = np.flatnonzero(new)
    held = np.diff(np.r_[firsts, len(nodes)])
    return signatures, nodes, np.repeat(nodes[firsts], held), np.repeat(held == 1, held)


def _signed(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(band, node, least): the signatures of each document, as ``band``.

    ``least`` is the least document of the task with that signature; null where there is no other.
    """

    def out(waiting):
        signatures = np.concatenate([s for s, _ in waiting])
        nodes = np.repeat(np.array([n for _, n in waiting], np.int64), [len(s) for s, _ in waiting])
        band, node, least, only = combined(signatures, nodes)
        for at in range(0, len(band), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(band[part]), pa.array(node[part]), pa.array(least[part], mask=only[part])],
                names=["band", "node", "least"],
            )

    def sign(batches):
        signer = kept(("signer", percent), lambda: Signer(percent))
        waiting, held = [], 0
        for batch in batches:
            for node, shingles in zip(batch.column(0).to_pylist(), text_sets(batch.column(1), size), strict=True):
                if len(shingles):
                    waiting.append((signer.of(shingles), node))
                    held += len(waiting[-1][0])
                    if held >= COMBINED:
                        yield from out(waiting)
                        waiting, held = [], 0
        if waiting:
            yield from out(waiting)

    return texts.mapInArrow(trimmed(sign), "band long, node long, least long")


def _sketched(texts: DataFrame, size: int) -> DataFrame:
    """(node, n_shingles, odd) of texts."""

    def sketch(batches):
        for batch in batches:
            sets = list(text_sets(batch.column(1), size))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(len, sets), pa.int64()),
                    pa.array(map(odd_sketch, sets), pa.list_(pa.int64())),
                ],
                names=["node", "n_shingles", "odd"],
            )

    return texts.mapInArrow(trimmed(sketch), "node long, n_shingles long, odd array<long>").filter("n_shingles > 0")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of texts."""

    def cut(batches):
        for batch in batches:
            sets = [s.tobytes() for s in text_sets(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return texts.mapInArrow(trimmed(cut), "node long, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
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
    return pairs.join(left, "a").join(right, "b").select("a", "b", "pa", "pb").mapInArrow(trimmed(check), "u long, v long").distinct()


def shingle_join(docs: DataFrame, size: int = 5, percent: int = 80, folder: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, node (the least document of the same set), n_links.

    ``n_links`` counts the confirmed links of the node to others: enough of them to join all that any chain of links
    joins.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or shared_folder(spark, "join")
    marked = stored(classes_of(docs, size), f"{folder}/marked")
    rows = marked.filter("set_id is not null and doc_id is not null").select("doc_id", "set_id")
    classes = stored(rows.groupBy("set_id").agg(F.min("doc_id").alias("node")), f"{folder}/classes")

    nodes = stored(classes.select("node").distinct(), f"{folder}/nodes")
    # One row a task and signature meets those of the other tasks; the rest are groups of their own.
    follows = F.col("least").isNotNull() & (F.col("least") != F.col("node"))
    signed = _signed(_picked(docs, nodes), size, percent).withColumn("apart", F.when(follows, F.col("node")))
    together = Window.partitionBy("band", "apart")
    met = stored(
        signed.select("*", F.min("node").over(together).alias("lead"), F.max("node").over(together).alias("last"))
        .filter("lead < last or least is not null")
        .select("band", "node", F.when(F.col("apart").isNull(), F.col("lead")).otherwise(F.col("least")).alias("center")),
        f"{folder}/met",
    )
    shared = stored(met.select("node").distinct(), f"{folder}/shared")
    sized = stored(_sketched(_picked(docs, shared), size), f"{folder}/sketched")
    have: list[DataFrame] = []

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        if name == "star":
            a = sized.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("odd").alias("odd_a"))
            b = sized.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("odd").alias("odd_b"))
            pairs = pairs.join(a, "a").join(b, "b").filter(within_reach(percent)).select("a", "b").distinct()
        near = stored(pairs, f"{folder}/{name}-near")
        wanted = near.select(F.col("a").alias("node")).unionAll(near.select(F.col("b").alias("node"))).distinct()
        for sets in have:
            wanted = wanted.join(sets.select("node"), "node", "left_anti")
        n = near.count()
        wanted = stored(few(wanted, 2 * n), f"{folder}/{name}-wanted")
        if not wanted.isEmpty():
            have.append(stored(_sets(_picked(docs, wanted), size), f"{folder}/{name}-sets"))
        if not have:
            return near.toDF("u", "v")
        return stored(few(_confirmed(near, reduce(DataFrame.unionAll, have), percent), n), f"{folder}/{name}-links")

    stars = met.groupBy("node").agg(F.min("center").alias("a")).filter("a <> node").select("a", F.col("node").alias("b"))
    tables, found = contract(stars, met, sized, verify, percent, folder)
    # Rows of one identifier with several texts are one node.
    again = rows.groupBy("doc_id").agg(F.min("set_id").alias("x"), F.max("set_id").alias("y")).filter("x <> y")
    several = stored(rows.join(again.select("doc_id"), "doc_id").join(classes, "set_id"), f"{folder}/several")
    least = several.groupBy("doc_id").agg(F.min("node").alias("u"))
    same = stored(several.join(least, "doc_id").filter("node <> u").select("u", F.col("node").alias("v")), f"{folder}/same")
    if not same.isEmpty():
        edges = found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionAll(same)
        found = stored(components(edges, f"{folder}/joined"), f"{folder}/joined-all")

    links = reduce(DataFrame.unionAll, tables)
    ends = links.select(F.col("u").alias("node")).unionAll(links.select(F.col("v").alias("node")))
    counted = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    named = stored(
        classes.join(found, "node", "left").join(counted, "node", "left").select(
            "set_id", "node", F.coalesce("component", "node").alias("component_id"), "n_links"
        ),
        f"{folder}/named",
    )
    return marked.join(named, "set_id", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        "node",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
