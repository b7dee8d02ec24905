"""Links between the members of buckets until no pair of a bucket that could join two components is unseen.

A bucket holds nodes that share a band or a signature, of any number. Its pairs are never all made:

1. Each node is compared with one centre (a star, chosen by the caller). The links found give components.
2. A bucket that still holds several components has *strays*, the nodes outside its largest component. Some of
   the strays, chosen by a hash, become centres and are compared with the bucket's nodes of other components. The
   links found join components, which usually takes in most of the strays. A centre is done in that bucket.
3. This is repeated with ``GROWTH`` times as many centres a bucket, until no bucket holds two components. A bucket
   with fewer strays than centres is finished in that round, so the rounds are few (logarithmic in the strays) and
   every pair of different components has been compared or joined by others.

A pair only becomes a row where an exact bound leaves the threshold within reach: an odd sketch has a bit for each
hash value that occurs an odd number of times in a set; two sketches differ in no more bits than the sets do in
shingles. It grows with the set, so that it rules out as much for long texts; of two lengths the longer is folded.
Where a node's bands are given, a pair is only made in the first band that its nodes share.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import drop_folder, few, stored
from fleetlens.llm.components import components

#: The least number of bits of an odd sketch, a power of two from 64 on; longer sets get half a bit a shingle or more.
ODD_BITS = 2048
#: Centres, with their sketches, that are broadcast (some 600 bytes each); for more, the join shuffles.
BROADCAST_CENTERS = 10_000
#: Centres of a bucket in the first round of strays, and how many times as many in each further round.
CENTERS, GROWTH = 2, 8


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Bits as 64-bit numbers: which hash values occur an odd number of times in the set."""
    bits = ODD_BITS
    while 2 * bits < len(shingles):
        bits *= 2
    held = np.bincount((shingles >> np.uint64(16)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(held.astype(np.uint8), bitorder="little").view(np.int64)


def _folded(odd: str, other: str) -> Column:
    """The sketch at the length of a shorter one: the halves of the longer, bit by bit."""
    half = (F.size(odd) / 2).cast("int")
    halves = F.zip_with(
        F.slice(odd, F.lit(1), half), F.slice(odd, half + 1, half), lambda x, y: x.bitwiseXOR(y)
    )
    return F.when(F.size(odd) > F.size(other), halves).otherwise(F.col(odd))


def within_reach(percent: int) -> Column:
    """May sets with sketches ``odd_a``, ``odd_b`` and sizes ``n_a``, ``n_b`` reach the threshold?

    At the threshold t sets of p and q shingles differ in at most (1-t)/(1+t) * (p+q) of them.
    """
    room = (100 - percent) * (F.col("n_a") + F.col("n_b"))
    bits = F.aggregate(
        F.zip_with(_folded("odd_a", "odd_b"), _folded("odd_b", "odd_a"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, n: total + n,
    )
    # Most sketches are of the least length: for these the same sum written out, which Spark compiles.
    least = ODD_BITS // 64
    written = reduce(
        lambda total, n: total + n,
        [F.bit_count(F.get("odd_a", F.lit(i)).bitwiseXOR(F.get("odd_b", F.lit(i)))) for i in range(least)],
    )
    bits = F.when((F.size("odd_a") == least) & (F.size("odd_b") == least), written).otherwise(bits)
    return (F.abs(F.col("n_a") - F.col("n_b")) * (100 + percent) <= room) & (bits * (100 + percent) <= room)


def _share(seed: int) -> Column:
    """A node's number from 0 to 1, another one with each seed."""
    return (F.shiftrightunsigned(F.xxhash64("node", F.lit(seed)), 11) / float(1 << 53)).cast("double")


def contract(
    stars: DataFrame,
    buckets: DataFrame,
    sized: DataFrame,
    verify: Callable[[DataFrame, str], DataFrame],
    percent: int,
    folder: str,
) -> tuple[list[DataFrame], DataFrame]:
    """(tables of links (u, v), (node, component) of the nodes with links).

    ``stars`` are the first pairs (a, b); ``buckets`` is (band, node); ``sized`` has each node's n_shingles and odd,
    and bands where a node's buckets are bands; ``verify`` confirms pairs and stores the links.
    """
    by_band = "bands" in sized.columns
    fields = [("node", "node"), ("n_shingles", "n"), ("odd", "odd"), *([("bands", "bands")] if by_band else [])]
    links = [verify(stars, "star")]
    found = components(links[0], f"{folder}/found-star")
    found = stored(few(found, found.count()), f"{folder}/found")
    drop_folder(found.sparkSession, f"{folder}/found-star")
    left, centers, step = buckets.select("band", "node"), CENTERS, 0
    while True:
        at = f"{folder}/strays{step}"
        n = left.count()
        placed = left.join(found, "node", "left").select(
            "band", "node", F.coalesce("component", "node").alias("component")
        )
        parts = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
        several = (
            parts.groupBy("band")
            .agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts"))
            .filter("parts > 1")
            .select("band", F.col("top.component").alias("largest"), (F.col("all") - F.col("top.n")).alias("strays"))
        )
        several = stored(few(several, n), f"{at}-several")
        if several.isEmpty():
            return links, found
        stray = F.col("component") != F.col("largest")
        members = placed.join(several, "band").select(
            "band", "node", "component", (stray & (_share(step) * F.col("strays") < centers)).alias("center")
        )
        members = stored(few(members, n), f"{at}-members")
        # Sketches join where the pairs are made; they are not carried through a shuffle by bucket unless they must.
        chosen = stored(
            members.filter("center")
            .join(sized, "node")
            .select("band", *(F.col(x).alias(f"{y}_a") for x, y in fields), F.col("component").alias("ca")),
            f"{at}-centers",
        )
        others = members.join(sized, "node").select(
            F.col("band").alias("other_band"),
            *(F.col(x).alias(f"{y}_b") for x, y in fields),
            F.col("component").alias("cb"),
            F.col("center").alias("also"),
        )
        met = (
            (F.col("band") == F.col("other_band"))
            & (F.col("ca") != F.col("cb"))
            & (~F.col("also") | (F.col("node_a") < F.col("node_b")))
            & within_reach(percent)
        )
        if by_band:
            met &= F.get(F.array_intersect("bands_a", "bands_b"), F.lit(0)) == F.col("band")
        if chosen.count() <= BROADCAST_CENTERS:
            chosen = F.broadcast(chosen)
        pairs = others.join(chosen, met).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
        more = verify(pairs, f"strays{step}")
        if not more.isEmpty():
            links.append(more)
            edges = found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionAll(more)
            found = components(edges, f"{at}-found")
            found = stored(few(found, found.count()), f"{folder}/found{step}")
            drop_folder(found.sparkSession, f"{at}-found")
        left = stored(members.filter("not center").select("band", "node"), f"{folder}/left{step}")
        for part in ("members", "centers"):
            drop_folder(found.sparkSession, f"{at}-{part}")
        centers, step = centers * GROWTH, step + 1
