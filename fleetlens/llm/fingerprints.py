"""Document fingerprints: MinHash signatures over word shingles.

A fingerprint is the minima of HASHES universal hash functions over a text's five-word shingles, as hex
digits; two fingerprints' likeness is the share of equal minima, an estimate of the Jaccard similarity
whose standard deviation is at most 0.045. ``similar`` joins bands of these same minima in Spark, a star to the
least document of a band, then strays with the others, and never all pairs, and verifies the Jaccard similarity on
the full shingle sets. Each row names the group that these links put its document in, and counts its links.

``with_next`` puts each document beside the next by ascending doc_id with one shuffle of the texts: parts
of the id range are sorted by themselves, and the first document of each part is also dealt to the
part before it.

Defined results: a null text counts as empty; a text without words has the empty fingerprint, every
digit f; fewer than five words are one shingle; two empty texts have likeness 1, an empty and another
one 0; a text without words has no link, nor a row without doc_id; a null doc_id sorts first; rows that repeat a doc_id follow each other by text; after the
last document comes the first; an empty table gives no rows; other columns are not read.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import drop_folder, partitions, shared_folder, ship, stored
from fleetlens.llm.components import components
from fleetlens.llm.near_dedup import BROADCAST_IDS, banding, linked, sketches, text_sets
from fleetlens.llm.text_hash import Minima

HASHES, SHINGLE = 128, 5
#: Parts of the id range per shuffle partition: few enough to be cheap, many enough to even out.
PARTS = 4


def signatures(texts: pa.Array, minima: Minima, size: int = SHINGLE) -> list[np.ndarray]:
    """The minima of each text's shingles."""
    return [minima.of(shingles) for shingles in text_sets(texts, size)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal minima; an empty text is like empty texts only."""
    return float((a == b).mean())


def digits(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def _bounds(docs: DataFrame, parts: int) -> list[int]:
    """Ids that cut the documents into about equal parts: a few numbers, from an approximate quantile."""
    at = docs.select(F.col("doc_id").cast("long").alias("id")).agg(
        F.percentile_approx("id", [i / parts for i in range(1, parts)], 10_000).alias("q")
    ).first()["q"]
    return sorted(set(at or []))


def with_next(docs: DataFrame, notes: DataFrame) -> DataFrame:
    """Rows of (part, ghost, doc_id, text, group_id, n_links): in each partition sorted by part, ghosts last.

    A ghost is the first document of the next part; it only serves as the last document's successor.
    The rows of ``notes`` (doc_id, group_id, n_links) come without text, just before their documents.
    """
    spark = docs.sparkSession
    parts = PARTS * partitions(spark)
    bounds = np.array(_bounds(docs, parts), dtype=np.int64)
    lowest = np.iinfo(np.int64).min

    def part_of(ids: pd.Series) -> pd.Series:
        known = ids.fillna(lowest).astype("int64") if ids.dtype != "int64" else ids
        return pd.Series(np.searchsorted(bounds, known.to_numpy(), side="right"))

    part = F.pandas_udf(part_of, "int")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("part", part(F.coalesce("doc_id", F.lit(lowest))))
    first_id = F.coalesce("doc_id", F.lit(lowest))
    heads = sorted(
        (r["part"], r["head"])
        for r in rows.select("part", first_id.alias("id")).groupBy("part").agg(F.min("id").alias("head")).collect()
    )
    # One row per part: its first id, and the part before it.
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}
    ids = np.array(sorted(before), dtype=np.int64)
    to = np.array([before[i] for i in sorted(before)], dtype=np.int32)

    def ghost_of(known: pd.Series) -> pd.Series:
        values = known.to_numpy()
        at = np.minimum(np.searchsorted(ids, values), max(len(ids) - 1, 0))
        return pd.Series(np.where(ids[at] == values, to[at], -1) if len(ids) else values * 0 - 1).astype("int32")

    ghost = F.pandas_udf(ghost_of, "int")
    dealt = rows.withColumn("ghost_part", ghost(first_id)).select(
        "doc_id",
        "text",
        F.explode(
            F.concat(
                F.array(F.struct(F.col("part"), F.lit(False).alias("ghost"))),
                F.when(
                    F.col("ghost_part") >= 0,
                    F.array(F.struct(F.col("ghost_part").alias("part"), F.lit(True).alias("ghost"))),
                ).otherwise(F.array().cast("array<struct<part:int,ghost:boolean>>")),
            )
        ).alias("dealt"),
    )
    order = ["part", "ghost", "doc_id", "text"]
    none = F.lit(None).cast("long")
    noted = notes.select(
        part(F.col("doc_id")).alias("part"),
        F.lit(False).alias("ghost"),
        "doc_id",
        F.lit(None).cast("string").alias("text"),
        "group_id",
        "n_links",
    )
    return (
        dealt.select("dealt.part", "dealt.ghost", "doc_id", "text", none.alias("group_id"), none.alias("n_links"))
        .unionAll(noted)
        .repartition(partitions(spark), "part")
        .sortWithinPartitions(*order)
    )


def edited(text: str, following: str) -> str:
    """The text whose last half is replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, its edited text's, their likeness, its group; see the module.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, group_id, n_links.
    """
    ship(docs.sparkSession)
    notes = groups(docs)
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, group_id long, n_links long"
    )

    def compare(batches):
        minima = Minima(HASHES)
        last = None  # the row whose successor has not come yet: part, doc_id, text, signature, group, links
        note = (None, None, 0)  # the last note: doc_id, group, links
        for batch in batches:
            rows = []
            for part, ghost, doc_id, text, *noted in zip(
                *(batch.column(i).to_pylist() for i in range(6)), strict=True
            ):
                if text is None:
                    note = (doc_id, *noted)
                else:
                    rows.append((part, ghost, doc_id, text, note[1:] if note[0] == doc_id else (doc_id, 0)))
            for at in range(0, len(rows), 500):
                piece = rows[at : at + 500]
                own = signatures(pa.array([r[3] for r in piece]), minima)
                pairs = []
                for (part, ghost, doc_id, text, group), signature in zip(piece, own, strict=True):
                    if last is not None and last[0] == part:
                        pairs.append((*last[1:], text, signature))
                        last = None
                    if not ghost:
                        last = (part, doc_id, text, signature, group)
                if pairs:
                    yield _compared(pairs, minima, schema)

    return with_next(docs, notes).mapInArrow(compare, schema)


def _compared(pairs: list[tuple], minima: Minima, schema: str) -> pa.RecordBatch:
    changed = [edited(text, after) for _, text, _, _, after, _ in pairs]
    theirs = signatures(pa.array(changed, pa.string()), minima)
    rows = [
        (
            doc_id,
            len(text),
            hashlib.sha256(new.encode()).hexdigest(),
            digits(own),
            digits(their),
            likeness(own, their),
            likeness(own, after),
            *group,
        )
        for (doc_id, text, own, group, _, after), new, their in zip(pairs, changed, theirs, strict=True)
    ]
    kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2 + [pa.int64()] * 2
    names = [part.split()[0] for part in schema.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def similar(docs: DataFrame, percent: int = 80, size: int = SHINGLE, folder: str | None = None) -> DataFrame:
    """Verified links (u, v), u < v: enough of them to join all documents that any chain of links joins.

    Equal sets are linked to their least document. Different ones are compared with the least member of a band,
    and then as strays of their bands, as ``near_dedup`` does.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or shared_folder(spark, "similar")

    def done(*tables: str) -> None:
        for table in tables:
            drop_folder(spark, f"{folder}/{table}")

    bands, rows = banding(percent / 100, most=HASHES)
    named = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = stored(
        sketches(named, size, bands, rows, HASHES)
        .filter("set_digest is not null")
        .select("doc_id", "set_digest", "bands"),
        f"{folder}/marked",
    )
    classes = stored(marked.groupBy("set_digest").agg(F.min("doc_id").alias("node")), f"{folder}/classes")
    placed = marked.join(classes, "set_digest")
    copies = stored(
        placed.filter("doc_id <> node").select(F.col("node").alias("u"), F.col("doc_id").alias("v")).distinct(),
        f"{folder}/copies",
    )
    keyed = stored(
        placed.filter("doc_id = node").select(F.explode("bands").alias("band"), "node"), f"{folder}/bands"
    )
    done("marked", "classes")
    centers = stored(
        keyed.groupBy("band").agg(F.min("node").alias("center"), F.max("node").alias("top")).filter("top > center"),
        f"{folder}/centers",
    )
    buckets = stored(
        keyed.join(centers, "band").select("band", "center", "node").distinct(), f"{folder}/buckets"
    )
    done("bands", "centers")
    # Signatures are kept of the documents that share a band only.
    wanted = stored(buckets.select("node").distinct(), f"{folder}/wanted")
    asked = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    first = stored(
        sketches(named.join(asked, F.col("doc_id") == F.col("node"), "left_semi"), size, bands, rows, HASHES)
        .filter("set_digest is not null")
        .select(F.col("doc_id").alias("node"), "set_digest", "n_shingles", "signature", "bands", "odd")
        .dropDuplicates(["node", "set_digest"]),
        f"{folder}/first",
    )
    done("wanted")
    links, _ = linked(named, first, buckets, size, percent, HASHES, folder)
    return stored(
        links.unionAll(copies).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct(),
        f"{folder}/links",
    )


def groups(docs: DataFrame, percent: int = 80, size: int = SHINGLE, folder: str | None = None) -> DataFrame:
    """Of each document with a link: doc_id, group_id (the least document that links lead to), n_links."""
    folder = folder or shared_folder(docs.sparkSession, "groups")
    links = similar(docs, percent, size, f"{folder}/similar")
    ends = links.select(F.col("u").alias("node")).unionAll(links.select(F.col("v").alias("node")))
    counted = stored(ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links")), f"{folder}/counted")
    found = stored(components(links, f"{folder}/components"), f"{folder}/found")
    result = stored(
        counted.join(found, "node").select(
            F.col("node").alias("doc_id"), F.col("component").alias("group_id"), "n_links"
        ),
        f"{folder}-result",
    )
    drop_folder(docs.sparkSession, folder)
    return result
