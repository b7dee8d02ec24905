"""Ranked lexical search on bit-sliced Bloom signatures, exact.

**Index.** Documents of a like number of distinct terms are put into blocks. A document's signature has bits for each
of its terms and, for a term it holds several times, for each of LEVELS that the count reaches. A block is stored
by slices: one row of bits per signature bit, with a bit per document. A term's rows, combined by AND, are a bitmap
over documents that holds every document with the term and a few more. Beside the blocks, the index lists in how many
documents each term occurs. It is built once, from the documents alone, and stored.

**Search.** From a term's bitmaps each document has a count that it cannot exceed, and from that and its own length a
score that the term cannot exceed. Their weighted sum over the query's terms is the upper bound of the document's
score. (1) The documents of the highest bounds are scored on their text; the last of as many as are asked for gives a
score that the result cannot fall below. (2) Every document whose bound is not below it is scored on its text; all
others are provably out. Of two documents of the same score the one with the smaller identifier is before the other,
so where a bound equals that score a larger identifier is out too.

Scores are whole numbers: see ``weight``, ``dampening`` and ``term_score``. The queries are gone through in groups of
GROUP_BYTES of text, each group against all documents.

Defined results: a null text has no terms; documents and queries without terms are in no list; rows that share an
identifier are documents of their own; a null identifier comes after all others; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import drop_folder, shared_folder, ship, stored, with_locator

#: Counts of a term that have signature bits of their own.
LEVELS = (1, 2, 3, 4, 5, 6, 8, 10, 13, 17, 24, 34, 50, 75, 110)
#: Signature bits per key of a block's largest document, and rows per key.
BITS, ROWS = 12, 4
#: Documents and keys that are put in order of size before they are cut into blocks; documents and bits of a block.
ORDERED, ORDERED_KEYS, BLOCK_DOCS, BLOCK_BITS = 8192, 1 << 22, 512, 1 << 25
#: Terms whose counts a task keeps before it hands them on.
KEPT_TERMS = 200_000
#: Bytes of query text that are searched at once.
GROUP_BYTES = 4 << 20
#: Documents whose places are broadcast to pick their texts; for more, the join shuffles.
BROADCAST_PLACES = 50_000

#: Fixed values of the score: its scale, saturation, and the part of the length.
SCALE, SATURATION, LENGTH_PART = 1_000_000_000, 12, 25

_INDEX = (
    "term string, n_docs long, doc_ids array<long>, lengths array<long>, files array<string>, places array<long>, "
    "width long, slices binary"
)
_SPLIT = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text: runs of ASCII letters, digits and all that is not ASCII; A-Z lower-cased."""
    return (text or "").encode().translate(_SPLIT).split()


def weight(n_docs: int, held: int) -> int:
    """Of a term that ``held`` of all documents with a term hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held + 1)))


def dampening(length, n_docs: int, all_terms: int):
    """A document's divisor: 100 for the mean length."""
    return 100 - LENGTH_PART + (LENGTH_PART * length * n_docs) // all_terms


def term_score(count, damp):
    """A term's part of the score before its weight; grows with the count, falls with the dampening."""
    return (SCALE * count) // (1000 * count + SATURATION * damp)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _keys(hashes: np.ndarray, level: int) -> np.ndarray:
    """The keys of terms at a level, by the terms' checksums."""
    return _mixed(hashes.astype(np.uint64) + np.uint64((level + 1) << 40))


def _rows(keys: np.ndarray, width: int) -> np.ndarray:
    """(keys, ROWS): the signature bits of each key."""
    first, step = keys >> np.uint64(32), (keys & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    each = first[:, None] + np.arange(ROWS, dtype=np.uint64)[None] * step[:, None]
    return (_mixed(each) % np.uint64(width)).astype(np.int64)


def _document_keys(counts: Counter) -> np.ndarray:
    hashes = np.fromiter(map(zlib.crc32, counts), np.uint64, len(counts))
    held = np.fromiter(counts.values(), np.int64, len(counts))
    found = []
    for level, least in enumerate(LEVELS):
        if level:
            some = held >= least
            hashes, held = hashes[some], held[some]
        if not len(held):
            break
        found.append(_keys(hashes, level))
    return np.concatenate(found)


def _blocks(rows: list[tuple]) -> Iterator[tuple]:
    """Blocks of documents (doc_id, length, file, place, keys) of like size."""
    rows = sorted(rows, key=lambda r: len(r[4]))
    at = 0
    while at < len(rows):
        # The last document of a block is its largest and sets the width.
        n = min(BLOCK_DOCS, len(rows) - at)
        while n > 8 and n * BITS * len(rows[at + n - 1][4]) > BLOCK_BITS:
            n //= 2
        block = rows[at : at + n]
        at += n
        width = BITS * len(block[-1][4])
        bits = np.zeros((width, n), bool)
        for i, row in enumerate(block):
            bits[_rows(row[4], width).ravel(), i] = True
        ids, lengths, files, places, _ = zip(*block, strict=True)
        yield ids, lengths, files, places, width, np.packbits(bits, axis=1).tobytes()


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {
        "string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(),
        "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    }
    fields = [part.split(" ") for part in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def build_index(located: DataFrame, folder: str) -> DataFrame:
    """The stored index of documents (doc_id, text, _file, _row): rows of blocks, and of terms with their documents."""

    def build(batches):
        waiting: list[tuple] = []
        held: Counter = Counter()

        def out(docs: int, keys: int):
            if len(waiting) > docs or sum(len(row[4]) for row in waiting) > keys:
                for block in _blocks(waiting):
                    yield _batch(_INDEX, [(None, None, *block)])
                waiting.clear()

        def told(least: int):
            if len(held) > least:
                yield _batch(_INDEX, [(t.decode(), n, *[None] * 6) for t, n in held.items()])
                held.clear()

        for batch in batches:
            for doc_id, text, file, place in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                found = terms(text)
                if found:
                    counts = Counter(found)
                    held.update(counts.keys())
                    waiting.append((doc_id, len(found), file, place, _document_keys(counts)))
                    yield from told(KEPT_TERMS)
            yield from out(ORDERED, ORDERED_KEYS)
        yield from out(0, 0)
        yield from told(0)

    return stored(located.select("doc_id", "text", "_file", "_row").mapInArrow(build, _INDEX), f"{folder}/index")


class _Group:
    """Some queries: their terms' checksums, and each query's terms with their weights."""

    def __init__(self, queries: list[list[bytes]], weights: dict[bytes, int], n_docs: int, all_terms: int) -> None:
        self.n_docs, self.all_terms = n_docs, all_terms
        self.weights = weights
        self.queries = [Counter(t for t in q if weights.get(t)) for q in queries]
        vocabulary = sorted({t for q in self.queries for t in q})
        number = {t: i for i, t in enumerate(vocabulary)}
        self.hashes = np.fromiter(map(zlib.crc32, vocabulary), np.uint64, len(vocabulary))
        self.parts = [
            (
                np.array([number[t] for t in q], np.int64),
                np.array([times * weights[t] for t, times in q.items()], np.int64),
            )
            for q in self.queries
        ]

    def exact(self, text: str, asked: list[int]) -> Iterator[tuple[int, int]]:
        """(query, score) of a text."""
        found = terms(text)
        counts, damp = Counter(found), dampening(len(found), self.n_docs, self.all_terms)
        for q in asked:
            yield q, sum(
                times * self.weights[t] * term_score(counts[t], damp)
                for t, times in self.queries[q].items()
                if t in counts
            )

    def bounds(self, lengths: np.ndarray, width: int, slices: bytes) -> np.ndarray:
        """(queries, documents): scores that the documents of a block cannot exceed."""
        n = len(lengths)
        rows = np.frombuffer(slices, np.uint8).reshape(width, -1)
        reached = np.zeros((len(self.hashes), n), np.int8)
        alive, some = np.full((len(self.hashes), rows.shape[1]), 255, np.uint8), np.arange(len(self.hashes))
        for level in range(len(LEVELS)):
            held = np.bitwise_and.reduce(rows[_rows(_keys(self.hashes[some], level), width)], axis=1) & alive
            on = held.any(axis=1)
            some, alive = some[on], held[on]
            if not len(some):
                break
            reached[some] += np.unpackbits(alive, axis=1, count=n).astype(np.int8)
        # By level: the score of the largest count below the next level; beyond the last, of the whole text.
        counts = np.concatenate(
            [np.zeros((1, n), np.int64), np.repeat(np.array(LEVELS[1:], np.int64)[:, None] - 1, n, axis=1), lengths[None]]
        )
        parts = term_score(np.minimum(counts, lengths[None]), dampening(lengths, self.n_docs, self.all_terms)[None])
        each = parts[reached, np.arange(n)[None]]
        if not self.parts:
            return np.zeros((0, n), np.int64)
        return np.stack([w @ each[t] for t, w in self.parts])


_PAIRS = "q int, bound long, doc_id long, file string, place long"


def _pairs(index: DataFrame, group: _Group, top: int, least: dict[int, tuple[int, int | None]] | None) -> DataFrame:
    """(q, bound, doc_id, file, place) of the documents whose bounds are not below ``least``.

    ``least`` has the score and the identifier of each query's last; without it, a task's ``top`` bounds of
    each query.
    """

    def find(batches):
        n = len(group.queries)
        best = [np.zeros((0, 2), np.int64)] * n  # of each query: bounds and rows of ``seen``
        limit = np.ones(n, np.int64)
        if least is not None:
            limit = np.array([least[q][0] for q in range(n)], np.int64)
            last = np.array([np.iinfo(np.int64).max if least[q][1] is None else least[q][1] for q in range(n)])
        seen: dict[int, tuple] = {}
        number = 0
        for batch in batches:
            for ids, lengths, files, places, width, slices in zip(
                *(batch.column(i).to_pylist() for i in range(6)), strict=True
            ):
                bounds = group.bounds(np.array(lengths, np.int64), width, slices)
                if least is not None:
                    named = np.array([np.iinfo(np.int64).max if d is None else d for d in ids])
                    hit = (bounds > limit[:, None]) | ((bounds == limit[:, None]) & (named[None] <= last[:, None]))
                    found = [(q, int(bounds[q, d]), ids[d], files[d], places[d]) for q, d in np.argwhere(hit).tolist()]
                    for k in range(0, len(found), 10_000):
                        yield _batch(_PAIRS, found[k : k + 10_000])
                    continue
                for q in np.flatnonzero((bounds >= limit[:, None]).any(axis=1)).tolist():
                    d = np.flatnonzero(bounds[q] >= limit[q])
                    new = np.concatenate([best[q], np.stack([bounds[q, d], number + d], axis=1)])
                    if len(new) > top:
                        new = new[np.argpartition(-new[:, 0], top - 1)[:top]]
                        limit[q] = max(1, int(new[:, 0].min()) + 1)
                    best[q] = new
                seen.update((number + d, (ids[d], files[d], places[d])) for d in range(len(ids)))
                number += len(ids)
            if least is None:
                held = {int(r) for rows in best for r in rows[:, 1]}
                seen = {r: where for r, where in seen.items() if r in held}
        if least is None:
            for q in range(n):
                yield _batch(_PAIRS, [(q, b, *seen[r]) for b, r in best[q].tolist()])

    blocks = index.filter("slices is not null").select("doc_ids", "lengths", "files", "places", "width", "slices")
    return blocks.mapInArrow(find, _PAIRS)


def _scored(located: DataFrame, pairs: DataFrame, group: _Group, folder: str) -> DataFrame:
    """(q, doc_id, score) of stored pairs, on whole texts."""
    asked = stored(
        pairs.groupBy("file", "place").agg(F.collect_set("q").alias("asked")), f"{folder}-asked"
    )
    few = F.broadcast(asked) if asked.count() <= BROADCAST_PLACES else asked

    def score(batches):
        for batch in batches:
            rows = []
            for doc_id, text, qs in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                rows.extend((q, doc_id, s) for q, s in group.exact(text, qs))
            yield _batch("q int, doc_id long, score long", rows)

    found = located.join(few, (F.col("_file") == F.col("file")) & (F.col("_row") == F.col("place")))
    return stored(
        found.select("doc_id", "text", "asked").mapInArrow(score, "q int, doc_id long, score long").filter("score > 0"),
        f"{folder}-scored",
    )


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each query, numbered; Spark drops what comes later before it shuffles."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _weights(spark: SparkSession, index: DataFrame, vocabulary: list[bytes], n_docs: int) -> dict[bytes, int]:
    """The weights of the terms that some document holds."""
    asked = spark.createDataFrame([(t.decode(),) for t in vocabulary], "term string")
    held = index.filter("term is not null").select("term", "n_docs").join(F.broadcast(asked), "term")
    counts = held.groupBy("term").agg(F.sum("n_docs").alias("n")).collect()  # no more rows than the queries have terms
    return {r["term"].encode(): weight(n_docs, r["n"]) for r in counts}


def search(docs: DataFrame, queries: DataFrame, top: int = 20, folder: str | None = None) -> DataFrame:
    """Each query's ``top`` documents with a score above 0: item_id, rank, doc_id, score.

    ``queries`` is (item_id, text), each row a query of its own.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or shared_folder(spark, "search")
    located = with_locator(docs.select(F.col("doc_id").cast("long"), "text"), folder)
    index = build_index(located, folder)
    blocks = index.filter("slices is not null").select(F.explode("lengths").alias("n"))
    n_docs, all_terms = blocks.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked = stored(queries.select("item_id", "text").filter("text is not null"), f"{folder}/queries")
    groups = 1 + (asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // GROUP_BYTES)
    kind, result = queries.schema["item_id"].dataType.simpleString(), None
    for g in range(groups if n_docs else 0):
        at = f"{folder}/group{g}"
        own = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g) if groups > 1 else asked
        items = [(r["item_id"], terms(r["text"])) for r in own.collect()]
        items = [item for item in items if item[1]]
        weights = _weights(spark, index, sorted({t for _, q in items for t in q}), n_docs)
        group = _Group([q for _, q in items], weights, n_docs, all_terms)
        # The highest bounds of all tasks; the stored rows are at most top a query and task.
        first = stored(_pairs(index, group, top, None), f"{at}-first")
        high = Window.partitionBy("q").orderBy(F.desc("bound"), F.asc_nulls_last("doc_id"))
        first = first.withColumn("rank", F.row_number().over(high)).filter(F.col("rank") <= top).drop("rank")
        scored = _scored(located, stored(first, f"{at}-highest"), group, f"{at}-first")
        least = {q: (1, None) for q in range(len(items))}
        for r in _ranked(scored, top).filter(F.col("rank") == top).collect():  # a row a query
            least[r["q"]] = (r["score"], r["doc_id"])
        every = stored(_pairs(index, group, top, least), f"{at}-every")
        ranked = _ranked(_scored(located, every, group, f"{at}-every"), top)
        named = spark.createDataFrame([(q, item_id) for q, (item_id, _) in enumerate(items)], f"q int, item_id {kind}")
        found = ranked.join(F.broadcast(named), "q").select("item_id", "rank", "doc_id", "score")
        found = stored(found, f"{folder}-result{g}")
        result = found if result is None else result.unionAll(found)
    drop_folder(spark, folder)
    if result is None:
        result = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return result
