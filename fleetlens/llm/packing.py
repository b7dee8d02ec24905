"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of its documents' token ids. Every window of 4096 tokens serves all queues,
each by its share; what a queue was owed and could not get as whole tokens is its deficit and is
carried on. With B(s, k) = floor(4096 k C(s) / N), C(s) the tokens of the queues up to s and N of all,
queue s has been served A(s, k) = B(s, k) - B(s-1, k) tokens before window k: its deficit there,
4096 k N(s)/N - A(s, k), never reaches one token, every window is exactly full, and both the queue's place
in the window and the cut of a document follow from sums alone. So the deficits cross windows and
partitions without any task waiting for another.

With ``targets`` other than the queues' own sizes a queue runs dry before others. The packing then
has phases, one for each set of queues that still hold tokens, each packed the same way. What is left at a
phase's end, less than a window, goes to sequences whose lengths are powers of two: nothing is padded.
A source whose share is under two tokens a window queues with the other small ones.

Tokens are made once, stored, and cut on the second reading; a partition's place in each queue is a
running sum over partitions.

Defined results: a null or empty text is its end token alone; a null source is a source; rows that
repeat an identifier are packed each for itself; an empty table gives no rows; others columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import kept, shared_folder, ship, stored, trimmed
from fleetlens.llm.text_hash import steps, text_buffers

WINDOW = 4096
#: Words whose ids a worker keeps from one batch and task to the next.
KEPT_WORDS = 400_000
#: Bytes of text that are encoded at once.
STEP = 1_000_000
#: Words that the tokenizer gets at once.
BLOCK = 10_000

#: What a pre-tokenizer says that takes letters, and marks, as runs of their own.
_CUTS = (r"[\p{L}]+", r"[^\s\p{L}\p{N}]+")
#: A word of letters and digits and the marks behind it, none of which is an apostrophe.
_TAIL = re.compile(rb"([a-z0-9\x80-\xff]+)([^a-z0-9\x80-\xff'A-Z]+)")
#: Words of letters below this one (Latin, Greek, Cyrillic) are their own token runs; all Unicode tables agree on them.
_BEYOND = "\u0530"
#: The characters that stand for bytes in byte-level vocabularies.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = dict(zip(_SHOWN, _SHOWN, strict=True)) | {
    byte: 256 + n for n, byte in enumerate(sorted(set(range(256)).difference(_SHOWN)))
}


def _shown(word: bytes) -> str | None:
    """A word of nothing but letters as a byte-level vocabulary spells it, in lower case; None for any other."""
    if word.isascii():
        return word.lower().decode() if word.isalpha() else None
    text = word.decode()
    lowered = unicodedata.normalize("NFC", text).lower()
    # A capital sigma has two small forms.
    if not lowered.isalpha() or max(lowered) >= _BEYOND or "\u03a3" in text:
        return None
    return lowered.encode().decode("latin-1").translate(_BYTES)


class WordEncoder:
    """Token ids of texts as bytes, for tokenizers whose tokens never span white space.

    Each distinct word is encoded once a batch; the first ``kept_words``, among them the frequent ones, stay known.
    Where the tokenizer lower-cases, so are A-Z beforehand; where it cuts letters from other marks, a word
    and the marks behind it are encoded apart. Both make for fewer distinct words and for the same ids.
    A word of nothing but letters goes straight to the tokenizer's model, if that proves right for each letter.
    """

    def __init__(self, path: str, end: int, kept_words: int = KEPT_WORDS) -> None:
        self.kept_words = kept_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as file:
            parts = json.load(file)
        self.lowers = '"Lowercase"' in json.dumps(parts["normalizer"])
        rules = json.dumps(parts["pre_tokenizer"], ensure_ascii=False)
        self.cuts = self.lowers and all(rule in rules.replace("\\\\", "\\") for rule in _CUTS)
        # The tokenizer's own marks are taken as they are written.
        self.marks = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.end = np.array([end], self.kind).tobytes()
        self.known: dict[bytes, bytes] = {}
        self.model = self.tokenizer.model
        letters = self._by_model([chr(c).encode() for c in range(ord(_BEYOND))]) if self.cuts else {}
        self.direct = bool(letters) and letters == self._by_tokenizer(list(letters))

    def _pack(self, ids: list[int]) -> bytes:
        # Numbers of two and four bytes, as the machine has them.
        return array("H" if self.kind.itemsize == 2 else "I", ids).tobytes()

    def _by_tokenizer(self, words: list[bytes]) -> dict[bytes, bytes]:
        found = {}
        for i in range(0, len(words), BLOCK):
            part = words[i : i + BLOCK]
            ids = self.tokenizer.encode_batch_fast([word.decode() for word in part], add_special_tokens=False)
            found.update(zip(part, (self._pack(x.ids) for x in ids), strict=True))
        return found

    def _by_model(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of those of ``words`` that are letters throughout; the others are left out."""
        tokenize, pack, found = self.model.tokenize, self._pack, {}
        for word in words:
            if shown := _shown(word):
                found[word] = pack([token.id for token in tokenize(shown)])
        return found

    def _split(self, text: bytes) -> list[bytes]:
        if not self.lowers:
            return text.split()
        lowered = text.lower()
        if any(mark in lowered for mark in self.marks):
            return text.split()
        return lowered.split()

    def _learn(self, fresh: set[bytes]) -> None:
        bare, tails = fresh, {}
        if self.cuts:
            for word in fresh:
                if (found := _TAIL.fullmatch(word)) and (found[1].isascii() or _shown(found[1])):
                    tails[word] = found.groups()
            bare = fresh.difference(tails).union(*tails.values()).difference(self.known)
        if self.direct:
            self.known.update(self._by_model(list(bare)))
            bare = bare.difference(self.known)
        self.known.update(self._by_tokenizer(list(bare)))
        for word, (core, tail) in tails.items():
            self.known[word] = self.known[core] + self.known[tail]

    def texts(self, raw: list[bytes]) -> list[bytes]:
        words = [self._split(text) for text in raw]
        fresh = set().union(*words).difference(self.known)
        kept = max(len(self.known), self.kept_words)
        self._learn(fresh)
        take = self.known.__getitem__
        ids = [b"".join(map(take, text)) + self.end for text in words]
        while len(self.known) > kept:  # the last learnt go first
            self.known.popitem()
        return ids


def tokens(
    docs: DataFrame, path: str, end: int, kept_words: int = KEPT_WORDS, step: int = STEP
) -> DataFrame:
    """Per document: its ids, their number, and the ids of its source before it in its partition."""

    def encode(batches):
        encoder = kept(("packing", path, end, kept_words), lambda: WordEncoder(path, end, kept_words))
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            data, offsets = text_buffers(batch.column(2))
            for first, last in steps(offsets, step):
                raw = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(first, last)]
                ids = encoder.texts(raw)
                counts = [len(x) // encoder.kind.itemsize for x in ids]
                sources = batch.column(1).slice(first, last - first)
                before = []
                for source, n in zip(sources.to_pylist(), counts, strict=True):
                    before.append(seen.get(source, 0))
                    seen[source] = before[-1] + n
                rows = last - first
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows),
                        sources,
                        pa.array([part] * rows, pa.int32()),
                        pa.array(before, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([encoder.kind.itemsize] * rows, pa.int32()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "source", "part", "before", "n", "width", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text").mapInArrow(
        trimmed(encode), "doc_id long, source string, part int, before long, n long, width int, ids binary"
    )


@dataclass
class Phase:
    """Queue s gives its tokens start[s] .. start[s] + length[s] to the sequences from ``first`` on."""

    start: list[int]
    length: list[int]
    first: int

    def __post_init__(self) -> None:
        self.upto = [0]
        for n in self.length:
            self.upto.append(self.upto[-1] + n)
        self.total = self.upto[-1]
        self.windows = self.total // WINDOW
        left = self.total - self.windows * WINDOW
        # The rest in powers of two, the largest first.
        self.ends = [0]
        for bit in range(WINDOW.bit_length(), -1, -1):
            if left >> bit & 1:
                self.ends.append(self.ends[-1] + (1 << bit))
        self.served = [self.before(s, self.windows) for s in range(len(self.length))]
        self.rest = [0]
        for n, served in zip(self.length, self.served, strict=True):
            self.rest.append(self.rest[-1] + n - served)

    def before(self, s: int, k: int) -> int:
        """Tokens of queue s in the windows before window k."""
        at = WINDOW * k
        return at * self.upto[s + 1] // self.total - at * self.upto[s] // self.total if self.total else 0

    def place(self, s: int, k: int) -> int:
        """Where queue s begins in window k."""
        at = WINDOW * k
        return (at + WINDOW) * self.upto[s] // self.total - at * self.upto[s] // self.total

    def sequences(self) -> int:
        return self.windows + len(self.ends) - 1

    def parts(self, s: int, low: int, high: int) -> list[tuple[int, int, int]]:
        """(first token, sequence, offset) of every stretch of queue s between low and high, in order."""
        found, n = [], self.length[s]
        if low < self.served[s]:
            k = max(0, low * self.total // (WINDOW * n) - 2)
            while k < self.windows:
                begin, end = self.before(s, k), self.before(s, k + 1)
                if begin >= high:
                    break
                if end > low and end > begin:
                    found.append((begin, self.first + k, self.place(s, k)))
                k += 1
        shift = self.rest[s] - self.served[s]
        for j, begin in enumerate(self.ends[:-1]):
            own = max(begin - shift, self.served[s])
            if own < min(self.ends[j + 1] - shift, n) and own < high and self.ends[j + 1] - shift > low:
                found.append((own, self.first + self.windows + j, own + shift - begin))
        return found


def phases(lengths: list[int], weights: list[float] | None = None) -> list[Phase]:
    """The phases of queues of these lengths served by ``weights``; without weights one phase."""
    if weights is None:
        return [Phase([0] * len(lengths), list(lengths), 0)]
    found, taken, first = [], [0] * len(lengths), 0
    for dry in sorted({n / w for n, w in zip(lengths, weights, strict=True)}):
        upto = [n if n / w <= dry else min(n, int(w * dry)) for n, w in zip(lengths, weights, strict=True)]
        own = [u - t for u, t in zip(upto, taken, strict=True)]
        # Queues with too small a part of this phase wait for the next one, where they have more.
        own = [x if x * WINDOW >= 2 * sum(own) or upto[s] == lengths[s] else 0 for s, x in enumerate(own)]
        small = [s for s, x in enumerate(own) if 0 < x * WINDOW < 2 * sum(own)]
        for group in [[s for s in range(len(own)) if s not in small], *[[s] for s in small]]:
            phase = Phase(list(taken), [x if s in group else 0 for s, x in enumerate(own)], first)
            if phase.total:
                found.append(phase)
                first += phase.sequences()
        taken = [t + x for t, x in zip(taken, own, strict=True)]
    return found


def queues(sums: DataFrame) -> tuple[list[tuple[str | None, int]], int]:
    """(the sources that have a queue of their own, tokens of all the others) of (source, n).

    A source with two tokens or more in a window has a queue: there are at most 2048 of them.
    """
    total = sums.agg(F.sum("n")).first()[0] or 0
    per = sums.groupBy("source").agg(F.sum("n").alias("n"))
    own = sorted(
        ((r["source"], r["n"]) for r in per.filter(F.col("n") * (WINDOW // 2) >= total).collect()),
        key=lambda x: (x[0] is None, x[0]),
    )
    rest = total - sum(n for _, n in own)
    if own and 0 < rest * (WINDOW // 2) < total:
        # Too little for a queue: the smallest source queues with it.
        least = min(own, key=lambda x: x[1])
        own.remove(least)
        rest += least[1]
    return own, rest


def _bases(sums: DataFrame, own: list[tuple[str | None, int]], folder: str) -> DataFrame:
    """(part, source, queue, base): where the source's tokens of a partition begin in their queue."""
    spark = sums.sparkSession
    # An Arrow table comes without Python on the executors; rows would start a second set of workers there.
    listed = [pa.array([s for s, _ in own], pa.string()), pa.array(range(len(own)), pa.int32())]
    named = spark.createDataFrame(pa.table(listed, names=["queue_source", "queue"]))
    placed = sums.join(F.broadcast(named), sums["source"].eqNullSafe(named["queue_source"]), "left").drop(
        "queue_source"
    )
    run = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    big = placed.filter("queue is not null").withColumn(
        "base", F.coalesce(F.sum("n").over(run.partitionBy("source")), F.lit(0))
    )
    small = stored(placed.filter("queue is null"), f"{folder}/small")
    # The sources without a queue: one row per partition, then the sources within a partition.
    tails = small.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("tail")
    )
    inner = Window.partitionBy("part").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    small = small.withColumn("inner", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(tails, "part")
    rest = small.select("part", "source", F.lit(len(own)).alias("queue"), (F.col("tail") + F.col("inner")).alias("base"))
    return stored(big.select("part", "source", "queue", "base").unionByName(rest), f"{folder}/bases")


def pack(
    docs: DataFrame,
    path: str,
    end: int,
    targets: dict[str | None, float] | None = None,
    with_ids: bool = False,
    folder: str | None = None,
    kept_words: int = KEPT_WORDS,
    step: int = STEP,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids].

    ``path`` is a tokenizer file whose tokens never span white space, ``end`` the id that ends a
    document. ``targets`` weighs sources; those not named weigh nothing until the named ones are dry.
    Without it every window has the proportions of the whole. Fewer ``kept_words`` and bytes a ``step`` take less
    memory and more time for the same rows.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or shared_folder(spark, "pack")
    made = stored(tokens(docs, path, end, kept_words, step), f"{folder}/tokens")
    sums = stored(made.groupBy("part", "source").agg(F.sum("n").alias("n")), f"{folder}/sums")
    own, rest = queues(sums)
    lengths = [n for _, n in own] + [rest] * (rest > 0)
    weights = None
    if targets:
        weights = [max(targets.get(s, 0.0), 1e-9) for s, _ in own] + [1e-9] * (rest > 0)
    plan = phases(lengths, weights)
    bases = _bases(sums, own, folder)
    same = made["source"].eqNullSafe(bases["source"]) & (made["part"] == bases["part"])
    rows = made.join(bases, same).select(
        "doc_id", "queue", (F.col("base") + F.col("before")).alias("at"), "n", "width", "ids"
    )

    def cut(batches):
        for batch in batches:
            yield from _pieces(batch, plan, with_ids)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(trimmed(cut), schema + ", ids binary" * with_ids)


def _pieces(batch: pa.RecordBatch, plan: list[Phase], with_ids: bool):
    doc_ids, queue, at, n, width = (batch.column(i).to_pylist() for i in range(5))
    order = sorted(range(len(doc_ids)), key=lambda i: (queue[i], at[i]))
    out: list[tuple] = []
    run = 0
    while run < len(order):
        # Documents that follow each other in their queue share one list of stretches.
        last, q = run, queue[order[run]]
        while last + 1 < len(order) and queue[order[last + 1]] == q and at[order[last + 1]] == at[order[last]] + n[order[last]]:
            last += 1
        low, high = at[order[run]], at[order[last]] + n[order[last]]
        marks: list[tuple[int, int, int]] = []
        for phase in plan:
            begin, stop = phase.start[q], phase.start[q] + phase.length[q]
            if begin < high and stop > low and phase.length[q]:
                inner = phase.parts(q, max(low - begin, 0), min(high, stop) - begin)
                marks += [(p + begin, s, o) for p, s, o in inner]
        here = 0
        for i in order[run : last + 1]:
            kind = np.dtype("<u2" if width[i] == 2 else "<u4")
            raw = batch.column(5)[i].as_py()
            wide = np.frombuffer(raw, kind).astype("<u4").tobytes()
            begin, stop = at[i], at[i] + n[i]
            while here + 1 < len(marks) and marks[here + 1][0] <= begin:
                here += 1
            j = here
            while begin < stop:
                to = min(stop, marks[j + 1][0]) if j + 1 < len(marks) else stop
                first, length = begin - at[i], to - begin
                out.append(
                    (
                        doc_ids[i],
                        first,
                        length,
                        zlib.crc32(memoryview(wide)[4 * first : 4 * (first + length)]),
                        n[i],
                        marks[j][1],
                        marks[j][2] + begin - marks[j][0],
                    )
                    + ((raw[first * width[i] : (first + length) * width[i]],) if with_ids else ())
                )
                begin = to
                j += 1
        run = last + 1
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 7 + [pa.binary()] * with_ids
    for i in range(0, len(out), 20_000):
        columns = list(zip(*out[i : i + 20_000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the sequences of pieces with ids, each put together by offset (4096 ids at most)."""
    return pieces.groupBy("sequence_id").agg(
        F.aggregate(
            F.array_sort(F.collect_list(F.struct("offset", "ids"))),
            F.unhex(F.lit("")),
            lambda done, piece: F.concat(done, piece["ids"]),
        ).alias("ids")
    )
