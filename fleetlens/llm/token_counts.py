"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton over the vocabulary's characters gives, at each place of a word, the pieces that
end there, longest first. Dynamic programming carries the best score and the number of pieces and nothing to trace
back. Ties go as in the tokenizer: a later candidate must be strictly better, and candidates come by
ascending start, so the longest last piece wins. A character that is no piece by itself may be
unknown, at the least piece score less ten, and counts as its UTF-8 bytes. Scores add up in
doubles, start to end, as the tokenizer adds them.

White space and U+2581 begin words, no piece crosses words, so each distinct word is counted once a
batch: all words of a length go through the automaton in step, in numpy.

Defined results: a null or empty text has no tokens; rows that repeat an identifier are counted each for
itself; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import kept, ship
from fleetlens.llm.text_hash import steps, text_buffers

#: What the tokenizer takes off the least score for an unknown character.
UNKNOWN_PENALTY = 10.0
#: Words whose counts a worker keeps between batches.
KEPT_WORDS = 300_000
SPACE = "▁"

_SHIFT = 21  # bits of a code point


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model file, without its control pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not model.is_control(i)
    ]


@dataclass
class Automaton:
    """Sorted (state, character) keys with their next states; per state failure, next output, length, score."""

    keys: np.ndarray
    nexts: np.ndarray
    fail: np.ndarray
    out: np.ndarray  # the longest piece that ends at the state, as a state; 0 for none
    length: np.ndarray
    score: np.ndarray
    unknown: float
    splits: bool  # a line end is in no piece, so lines can be counted apart

    @classmethod
    def of(cls, pieces: list[tuple[str, float]]) -> Automaton:
        edges: list[dict[int, int]] = [{}]
        length, score = [0], [-np.inf]
        for piece, value in pieces:
            state = 0
            for depth, c in enumerate(map(ord, piece), 1):
                follow = edges[state].get(c)
                if follow is None:
                    follow = edges[state][c] = len(edges)
                    edges.append({})
                    length.append(depth)
                    score.append(-np.inf)
                state = follow
            score[state] = value
        fail, out, queue = [0] * len(edges), [0] * len(edges), [0]
        for state in queue:
            for c, follow in edges[state].items():
                queue.append(follow)
                back = fail[state]
                while back and c not in edges[back]:
                    back = fail[back]
                fail[follow] = edges[back].get(c, 0) if state else 0
        for state in queue[1:]:
            out[state] = state if score[state] > -np.inf else out[fail[state]]
        rows = sorted((s << _SHIFT | c, f) for s, own in enumerate(edges) for c, f in own.items())
        keys, nexts = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        return cls(
            keys,
            nexts,
            np.array(fail, np.int64),
            np.array(out, np.int64),
            np.array(length, np.int64),
            np.array(score),
            min(value for _, value in pieces) - UNKNOWN_PENALTY,
            not any("\n" in piece for piece, _ in pieces),
        )

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The next states of all words at once; failures are followed until a character fits."""
        result = np.zeros(len(state), np.int64)
        open_, state = np.arange(len(state)), state.copy()
        while len(open_):
            key = state << _SHIFT | c[open_]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            fits = self.keys[at] == key
            result[open_[fits]] = self.nexts[at[fits]]
            again = ~fits & (state > 0)
            open_, state = open_[again], self.fail[state[again]]
        return result

    def count(self, chars: np.ndarray) -> np.ndarray:
        """Pieces of the best segmentation of words of one length: ``chars`` is words x characters."""
        n, size = chars.shape
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0.0
        count = np.zeros((size + 1, n), np.int64)
        state = np.zeros(n, np.int64)
        width = 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)
        for e in range(1, size + 1):
            state = self.step(state, chars[:, e - 1])
            alone = np.zeros(n, bool)
            rows, node = np.arange(n), self.out[state]
            rows, node = rows[node > 0], node[node > 0]
            while len(rows):
                length = self.length[node]
                alone[rows[length == 1]] = True
                value = best[e - length, rows] + self.score[node]
                better = value > best[e, rows]
                won = rows[better]
                best[e, won] = value[better]
                count[e, won] = count[e - length[better], won] + 1
                node = self.out[self.fail[node]]
                rows, node = rows[node > 0], node[node > 0]
            value = best[e - 1] + self.unknown
            won = np.flatnonzero(~alone & (value > best[e]))
            best[e, won] = value[won]
            count[e, won] = count[e - 1, won] + width[won, e - 1]
        return count[size]


class Counter:
    """Counts texts; keeps the counts of the words it has met."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton, self.known = automaton, {"": 0}

    def _words(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(SPACE, " ")
        marked = (text if text[0] == " " else " " + text).replace(" ", f"\0{SPACE}")[1:]
        return (marked.replace("\n", "\0") if self.automaton.splits else marked).split("\0")

    def _learn(self, words: list[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for word in words:
            by_length.setdefault(len(word), []).append(word)
        for size, group in by_length.items():
            block = max(1, 2_000_000 // size)
            for i in range(0, len(group), block):
                part = group[i : i + block]
                chars = np.frombuffer("".join(part).encode("utf-32-le"), "<u4").reshape(len(part), size)
                self.known.update(zip(part, self.automaton.count(chars.astype(np.int64)).tolist(), strict=True))

    def texts(self, texts: list[str]) -> list[int]:
        # A text that holds the mark itself is counted without it: "\0" is a character of its own below.
        words = [self._words(text) if "\0" not in text else None for text in texts]
        plain = [w for w in words if w is not None]
        fresh = list(set().union(*plain).difference(self.known))
        self._learn(fresh)
        take = self.known.__getitem__
        lines = self.automaton.splits
        counts = [
            self._marked(text) if own is None else sum(map(take, own)) + (text.count("\n") if lines else 0)
            for text, own in zip(texts, words, strict=True)
        ]
        if len(self.known) > KEPT_WORDS:
            self.known = {"": 0}
        return counts

    def _marked(self, text: str) -> int:
        """A text with NUL characters, which are word marks otherwise: its words one by one."""
        text = text.replace(SPACE, " ")
        words = [SPACE + w for w in (text[1:] if text[0] == " " else text).split(" ")]
        return sum(
            int(self.automaton.count(np.array([[ord(c) for c in word]], np.int64))[0]) for word in words
        )


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_chars, n_tokens under the vocabulary of the file ``path``."""
    spark = docs.sparkSession
    ship(spark)
    # The vocabulary is a file of fixed size, so its automaton is, too.
    automaton = spark.sparkContext.broadcast(Automaton.of(vocabulary(path)))

    key = ("tokens", path)

    def count(batches):
        counter = kept(key, lambda: Counter(automaton.value))
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for first, last in steps(offsets):
                texts = [data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in range(first, last)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array(counter.texts(texts), pa.int64()),
                    ],
                    names=["doc_id", "n_chars", "n_tokens"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        count, "doc_id long, n_chars long, n_tokens long"
    )
