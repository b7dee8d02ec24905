"""Language identification by word-first backoff.

A word that any language's list knows is scored by its log frequency there, by a fixed penalty where it is
not listed. An unseen word is scored by its character n-grams, the longest length of which some
language knows one, else the next shorter. A text's score in a language is the mean over its
words; ``score`` is the best language's share when the means are taken as log odds.

The model is fitted on a bounded sample of labelled documents, SAMPLE of each language on average, chosen by a
hash of the identifier, and holds the LISTED most frequent words and n-grams of each length a language: its size is
bounded by these parameters. Prediction reads every text as a whole and nothing but the text.

Defined results: a null text, or one without a letter, is ``und`` with score 0; ties go to the
language that sorts first; without a single labelled document every text is ``und``; documents
without a language are predicted like all others; other columns are not read.
"""

import math
import pickle
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import kept, ship, trimmed

#: Labelled documents a language is learned from, on average; list length; longest n-gram.
SAMPLE, LISTED, LONGEST = 600, 8_000, 5
#: log10 frequency of what a language's list does not hold.
PENALTY = -7.0
UNKNOWN = "und"
#: Words whose scores a worker keeps between batches.
KEPT_WORDS = 200_000

_LETTERS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: str = "doc_id") -> Column:
    """Is the document kept from learning: crc32 of its identifier as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def grams(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Model:
    """Per language the log10 frequencies of its listed words (length 0) and n-grams (1 to LONGEST)."""

    languages: list[str]
    rows: dict[int, dict[str, list[float]]] = field(default_factory=dict)

    def word(self, word: str) -> list[float] | None:
        """The word's score in every language; None if nothing of it is known."""
        known = self.rows.get(0, {}).get(word)
        if known is not None:
            return known
        for n in range(LONGEST, 0, -1):
            table = self.rows.get(n, {})
            hits = [table[g] for g in grams(word, n) if g in table]
            if hits:
                return [sum(column) / len(hits) for column in zip(*hits, strict=True)]
        return None


def fit(docs: DataFrame, sample: int = SAMPLE, listed: int = LISTED) -> Model:
    """Learn from a sample of the labelled documents of ``docs`` (doc_id, text, lang) that are not held out."""
    ship(docs.sparkSession)
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        "doc_id", "lang", "text"
    )
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([])
    rates = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(sample / counts[lang]))])
    drawn = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) < rates[F.col("lang")] * (1 << 30)

    def count(batches):
        found: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(_LETTERS.findall(text.lower()))
        for lang, words in found.items():
            rows = [(0, w, c) for w, c in words.items()]
            for n in range(1, LONGEST + 1):
                table: Counter = Counter()
                for word, c in words.items():
                    for g in grams(word, n):
                        table[g] += c
                rows += [(n, g, c) for g, c in table.items()]
            for i in range(0, len(rows), 50_000):
                lengths, items, numbers = zip(*rows[i : i + 50_000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(items)), pa.array(lengths, pa.int32()), pa.array(items), pa.array(numbers, pa.int64())],
                    names=["lang", "length", "item", "n"],
                )

    sums = (
        labelled.filter(drawn)
        .select("lang", "text")
        .mapInArrow(trimmed(count), "lang string, length int, item string, n long")
        .groupBy("lang", "length", "item")
        .agg(F.sum("n").alias("n"))
    )
    per = Window.partitionBy("lang", "length")
    top = (
        sums.withColumn("total", F.sum("n").over(per))
        .withColumn("place", F.row_number().over(per.orderBy(F.desc("n"), "item")))
        .filter(F.col("place") <= listed)
    )
    model = Model(languages)
    at = {lang: i for i, lang in enumerate(languages)}
    for r in top.select("lang", "length", "item", "n", "total").collect():
        row = model.rows.setdefault(r["length"], {}).setdefault(r["item"], [PENALTY] * len(languages))
        row[at[r["lang"]]] = math.log10(r["n"] / r["total"])
    return model


class Scorer:
    """Predicts texts; keeps the scores of the words it has met."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.none = [0.0] * len(model.languages)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.matrix = np.zeros((0, len(self.none)))

    def texts(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        words = [_LETTERS.findall(text.lower()) if text else [] for text in texts]
        fresh = list(set().union(*words).difference(self.place))
        more = np.array([self.model.word(word) or self.none for word in fresh]).reshape(len(fresh), len(self.none))
        self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh)), strict=True))
        self.matrix = matrix = np.concatenate([self.matrix, more])
        found, scores, take = [], [], self.place.__getitem__
        for text in words:
            if not text or not self.model.languages:
                found.append(UNKNOWN)
                scores.append(0.0)
                continue
            means = matrix[np.fromiter(map(take, text), np.int64, len(text))].mean(axis=0)
            best = int(means.argmax())
            found.append(self.model.languages[best])
            scores.append(float(1.0 / np.power(10.0, means - means[best]).sum()))
        if len(self.place) > KEPT_WORDS:
            self._forget()
        return found, scores


def predictor(model: Model):
    """A Pandas UDF from a text to (lang_pred, score)."""

    key = ("language", uuid.uuid4().hex)
    # As bytes: a task whose worker has the model makes no second one of it.
    packed = pickle.dumps(model)

    def score(parts):
        scorer = kept(key, lambda: Scorer(pickle.loads(packed)))
        for texts in parts:
            found, scores = [], []
            for i in range(0, len(texts), 1000):
                piece = texts.iloc[i : i + 1000]
                a, b = scorer.texts([None if x is None or x != x else x for x in piece])
                found += a
                scores += b
            yield pd.DataFrame({"lang_pred": found, "score": scores})

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from trimmed(score)(parts)

    return F.pandas_udf(run, "lang_pred string, score double")


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score. Without a model one is fitted on ``docs``."""
    model = model or fit(docs)
    ship(docs.sparkSession)
    predict = predictor(model)
    return docs.select("doc_id", held_out().alias("held_out"), predict(F.col("text")).alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score"
    )
