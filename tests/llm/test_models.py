"""Language ID, LM scoring, token counts."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from fleetlens.llm import ngram
from fleetlens.llm.common import shared_folder
from fleetlens.llm.elias_fano import EliasFano, load, save
from fleetlens.llm.language import Model, fit, grams, identify
from fleetlens.llm.queries import op6_lm_scoring
from fleetlens.llm.token_counts import SPACE, Automaton, token_counts, vocabulary
from fleetlens.llm.token_counts import Counter as TokenCounter

PIECES = public_tokenizers.path("piece_bpe_32k.model")


class TestLanguage:
    def test_held_out_accuracy(self, spark):
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
        found = identify(docs).collect()
        assert len(found) == len(lang)
        for r in found:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
            assert 0.0 <= r["score"] <= 1.0
        unseen = [r for r in found if r["held_out"]]
        assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in unseen) >= 0.99 * len(unseen)

    def test_labels_of_held_out_documents_are_never_read(self, spark, frame):
        rows = [(d, "aa bb cc" if d % 2 else "xx yy zz", "p" if d % 2 else "q", "s") for d in range(40)]
        swapped = [
            (d, t, "p" if zlib.crc32(str(d).encode()) % 4 == 2 else lang, s) for d, t, lang, s in rows
        ]
        a = {r["doc_id"]: r["lang_pred"] for r in identify(frame(rows)).collect()}
        b = {r["doc_id"]: r["lang_pred"] for r in identify(frame(swapped)).collect()}
        assert a == b == {d: lang for d, _, lang, _ in rows}

    def test_odd_rows(self, frame, odd_rows):
        found = identify(frame(odd_rows)).collect()
        assert len(found) == len(odd_rows)
        pred = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
        assert pred[1] == pred[2] == pred[3] == pred[7] == ("und", 0.0)
        assert pred[4][0] == "en"

    def test_without_labels_all_is_unknown(self, frame):
        assert {r["lang_pred"] for r in identify(frame([(1, "hello"), (3, None)])).collect()} == {"und"}

    def test_empty_table(self, frame):
        assert identify(frame([(1, "a", "en")]).limit(0)).count() == 0

    def test_words_come_first_then_shorter_grams(self):
        model = Model(["a", "b"], {0: {"word": [-1.0, -2.0]}, 3: {" wo": [-4.0, -3.0]}, 1: {"z": [-5.0, -6.0]}})
        assert model.word("word") == [-1.0, -2.0]
        assert model.word("wobble") == [-4.0, -3.0]
        assert model.word("zzz") == [-5.0, -6.0]
        assert model.word("qqq") is None
        assert grams("ab", 3) == [" ab", "ab "]

    def test_the_sample_is_bounded(self, spark, sample):
        model = fit(sample, sample=5, listed=20)
        assert all(len(table) <= 20 * len(model.languages) for table in model.rows.values())


class Reference:
    """The model of the module, by dictionaries."""

    def __init__(self, texts):
        self.c1, self.c2, self.c3 = Counter(), Counter(), Counter()
        for text in texts:
            t = tokens(text)
            s = [b"</s>", *t]
            self.c1.update(t)
            self.c2.update(zip(s, s[1:], strict=False))
            self.c3.update(zip(s, s[1:], s[2:], strict=False))
        self.n, self.v, d = sum(self.c1.values()), len(self.c1), ngram.DISCOUNT
        self.s2, self.s3 = defaultdict(float), defaultdict(float)
        for (a, _), c in self.c2.items():
            if c > 1:
                self.s2[a] += (c - d) / self.c1[a]
        for (a, b, _), c in self.c3.items():
            if c > 1:
                self.s3[a, b] += (c - d) / self.c2[a, b]

    def p1(self, w):
        return (self.c1[w] + 1) / (self.n + self.v + 1)

    def p2(self, a, w):
        c, low = self.c2[a, w], (1 - self.s2.get(a, 0.0)) * self.p1(w)
        return (c - ngram.DISCOUNT) / self.c1[a] + low if c > 1 else low

    def p3(self, a, b, w):
        c, low = self.c3[a, b, w], (1 - self.s3.get((a, b), 0.0)) * self.p2(b, w)
        return (c - ngram.DISCOUNT) / self.c2[a, b] + low if c > 1 else low

    def score(self, text):
        s = [b"</s>", *tokens(text)]
        return sum(
            math.log10(self.p3(s[i - 2], s[i - 1], s[i]) if i > 1 else self.p2(s[0], s[1])) for i in range(1, len(s))
        )


def tokens(text):
    return [*(text or "").encode().lower().split(), b"</s>"]


class TestNgrams:
    def test_brute_force(self, sample):
        texts = {r["doc_id"]: r["text"] for r in sample.collect()}
        out = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
        model = Reference(t for d, t in texts.items() if not out[d])
        found = ngram.score_documents(sample).collect()
        assert len(found) == len(texts)
        for r in found:
            t = tokens(texts[r["doc_id"]])
            assert r["held_out"] == out[r["doc_id"]]
            assert (r["n_tokens"], r["train_tokens"]) == (len(t), model.n)
            assert r["n_known"] == sum(model.c1[w] > 0 for w in t)
            assert r["base_score"] == pytest.approx(sum(math.log10(model.p1(w)) for w in t))
            assert r["score"] == pytest.approx(model.score(texts[r["doc_id"]]), abs=2.5e-4 * len(t))
        held = [r for r in found if r["held_out"]]
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)

    def test_many_shards_give_the_same(self, sample, monkeypatch):
        one = {r["doc_id"]: r["score"] for r in ngram.score_documents(sample).collect()}
        monkeypatch.setattr(ngram, "SHARD_BYTES", 20_000)
        many = {r["doc_id"]: r["score"] for r in ngram.score_documents(sample).collect()}
        assert many == pytest.approx(one)

    def test_probabilities_of_a_context_sum_to_one(self, spark, frame):
        texts = ["a b a b a c", "a b a b d", "b a b a a"]
        folder = shared_folder(spark, "test-sum")
        trie = ngram.train(frame(list(enumerate(texts))).select("text"), folder)
        words = sorted({w for t in texts for w in t.split()})
        contexts = [["a"], ["b"], ["a", "b"], ["b", "a"], ["d"]]
        import pyarrow as pa

        for context in contexts:
            total = 0.0
            for word in [*words, "never-seen", None]:
                text = " ".join([*context, *([word] if word else [])])
                ((_, _, seq, begins),) = ngram._sequences(pa.array([text]))
                numbers, counts = trie.words(seq)
                # The token after the context is the word, or the end where there is none.
                total += 10 ** trie.score(numbers, counts, begins)[len(context) + 1]
            assert total == pytest.approx(1.0, abs=2e-3)

    def test_odd_rows(self, frame, odd_rows):
        found = ngram.score_documents(frame(odd_rows)).collect()
        assert len(found) == len(odd_rows)
        by_id = {r["doc_id"]: r for r in found}
        assert by_id[1]["n_tokens"] == by_id[2]["n_tokens"] == by_id[3]["n_tokens"] == 1
        assert by_id[9]["n_tokens"] == 60_001
        assert by_id[None]["held_out"] is False

    def test_empty_table(self, frame):
        assert ngram.score_documents(frame([(1, "a")]).limit(0)).count() == 0

    def test_keys_survive_packing(self):
        keys = np.array([5, 6, 300, 2**50], np.uint64)
        assert (ngram._unpacked(ngram._packed(keys, np.uint64(5)), np.uint64(5)) == keys).all()


class FullReference(Reference):
    """The model that lists every n-gram, with discounts from counts of counts."""

    def __init__(self, texts):
        super().__init__(texts)
        self.d2, self.d3 = self.discount(self.c2), self.discount(self.c3)
        self.s2, self.s3 = defaultdict(float), defaultdict(float)
        for (a, _), c in self.c2.items():
            self.s2[a] += (c - self.d2) / self.c1[a]
        for (a, b, _), c in self.c3.items():
            self.s3[a, b] += (c - self.d3) / self.c2[a, b]

    @staticmethod
    def discount(counts):
        of = Counter(counts.values())
        return of[1] / (of[1] + 2 * of[2])

    def p2(self, a, w):
        c, low = self.c2[a, w], (1 - self.s2.get(a, 0.0)) * self.p1(w)
        return (c - self.d2) / self.c1[a] + low if c else low

    def p3(self, a, b, w):
        c, low = self.c3[a, b, w], (1 - self.s3.get((a, b), 0.0)) * self.p2(b, w)
        return (c - self.d3) / self.c2[a, b] + low if c else low


class TestAllNgrams:
    @pytest.mark.parametrize("shard_bytes", [ngram.SHARD_BYTES, 20_000])
    def test_the_query_lists_every_ngram(self, spark, sample, monkeypatch, shard_bytes):
        monkeypatch.setattr(ngram, "SHARD_BYTES", shard_bytes)
        texts = {r["doc_id"]: r["text"] for r in sample.collect()}
        model = FullReference(t for d, t in texts.items() if zlib.crc32(str(d).encode()) % 7 != 2)
        found = op6_lm_scoring(spark, "/root/testdata/sf0.001").collect()
        assert len(found) == len(texts)
        for r in found:
            t = texts[r["doc_id"]]
            assert r["score"] == pytest.approx(model.score(t), abs=2.5e-4 * len(tokens(t)))

    def test_every_distinct_pair_and_triple_has_a_node(self, spark, sample):
        trie = ngram.train(sample.select("text"), shared_folder(spark, "test-all"), listed=1, discount=None)
        model = Reference(r["text"] for r in sample.collect())
        assert [level[-1] for level in trie.levels] == [len(model.c1), len(model.c2), len(model.c3)]


class TestEliasFano:
    @pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 5), (1000, 50), (1000, 10**6), (5000, 2**58), (5, 2**61)])
    def test_access_and_search(self, n, top):
        random = np.random.default_rng(n + 1)
        values = np.sort(random.integers(0, top, n, dtype=np.uint64))
        own = EliasFano.of(EliasFano.arrays(values))
        asked = np.concatenate([values, random.integers(0, top + 10, 300, dtype=np.uint64)])
        first, last = np.zeros(len(asked), np.int64), np.full(len(asked), n)
        found = own.find(asked, first, last)
        if not n:
            assert (found == -1).all()
            return
        assert (own[np.arange(n)] == values).all()
        place = np.searchsorted(values, asked)
        there = (place < n) & (values[np.minimum(place, n - 1)] == asked)
        assert (found == np.where(there, place, -1)).all()

    def test_files(self, spark):
        uri = shared_folder(spark, "test-file") + "/x"
        arrays = {"a": np.arange(5, dtype=np.uint16), "b": np.zeros(0, np.int64), "c": np.arange(3.0)}
        save(uri, arrays, 1)
        found = load(uri)
        assert all((found[k] == arrays[k]).all() and found[k].dtype == arrays[k].dtype for k in arrays)


class TestTokenCounts:
    @pytest.fixture(scope="class")
    def pieces(self):
        return vocabulary(PIECES)

    @pytest.fixture(scope="class")
    def reference(self, pieces):
        tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
        tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement=SPACE, prepend_scheme="always", split=True)
        return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)

    def test_whole_table(self, sample, reference):
        texts = {r["doc_id"]: r["text"] for r in sample.collect()}
        found = token_counts(sample, PIECES).collect()
        assert {r["doc_id"]: r["n_tokens"] for r in found} == {d: reference(t) for d, t in texts.items()}
        assert {r["doc_id"]: r["n_chars"] for r in found} == {d: len(t) for d, t in texts.items()}

    def test_odd_texts(self, pieces, reference):
        counter = TokenCounter(Automaton.of(pieces))
        odd = ["", "a", " ", " a", "a  b ", "▁x▁", "a\nb", "\n\n x", "🙂🙂 é漢字", "<0x0A> <unk>", "a\0b c", "x" * 3000]
        assert counter.texts(odd) == [reference(t) for t in odd]

    def test_ties_go_to_the_longest_last_piece(self):
        """Two segmentations of one score and different length: the tokenizer's choice counts."""
        pieces = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), (SPACE, 0.0)]
        tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
        tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement=SPACE, prepend_scheme="always", split=True)
        counter = TokenCounter(Automaton.of(pieces))
        for text in ["ab", "aba", "abab", "babab", "aab", "bba", "ababa"]:
            assert counter.texts([text]) == [len(tokenizer.encode(text).ids)]

    def test_odd_rows(self, frame, odd_rows):
        found = {r["doc_id"]: r["n_tokens"] for r in token_counts(frame(odd_rows), PIECES).collect()}
        assert found[1] == found[2] == 0 and found[9] > 60_000

    def test_empty_table(self, frame):
        assert token_counts(frame([(1, "a")]).limit(0), PIECES).count() == 0
