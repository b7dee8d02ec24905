"""Mixing sources and packing windows."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fleetlens.llm.mixing import mix_sources, mixed
from fleetlens.llm.packing import WINDOW, WordEncoder, pack, phases, sequences

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def filled(sizes, weights, share=1.5, cap=2):
    """Targets by sharing again and again until no source is above its cap."""
    pool, open_, target = share * sum(sizes.values()), dict(weights), {}
    while True:
        level = {s: pool * w / sum(open_.values()) for s, w in open_.items()}
        above = [s for s in level if level[s] >= cap * sizes[s]]
        if not above:
            return target | level
        for s in above:
            target[s] = cap * sizes[s]
            pool -= cap * sizes[s]
            del open_[s]
        if not open_:
            return target


class TestMix:
    def test_targets_and_words(self, sample):
        found = mix_sources(sample).collect()
        sizes, taken, target = defaultdict(int), defaultdict(int), {}
        for r in found:
            sizes[r["source"]] += r["size"]
            taken[r["source"]] += r["taken"]
            target[r["source"]] = r["target"]
            assert r["taken"] in (0, r["size"], 2 * r["size"])
        order = sorted(sizes)
        wanted = filled(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
        largest = max(r["size"] for r in found)
        for s in order:
            assert target[s] == pytest.approx(wanted[s])
            assert abs(taken[s] - wanted[s]) <= largest / 2
        assert len(found) == sample.count()

    def test_whole_copies_are_certain(self, sample):
        for r in mix_sources(sample).collect():
            assert r["copies"] >= int(r["target"] / r["source_size"])

    def test_reruns_agree(self, sample):
        a = mix_sources(sample)
        b = mix_sources(sample.repartition(5))
        columns = ["doc_id", "taken", "target"]
        assert a.select(columns).exceptAll(b.select(columns)).count() == 0

    def test_mixed_repeats_documents(self, sample):
        copies = {r["doc_id"]: r["copies"] for r in mix_sources(sample).collect()}
        drawn = defaultdict(int)
        out = mixed(sample)
        assert out.columns == sample.columns
        for r in out.select("doc_id").collect():
            drawn[r["doc_id"]] += 1
        assert dict(drawn) == {d: c for d, c in copies.items() if c}

    def test_odd_rows(self, frame, odd_rows):
        found = mix_sources(frame(odd_rows)).collect()
        assert len(found) == len(odd_rows)
        by_id = {r["doc_id"]: r for r in found}
        assert by_id[1]["size"] == by_id[2]["size"] == by_id[3]["size"] == 0
        assert {by_id[1]["taken"], by_id[3]["taken"]} == {0}
        assert by_id[9]["size"] == 60_000
        # The null source comes last: the fourth source weighs 5 again and is stopped at twice its words.
        assert by_id[5]["target"] == 2.0 * by_id[5]["source_size"]

    def test_empty_table(self, frame):
        assert mix_sources(frame([(1, "a")]).limit(0)).count() == 0

    def test_no_python_in_the_plan(self, sample):
        plan = mix_sources(sample)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


def check_packing(texts, pieces):
    """Every id lies in exactly one piece, every sequence is gapless and full or a power of two."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = {
        d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in texts.items()
    }
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(want)
    for d, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(want[d])
            assert p["ids_crc32"] == zlib.crc32(want[d][at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(want[d])
    lengths = []
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= WINDOW and (at == WINDOW or at & (at - 1) == 0)
        lengths.append(at)
    return lengths


class TestWordEncoder:
    """The ids made word by word are those of the whole text."""

    def test_words_of_all_kinds(self):
        random = np.random.default_rng(11)
        pool = [chr(c) for c in range(33, 0x600) if chr(c).isprintable()]
        pool += ["한글", "中文", "½", "e\u0301", "\u0345", "ﬁ", "K", "'s", "'RE", "<|endoftext|>"]
        letters = [c for c in pool if c.isalpha()]
        tails = ["", "", ".", ",###", "***", "'s", "…"]

        def word():
            kind = (letters, [*letters, ".", "7"], pool)[random.integers(3)]
            return "".join(random.choice(kind, random.integers(1, 9))) + str(random.choice(tails))

        texts = [" ".join(word() for _ in range(random.integers(0, 9))) for _ in range(1500)]
        texts += ["", " ", "İ.", "aİ. İ", "ΣΑΣ ΟΔΟΣ.", "é. É", "e\u0301.", "a\u0301\u0327!", "K. Å!", "Hello <|endoftext|> World É."]
        encoder, tokenizer = WordEncoder(TOKENIZER, 2), Tokenizer.from_file(TOKENIZER)
        assert encoder.direct
        for text, made in zip(texts, encoder.texts([t.encode() for t in texts]), strict=True):
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(made, encoder.kind).tolist() == [*ids, 2], text


class TestPack:
    def test_windows_hold_the_proportions(self, sample):
        texts = {r["doc_id"]: r["text"] for r in sample.collect()}
        source = {r["doc_id"]: r["source"] for r in sample.collect()}
        pieces = pack(sample, TOKENIZER, 2).collect()
        lengths = check_packing(texts, pieces)
        assert sum(x < WINDOW for x in lengths) <= 12
        total, window = defaultdict(int), defaultdict(lambda: defaultdict(int))
        for p in pieces:
            total[source[p["doc_id"]]] += p["length"]
            window[p["sequence_id"]][source[p["doc_id"]]] += p["length"]
        everything = sum(total.values())
        for k in range(everything // WINDOW):
            for s, n in total.items():
                assert abs(window[k][s] - WINDOW * n / everything) < 2

    def test_targets(self, sample):
        texts = {r["doc_id"]: r["text"] for r in sample.collect()}
        source = {r["doc_id"]: r["source"] for r in sample.collect()}
        pieces = pack(sample, TOKENIZER, 2, targets={"src1": 3.0, "src2": 1.0}).collect()
        check_packing(texts, pieces)
        first = [p for p in pieces if p["sequence_id"] == 0]
        share = sum(p["length"] for p in first if source[p["doc_id"]] == "src1") / WINDOW
        assert abs(share - 0.75) < 0.01

    def test_many_small_sources(self, spark, sample):
        from pyspark.sql import functions as F

        rows = sample.withColumn("source", F.concat(F.lit("s"), F.col("doc_id")))
        texts = {r["doc_id"]: r["text"] for r in sample.collect()}
        check_packing(texts, pack(rows, TOKENIZER, 2).collect())

    def test_odd_rows(self, frame):
        texts = {1: None, 2: "", 3: "Hello, world! It's café <|endoftext|>", None: "x", 5: "a " * 9000}
        pieces = pack(frame([(d, t, None, "s" if d == 3 else None) for d, t in texts.items()]), TOKENIZER, 2)
        check_packing(texts, pieces.collect())

    def test_repeated_rows_are_packed_each(self, frame):
        pieces = pack(frame([(1, "a b"), (1, "a b")]), TOKENIZER, 2).collect()
        assert sum(p["length"] for p in pieces) == 6

    def test_sequences(self, sample):
        built = sequences(pack(sample, TOKENIZER, 2, with_ids=True)).collect()
        assert len({r["sequence_id"] for r in built}) == len(built)
        assert {len(r["ids"]) // 2 for r in built} <= {1 << k for k in range(13)}

    def test_empty_table(self, frame):
        assert pack(frame([(1, "a")]).limit(0), TOKENIZER, 2).count() == 0

    @pytest.mark.parametrize("weights", [None, [1.0, 1.0, 5.0], [1e-9, 2.0, 3.0]])
    def test_phases_hand_out_every_token_once(self, weights):
        lengths = [50_000, 3, 12_345]
        if weights is None:
            lengths = [50_000, 4_000, 12_345]
        plan = phases(lengths, weights)
        served = [0] * len(lengths)
        for phase in plan:
            for s, n in enumerate(phase.length):
                assert phase.start[s] == served[s] or not n
                served[s] += n
                cuts = [p for p, _, _ in phase.parts(s, 0, n)]
                assert cuts == sorted(set(cuts)) and (not n or cuts[0] == 0)
        assert served == lengths
