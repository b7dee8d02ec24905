"""Periodic runs, ranked search, shingle join: against brute force (their SQL is compared with that of the other queries)."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import search as ranked
from fleetlens.llm.part_enum import Signer, combined, first_parts, most_apart, shingle_join, size_bands
from fleetlens.llm.runs import Extensions, difference_cover, digests, numbered, periodic_runs, repeated_tail, runs
from llm_helpers import LOWER, brute_components, shingles


def brute_runs(words, least=24, times=3):
    n, best = len(words), {}
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, times * p) and j > i:
                best.setdefault((i, j + p), p)
            i = max(j, i + 1) if j == i else j + 1
    return sorted((s, e - s, p) for (s, e), p in best.items())


class TestRuns:
    @pytest.mark.parametrize("side", [2, 3, 5, 8])
    def test_cover_has_every_difference(self, side):
        cover, start = difference_cover(side)
        held = set(cover.tolist())
        assert all(int(a) in held and (int(a) + d) % side**2 in held for d, a in enumerate(start))

    @pytest.mark.parametrize("side", [2, 3, 5])
    def test_extensions(self, side):
        random = np.random.default_rng(side)
        for k in range(40):
            n = int(random.integers(2, 300))
            words = np.tile(random.integers(0, 3, 7), 60)[:n] if k % 2 else random.integers(0, 2, n)
            i, j = np.sort(random.integers(0, n + 1, (2, 200)), axis=0)
            i, j = i[i < j], j[i < j]
            for a, b, found in zip(i, j, Extensions(words, side).of(i, j), strict=True):
                plain = 0
                while b + plain < n and words[a + plain] == words[b + plain]:
                    plain += 1
                assert plain == found

    def test_runs_against_brute_force(self):
        random = np.random.default_rng(3)
        total = 0
        for _ in range(400):
            n = int(random.integers(0, 220))
            words = random.integers(0, int(random.integers(1, 6)), n)
            for _ in range(int(random.integers(0, 4))):
                start, period = int(random.integers(0, max(1, n - 10))), int(random.integers(1, 25))
                for i in range(start + period, min(n, start + int(random.integers(10, 120)))):
                    words[i] = words[i - period]
            found = [tuple(r) for r in runs(words).tolist()]
            assert found == brute_runs(words.tolist())
            total += len(found)
        assert total > 200

    def test_long_texts_in_blocks(self, monkeypatch):
        import fleetlens.llm.runs as module

        random = np.random.default_rng(4)
        words = random.integers(0, 50, 3000)
        words[500:1900] = np.tile(words[500:639], 11)[:1400]
        words[2000:2100] = words[2000]
        whole = runs(words).tolist()
        monkeypatch.setattr(module, "TABLE_WORDS", 100)
        monkeypatch.setattr(module, "BLOCK", 64)
        assert runs(words).tolist() == whole and len(whole) == 2

    def test_columns(self, frame):
        """Ties go to the smaller start; a run's first period stays; the digests are those of the contract."""
        text = "x " + "a b " * 12 + "y " + "c d " * 12 + "Z z"
        found = digests(periodic_runs(frame([(1, text), (2, None), (3, " \n"), (None, "a " * 30), (1, text)])))
        rows = sorted((r.asDict() for r in found.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
        one = rows[0]
        assert rows[0] == rows[1]
        assert (one["n_runs"], one["start"], one["length"], one["period"], one["exponent_milli"]) == (2, 1, 24, 2, 12000)
        assert one["runs_sha256"] == hashlib.sha256(b"1,24,2\n26,24,2\n").hexdigest()
        assert one["collapsed_sha256"] == hashlib.sha256(b"x a b y c d Z z").hexdigest()
        nothing = hashlib.sha256(b"").hexdigest()
        for empty in rows[2:4]:
            assert empty["n_runs"] == 0 and empty["start"] is None and empty["exponent_milli"] is None
            assert empty["runs_sha256"] == empty["collapsed_sha256"] == nothing
        assert (rows[4]["n_runs"], rows[4]["length"], rows[4]["period"]) == (1, 30, 1)

    def test_repeated_tail(self, frame):
        words = [f"w{i}" for i in range(200)]
        bent = 0
        rows = [(d, " ".join(words)) for d in range(60)]
        found = {r.doc_id: r for r in periodic_runs(frame(rows), F.crc32(F.col("doc_id").cast("string"))).collect()}
        for d, _ in rows:
            h = zlib.crc32(str(d).encode())
            text = list(words)
            if (shape := repeated_tail(h, 200)) is not None:
                a, p = shape
                assert (a, p) == ((h // 10) % 200, 1 + (200 - (h // 10) % 200) // (3 + (h // 10) % 8))
                text = [words[i] if i < a else words[a + (i - a) % p] for i in range(200)]
                bent += 1
            wanted = brute_runs(numbered([w.encode() for w in text]).tolist())
            assert [(r.start, r.length, r.period) for r in found[d].runs] == wanted
        assert bent > 2

    def test_odd_rows(self, frame, odd_rows):
        assert periodic_runs(frame(odd_rows)).count() == len(odd_rows)
        assert periodic_runs(frame(odd_rows).limit(0)).count() == 0


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, queries, top):
    held = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    held = [(d, Counter(ts), len(ts)) for d, ts in held if ts]
    n_docs, all_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    found = []
    for item, text in queries:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for d, counts, n in held:
            m = 75 + (25 * n * n_docs) // all_terms
            score = sum(
                k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m))
                for t, k in asked.items()
                if t in counts
            )
            if score > 0:
                scores.append((-score, d is None, d))
        found += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return Counter(found)


class TestSearch:
    def test_terms(self):
        text = "Über-Ärger\x85x İ_Ab1\x00C\x7fd ²³ 漢字,é z"
        assert [t.decode() for t in ranked.terms(text)] == TERM.findall(text.translate(LOWER))
        assert ranked.terms(None) == [] == ranked.terms("-, \n")

    def _found(self, spark, frame, docs, queries, top, **kinds):
        asked = spark.createDataFrame(queries, "item_id long, text string").withColumn("doc_id", F.lit(9))
        return Counter(tuple(r) for r in ranked.search(frame(docs), asked, top).collect())

    def test_brute_force(self, spark, frame):
        """Ties, copies, counts over all levels, null and repeated identifiers, queries without terms."""
        random = np.random.default_rng(1)
        words = [f"t{i}" for i in range(60)] + ["é", "Ab"]
        weights = 1 / np.arange(1, 63)
        docs = []
        for d in range(150):
            n = int(random.integers(0, 400 if d % 10 == 0 else 40))
            docs.append((d, " ".join(random.choice(words, n, p=weights / weights.sum()))))
        docs += [(500 + d, docs[3][1]) for d in range(30)] + [(7, "t1 t2"), (None, "t1 t50"), (None, "t50"), (900, None), (901, "--")]
        queries = [(i, " ".join(random.choice(words, int(random.integers(1, 12))))) for i in range(12)]
        queries += [(50, None), (51, ""), (52, "nowhere to be"), (53, "t1 t1 t1 T50"), (53, "t1"), (None, "é ab")]
        for top in (3, 20):
            assert self._found(spark, frame, docs, queries, top) == brute_search(docs, queries, top)

    def test_queries_in_groups(self, spark, frame, monkeypatch):
        monkeypatch.setattr(ranked, "GROUP_BYTES", 8)
        docs = [(i, f"a{i % 3} b{i % 5} c{i}") for i in range(30)]
        queries = [(i, f"a{i} b{i} c{i}") for i in range(6)]
        assert self._found(spark, frame, docs, queries, 5) == brute_search(docs, queries, 5)

    def test_bounds_hold(self):
        """No document's bound is below its score, whatever the signatures add."""
        random = np.random.default_rng(2)
        docs = [" ".join(random.choice([f"w{i}" for i in range(40)], int(random.integers(1, 300)))) for _ in range(60)]
        held = [Counter(ranked.terms(t)) for t in docs]
        rows = [(i, sum(c.values()), "f", i, ranked._document_keys(c)) for i, c in enumerate(held)]
        df = Counter(t for c in held for t in c)
        weights = {t: ranked.weight(60, n) for t, n in df.items()}
        group = ranked._Group([[b"w1", b"w2", b"w2"], [b"w39", b"x"], []], weights, 60, sum(sum(c.values()) for c in held))
        close = []
        for ids, lengths, _, _, width, slices in ranked._blocks(rows):
            bounds = group.bounds(np.array(lengths), width, slices)
            for at, i in enumerate(ids):
                for q, score in group.exact(docs[i], [0, 1, 2]):
                    assert bounds[q, at] >= score
                    close.append((bounds[q, at] + 1) / (score + 1) < 1.2)
        assert np.mean(close) > 0.9

    def test_empty_tables(self, spark, frame):
        assert self._found(spark, frame, [(1, None)], [(1, "a")], 20) == Counter()
        none = spark.createDataFrame([], "item_id long, text string")
        found = ranked.search(frame([(1, "a")]), none)
        assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]


class TestJoin:
    def test_parameters(self):
        starts = size_bands(85, 1000)
        for a in range(1, 800):
            own = max(i for i, s in enumerate(starts) if s <= a)
            largest = a * 100 // 85
            assert max(i for i, s in enumerate(starts) if s <= largest) <= own + 1
        for k in range(50):
            assert first_parts(k) * 2 > k
        assert most_apart(100, 85) == 16

    @pytest.mark.parametrize("percent", [60, 85, 95])
    def test_near_sets_share_a_signature(self, percent):
        random = np.random.default_rng(percent)
        signer, near, shared = Signer(percent), 0, 0
        for _ in range(600):
            n = int(random.integers(1, 400))
            pool = np.unique(random.integers(0, 2**64, 2 * n + 5, dtype=np.uint64))
            random.shuffle(pool)
            drop, add = random.integers(0, max(2, n * (100 - percent) // 100 + 1), 2)
            a, b = np.sort(pool[:n]), np.sort(np.r_[pool[drop:n], pool[n : n + add]])
            both = len(np.intersect1d(a, b))
            meets = len(b) > 0 and len(np.intersect1d(signer.of(a), signer.of(b))) > 0
            if len(b) and 100 * both >= percent * (n + len(b) - both):
                near += 1
                assert meets
            if n > 50:
                shared += len(np.intersect1d(signer.of(a), signer.of(np.sort(pool[n : 2 * n])))) > 0
        assert near > 100
        # At a low threshold the parts are small, and sets without a common shingle meet in empty ones.
        assert shared < 20 or percent < 85

    def test_combined(self):
        band, node, least, only = combined(np.array([5, 3, 5, 5, 9]), np.array([7, 1, 2, 7, 4]))
        assert band.tolist() == [3, 5, 5, 9] and node.tolist() == [1, 2, 7, 4]
        assert least.tolist() == [1, 2, 2, 4] and only.tolist() == [True, False, False, True]

    @pytest.mark.parametrize(("size", "percent"), [(4, 85), (2, 60)])
    def test_brute_force(self, frame, size, percent):
        random = np.random.default_rng(7)
        words = [f"w{i}" for i in range(300)]
        texts, base = {}, list(random.choice(words, 150))
        for k in range(12):  # edits of one text
            edit = list(base)
            edit[int(random.integers(0, 150))] = f"e{k}"
            texts[k + 1] = " ".join(edit)
        chain = list(random.choice(words, 100))
        for k in range(12):  # each near the one before, the ends far apart
            chain[k * 8] = f"c{k}"
            texts[100 + k] = " ".join(chain)
        passage = " ".join(random.choice(words, 60))
        for k in range(8):  # a shared passage is no near copy
            texts[200 + k] = passage + " " + " ".join(random.choice(words, 60))
        for k in range(8):  # one is the beginning of the next
            texts[300 + k] = " ".join(words[: 8 + k])
        texts |= {400: "", 401: None, 402: "a b", 403: "A b", 404: " x", 405: "X"}
        found = shingle_join(frame(list(texts.items())), size, percent).collect()
        assert {r.doc_id: r.component_id for r in found} == brute_components(texts, size, percent)
        assert {r.doc_id: r.n_shingles for r in found} == {d: len(shingles(t, size)) for d, t in texts.items()}

    def test_odd_rows(self, frame, odd_rows):
        found = shingle_join(frame(odd_rows)).collect()
        assert len(found) == len(odd_rows)
        assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, None: None, 9: 9, 10: 10}

    def test_rows_of_one_id_are_one_node(self, frame):
        x = [f"x{i}" for i in range(100)]
        rows = [(1, " ".join(x[:99] + ["z"])), (5, " ".join(x)), (5, "other text of its own"), (3, "other text of its own")]
        found = shingle_join(frame(rows)).select("doc_id", "component_id").collect()
        assert sorted(map(tuple, found)) == [(1, 1), (3, 1), (5, 1), (5, 1)]

    def test_empty_table(self, frame):
        assert shingle_join(frame([(1, "a")]).limit(0)).count() == 0
