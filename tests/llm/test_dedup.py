"""Exact dedup, near dedup, components, fingerprints."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetlens.llm.common import shared_folder, with_locator
from fleetlens.llm.components import components
from fleetlens.llm.exact_dedup import exact_dedup, land, update_state
from fleetlens.llm.fingerprints import HASHES, edited, fingerprints, similar
from fleetlens.llm.near_dedup import banding, near_duplicates, odd_sketch, sketches
from fleetlens.llm.resolve import within_reach
from fleetlens.llm.text_hash import Minima, band_keys, shingle_hashes, word_hashes
from llm_helpers import brute_components, shingles

def brute_exact(texts):
    groups = defaultdict(list)
    for d, t in texts:
        groups[t or ""].append(d)
    return {t: max(g, key=lambda d: -1 if d is None else d) for t, g in groups.items()}


class TestExact:
    def test_keeps_the_largest(self, frame, odd_rows):
        found = exact_dedup(frame(odd_rows)).select("doc_id", "keep_id", "group_size", "kept").collect()
        assert len(found) == len(odd_rows)
        keep = brute_exact([(d, t) for d, t, *_ in odd_rows])
        text = {d: t or "" for d, t, *_ in odd_rows}
        for r in found:
            assert r["keep_id"] == keep[text[r["doc_id"]]]
        # Null and empty texts are equal; a repeated row stays once.
        kept = [r["doc_id"] for r in found if r["kept"]]
        assert sorted(kept, key=str) == sorted([2, 3, 5, 6, 7, None, 9, 10], key=str)
        assert {r["doc_id"]: r["group_size"] for r in found}[4] == 3

    def test_repeated_rows_keep_one(self, frame):
        found = exact_dedup(frame([(4, "a"), (4, "a"), (4, "a")]))
        assert [r["kept"] for r in found.collect()].count(True) == 1

    def test_digests_that_collide_are_told_apart(self, sample):
        weak = exact_dedup(sample, digest=lambda text: F.unhex(F.substring(F.sha2(text, 256), 1, 2)))
        strong = exact_dedup(sample)
        columns = ["doc_id", "keep_id", "group_size", "kept"]
        assert weak.select(columns).exceptAll(strong.select(columns)).count() == 0
        assert weak.count() == strong.count() == sample.count()

    def test_state_goes_on(self, spark, frame):
        """A second run over more landed rows continues the state of the first; no key has expired."""
        folder = shared_folder(spark, "test-state")
        first = land(with_locator(frame([(1, "a"), (2, "b")]), f"{folder}/x"), f"{folder}/landing/batch=1")
        update_state(spark, f"{folder}/landing/*", first.schema, f"{folder}/state", 2).count()
        land(with_locator(frame([(3, "a"), (4, "c")]), f"{folder}/y"), f"{folder}/landing/batch=2")
        state = update_state(spark, f"{folder}/landing/*", first.schema, f"{folder}/state", 2)
        assert sorted((r["n"], r["keeper"]["doc_id"]) for r in state.collect()) == [(1, 2), (1, 4), (2, 3)]

    def test_empty_table(self, frame):
        assert exact_dedup(frame([(1, "a")]).limit(0)).count() == 0

    def test_no_python_in_the_plan(self, sample):
        plan = exact_dedup(sample)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


class TestHashes:
    def test_words_of_any_cut(self, monkeypatch):
        import fleetlens.llm.text_hash as module

        texts = ["One two  THREE", "", "\n", "four", "a" * 100 + " b " + "c" * 50, "two"]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
        whole = word_hashes(data, offsets)
        monkeypatch.setattr(module, "RUN", 16)
        cut = word_hashes(data, offsets)
        assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
        assert list(np.diff(whole[1])) == [len(t.split()) for t in texts]
        assert whole[0][1] == whole[0][-1]  # "two" twice

    @pytest.mark.parametrize("size", [1, 3, 5])
    def test_shingles_are_equal_exactly_when_words_are(self, size):
        texts = ["a b c d e f", "A B C D E F", "a b", "b a", "", "x a b c d e", "a b c d e"]
        data = np.frombuffer("\n".join(texts).encode(), np.uint8)
        ends = np.cumsum([0] + [len(t) + 1 for t in texts])
        ends[-1] -= 1
        hashes, firsts = shingle_hashes(*word_hashes(data, ends), size)
        sets = [set(hashes[firsts[i] : firsts[i + 1]].tolist()) for i in range(len(texts))]
        plain = [shingles(t, size) for t in texts]
        for i in range(len(texts)):
            assert len(sets[i]) == len(plain[i])
            for j in range(len(texts)):
                assert len(sets[i] & sets[j]) == len(plain[i] & plain[j])

    def test_minima_estimate_jaccard(self):
        random = np.random.default_rng(3)
        pool = random.integers(0, 2**64, 1500, dtype=np.uint64)
        minima = Minima(512)
        a, b = minima.of(pool[:1000]), minima.of(pool[500:])
        assert abs((a == b).mean() - 1 / 3) < 0.08

    def test_banding_misses_little(self):
        for percent in (0.8, 0.85, 0.9):
            bands, size = banding(percent)
            assert (1 - percent**size) ** bands <= 1e-6 and bands * size <= 200


class TestComponents:
    @pytest.mark.parametrize("seed", [1, 2])
    def test_random_graph(self, spark, seed):
        random = np.random.default_rng(seed)
        links = [(int(a), int(b)) for a, b in random.integers(0, 60, (45, 2))]
        links += [(100 + i, 101 + i) for i in range(30)]  # a chain
        links += [(500, 501 + i) for i in range(40)]  # a hub
        found = components(spark.createDataFrame(links, "u long, v long"), shared_folder(spark, "test-components"))
        parent = {x: x for pair in links for x in pair}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
        wanted = {x: root(x) for a, b in links if a != b for x in (a, b)}
        rows = found.collect()
        assert len(rows) == len(wanted)
        assert {r["node"]: r["component"] for r in rows} == wanted

    def test_stars_take_one_step_and_few_tasks(self, spark):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
        folder = shared_folder(spark, "test-stars")
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        spark.conf.set(coalesce, "false")
        try:
            links = [(k - k % 10, k) for k in range(300)]
            rows = components(spark.createDataFrame(links, "u long, v long"), folder).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.unset(coalesce)
        assert {r["node"]: r["component"] for r in rows} == {v: u for u, v in links}
        made = {p.parent.name: 0 for p in Path(folder.removeprefix("file://")).rglob("part-*.parquet")}
        for p in Path(folder.removeprefix("file://")).rglob("part-*.parquet"):
            made[p.parent.name] += 1
        assert not any(name.startswith("step2") for name in made)
        assert all(n <= spark.sparkContext.defaultParallelism for name, n in made.items() if name != "edges")

    def test_no_links(self, spark):
        assert components(spark.createDataFrame([(1, 1)], "u long, v long"), shared_folder(spark, "t")).count() == 0


def _near_texts():
    """Copies, chains of small edits, texts that share a passage only."""
    random = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    base = list(random.choice(words, 120))
    texts, n = {}, 0
    for _ in range(12):  # edits of one base
        n += 1
        edit = list(base)
        edit[int(random.integers(0, 120))] = f"e{n}"
        texts[n] = " ".join(edit)
    chain = list(random.choice(words, 100))
    for k in range(14):  # each near the one before, the ends far apart
        chain[k * 7] = f"c{k}"
        texts[100 + k] = " ".join(chain)
    passage = " ".join(random.choice(words, 60))
    for k in range(10):  # a shared passage is no near copy
        texts[200 + k] = passage + " " + " ".join(random.choice(words, 60))
    for k in range(6):
        texts[300 + k] = "same text for all of these, word for word"
    texts[400], texts[401], texts[402], texts[403] = "", None, "a b", "A b"
    return texts


class TestNear:
    @pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
    def test_brute_force(self, frame, size, percent):
        texts = _near_texts()
        found = near_duplicates(frame(list(texts.items())), size, percent).collect()
        wanted = brute_components(texts, size, percent)
        assert {r["doc_id"]: r["component_id"] for r in found} == wanted
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
        assert {r["doc_id"]: r["n_shingles"] for r in found} == {d: len(shingles(t, size)) for d, t in texts.items()}

    def test_odd_sketches_differ_no_more_than_sets(self):
        random = np.random.default_rng(8)
        pool = random.integers(0, 2**64, 9000, dtype=np.uint64)
        for _ in range(50):
            a, b = (np.unique(random.choice(pool, random.integers(1, 9000))) for _ in range(2))
            x, y = odd_sketch(a).view(np.uint64), odd_sketch(b).view(np.uint64)
            if len(x) != len(y):
                x, y = sorted((x, y), key=len)
                y = y[: len(x)] ^ y[len(x) :]
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))

    def test_reach_of_sets_of_any_length(self, spark):
        """The bound lets every pair at the threshold through, also where one sketch is twice as long."""
        random = np.random.default_rng(9)
        rows, near = [], []
        for n in (50, 4000, 4200, 9000):
            pool = np.unique(random.integers(0, 2**64, 2 * n, dtype=np.uint64))
            a = np.sort(pool[:n])
            for b in (np.sort(pool[: int(n * 0.81)]), np.sort(pool[: int(n * 1.2)]), np.sort(pool[n // 2 : n // 2 + n])):
                both = len(np.intersect1d(a, b))
                rows.append((len(rows), n, odd_sketch(a).tolist(), len(b), odd_sketch(b).tolist()))
                near.append(100 * both >= 80 * (n + len(b) - both))
        df = spark.createDataFrame(rows, "i int, n_a long, odd_a array<long>, n_b long, odd_b array<long>")
        reached = [r[0] for r in df.orderBy("i").select(within_reach(80)).collect()]
        assert reached == near

    def test_centre_beyond_the_threshold(self, frame):
        """Edits of one text by a word or two, all pairs just around the threshold, whatever the least one is."""
        random = np.random.default_rng(1)
        base = [f"w{i}" for i in range(90)]
        texts = {}
        for k in range(150):
            edit = list(base)
            for at in random.choice(90, 1 + (k % 40 == 0), replace=False):
                edit[int(at)] = f"e{k}"
            texts[k] = " ".join(edit)
        found = near_duplicates(frame(list(texts.items()))).collect()
        assert {r["doc_id"]: r["component_id"] for r in found} == brute_components(texts, 5, 80)

    def test_rows_of_one_id_are_one_node(self, frame):
        x = [f"x{i}" for i in range(100)]
        rows = [(1, " ".join(x[:99] + ["z"])), (5, " ".join(x)), (5, "other text of its own"), (3, "other text of its own")]
        rows += [(8, "one"), (8, "two"), (9, "two"), (8, None)]
        found = near_duplicates(frame(rows)).select("doc_id", "component_id").collect()
        assert sorted(map(tuple, found)) == [(1, 1), (3, 1), (5, 1), (5, 1), (8, 8), (8, 8), (8, 8), (9, 8)]

    def test_odd_rows(self, frame, odd_rows):
        found = near_duplicates(frame(odd_rows)).collect()
        assert len(found) == len(odd_rows)
        component = {r["doc_id"]: r["component_id"] for r in found}
        assert component == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, None: None, 9: 9, 10: 10}
        assert [r["kept"] for r in found if r["doc_id"] is None] == [True]

    def test_empty_table(self, frame):
        assert near_duplicates(frame([(1, "a")]).limit(0)).count() == 0


class TestFingerprints:
    def test_brute_force(self, sample):
        rows = sorted((r["doc_id"], r["text"]) for r in sample.select("doc_id", "text").collect())
        found = {r["doc_id"]: r for r in fingerprints(sample).collect()}
        assert len(found) == len(rows)
        off = []
        for i, (doc_id, text) in enumerate(rows):
            following = rows[(i + 1) % len(rows)][1]
            new = edited(text, following)
            r = found[doc_id]
            assert r["n_chars"] == len(text)
            assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
            for a, b, near in ((text, new, r["near_edited"]), (text, following, r["near_next"])):
                x, y = shingles(a, 5), shingles(b, 5)
                off.append(near - (len(x & y) / len(x | y) if x | y else 1.0))
        assert np.abs(off).max() < 0.25 and abs(np.mean(off)) < 0.01

    def test_equal_texts_have_equal_fingerprints(self, frame, odd_rows):
        found = fingerprints(frame(odd_rows)).collect()
        assert len(found) == len(odd_rows)
        by_id = {r["doc_id"]: r for r in found}
        assert by_id[4]["fingerprint"] == by_id[5]["fingerprint"] != by_id[6]["fingerprint"]
        assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == "f" * 1024
        assert by_id[1]["near_next"] == 1.0  # null and empty
        assert by_id[10]["n_chars"] == 1

    def test_edit_takes_what_there_is(self):
        assert edited("abcdef", "xy") == "abcxy"
        assert edited("abcde", "vwxyz") == "abcvw"
        assert edited("", "x") == "" and edited("a", "x") == "a"

    def test_one_document_follows_itself(self, frame):
        assert [r["near_next"] for r in fingerprints(frame([(1, "a b")])).collect()] == [1.0]

    def test_empty_table(self, frame):
        assert fingerprints(frame([(1, "a")]).limit(0)).count() == 0

    def test_bands_are_cut_from_the_printed_fingerprint(self, frame):
        docs = frame([(1, "one two three four five six seven"), (2, "a b"), (3, "one two three four five six")])
        bands, rows = banding(0.8, most=HASHES)
        assert (1 - 0.8**rows) ** bands <= 1e-6 and bands * rows <= HASHES
        printed = {r["doc_id"]: r["fingerprint"] for r in fingerprints(docs).collect()}
        for row in sketches(docs, 5, bands, rows, HASHES).collect():
            low = np.frombuffer(bytes.fromhex(printed[row.doc_id]), ">u4").astype(np.uint32)
            assert row.signature == low.tobytes()
            assert row.bands == list(band_keys(low[: bands * rows], bands))

    def test_similar_links_hold(self, frame):
        texts = _near_texts()
        links = {(r["u"], r["v"]) for r in similar(frame(list(texts.items())), size=5).collect()}
        for a, b in links:
            x, y = shingles(texts[a], 5), shingles(texts[b], 5)
            assert 100 * len(x & y) >= 80 * len(x | y)
        assert {(300, 300 + k) for k in range(1, 6)} <= links


def _strays():
    """Near copies 200 and 201; in each band they share lies one of 1 to 100, which are too far from both."""
    random = np.random.default_rng(11)
    base = list(random.choice([f"w{i}" for i in range(300)], 200))
    texts = {200: " ".join(base), 201: " ".join([*base[:-1], "end"])}
    for k in range(100):
        edit = list(base)
        for at in range(k % 28, 200, 28):
            edit[at] = f"s{k}-{at}"
        texts[1 + k] = " ".join(edit)
    return texts


class TestGroups:
    def test_links_join_all_that_brute_force_joins(self, frame):
        texts = _near_texts() | {d + 1000: t for d, t in _strays().items()}
        wanted = brute_components(texts, 5, 80)
        assert wanted[1201] == 1200 and wanted[1001] == 1001
        links = [(r["u"], r["v"]) for r in similar(frame(list(texts.items()))).collect()]
        root = {d: d for d in texts}
        for _ in texts:
            for u, v in links:
                root[u] = root[v] = min(root[u], root[v])
        assert root == wanted
        assert len(set(links)) == len(links) and all(u < v for u, v in links)

    def test_the_query_names_groups(self, frame):
        texts = _near_texts() | {d + 1000: t for d, t in _strays().items()}
        docs = frame([*texts.items(), (None, texts[1])])
        links = [(r["u"], r["v"]) for r in similar(docs).collect()]
        found = fingerprints(docs).collect()
        assert len(found) == len(texts) + 1
        known = {r["doc_id"]: (r["group_id"], r["n_links"]) for r in found}
        assert known.pop(None) == (None, 0)
        assert {d: group for d, (group, _) in known.items()} == brute_components(texts, 5, 80)
        assert {d: n for d, (_, n) in known.items()} == {d: sum(d in pair for pair in links) for d in texts}

    def test_rows_of_one_id_share_a_group(self, frame):
        a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
        found = fingerprints(frame([(1, a), (5, a), (5, b), (9, b), (9, b), (12, "c")])).collect()
        assert sorted((r["doc_id"], r["group_id"]) for r in found) == [(1, 1), (5, 1), (5, 1), (9, 1), (9, 1), (12, 12)]


def test_text_sets_of_null_and_sliced_columns():
    from fleetlens.llm.near_dedup import text_sets

    column = pa.array(["skip", "a b c", None, "a b c"]).slice(1)
    a, none, b = text_sets(column, 3)
    assert (a == b).all() and len(none) == 0
