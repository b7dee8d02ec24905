"""License scans, WARC archives, the pipeline, and the SQL of the queries."""

from __future__ import annotations

import hashlib
from collections import Counter, Counter as Bag

import duckdb
import pytest

import corpus_pipeline
from fleetlens.llm import licenses, warc
from fleetlens.llm.common import shared_folder
from fleetlens.llm.oracle import SQL
from fleetlens.llm.queries import QUERIES
from llm_helpers import brute_components

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = Bag(tuple(r) for r in df.select(columns).collect())
    result = con.execute(f"select {', '.join(columns)} from ({SQL[name]})").fetchall()
    assert got == Bag(result)


class TestLicenses:
    def test_notices_and_grants(self, frame):
        mit = dict((n, t) for n, t in licenses.TEMPLATES if len(t) > 200 and n == "MIT")["MIT"]
        broken = mit.replace("sublicense", "SUBLICENSE").replace("free of charge", "free of any charge")
        texts = {
            1: "intro words here. Released under the MIT License. more words",
            2: "some code\n" + broken + "\nand more code",
            3: "the MIT people released a license under protest",
            4: None,
            5: "Licensed under the Apache License, Version 2.0. " * 3,
            6: "w " * 5000 + "This work is licensed under the GNU General Public License, version 3." + " w" * 5000,
        }
        found = {(r["doc_id"], r["license"]): r for r in licenses.scan(frame(list(texts.items()))).collect()}
        assert set(found) == {(1, "MIT"), (2, "MIT"), (5, "Apache-2.0"), (6, "GPL-3.0")}
        assert found[1, "MIT"]["containment"] == 1.0
        assert 0.8 <= found[2, "MIT"]["containment"] < 1.0

    def test_half_a_template_is_no_match(self, frame):
        grant = max((t for _, t in licenses.TEMPLATES), key=len)
        half = " ".join(grant.split()[: len(grant.split()) // 2])
        assert licenses.scan(frame([(1, half)])).count() == 0

    def test_bands_miss_little(self):
        assert all(licenses.miss_probability(n) < 1e-6 for n in range(1, 600))

    def test_templates_are_checked(self, spark):
        with pytest.raises(ValueError, match="needs"):
            licenses.template_table(spark, (("x", "too short"),))
        with pytest.raises(ValueError, match="more than"):
            licenses.template_table(spark, (("x", "word " * (licenses.MOST_WORDS + 1)),))

    def test_odd_rows(self, frame, odd_rows):
        rows = [*odd_rows, (None, "Released under the MIT License.")]
        found = [(r["doc_id"], r["license"]) for r in licenses.scan(frame(rows)).collect()]
        assert found == [(None, "MIT")]
        assert licenses.scan(frame(rows).limit(0)).count() == 0

    def test_no_python_in_the_plan(self, sample):
        plan = licenses.scan(sample)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


class TestNeighbouringLicenses:
    GNU = ("GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later")

    def found(self, frame, texts):
        names = {d: set() for d in texts}
        for r in licenses.scan(frame(list(texts.items()))).collect():
            names[r["doc_id"]].add(r["license"])
        return names

    def test_each_gnu_header_is_named_alone(self, frame):
        header = {n: next(t for m, t in licenses.TEMPLATES if m == n) for n in self.GNU}
        texts = {i: f"some words before. {header[n]} and some after" for i, n in enumerate(self.GNU)}
        # Two headers of one text are both named, the third that lies between them is not, and one with a word changed is still its own.
        texts[10] = header["GPL-2.0-or-later"] + " w" * 300 + " " + header["AGPL-3.0-or-later"]
        texts[11] = header["LGPL-3.0-or-later"].replace("redistribute it", "redistribute them")
        wanted = {i: {n} for i, n in enumerate(self.GNU)}
        wanted |= {10: {"GPL-2.0-or-later", "AGPL-3.0-or-later"}, 11: {"LGPL-3.0-or-later"}}
        assert self.found(frame, texts) == wanted

    def test_every_template_names_its_license(self, frame):
        texts = {i: text for i, (_, text) in enumerate(licenses.TEMPLATES)}
        assert self.found(frame, texts) == {i: {name} for i, (name, _) in enumerate(licenses.TEMPLATES)}


class TestWarc:
    def test_pages(self, spark):
        big, small = "é<p>" * 30_000, "tiny"
        rows = [
            (1, "http://a/é b\r\nX: y", None, "x"),
            (2, None, "z" * 100, "x"),
            (2, None, "z" * 100, "x"),
            (7, "u", big, "x"),
            (3, "a", big, "x"),
            (8, "a", big, "x"),
            (None, "b", "q" * 200, "x"),
            (9, "b", "q" * 200, "x"),
            (5, "b", small, "x"),
            (6, "b", small, "x"),
            (10, "b", "", "x"),
        ]
        pages = spark.createDataFrame(rows, "page_id long, url string, html string, type string")
        found = warc.page_records(pages).collect()
        text = {(r[0]): r[2] or "" for r in rows}
        assert Counter(r["page_id"] for r in found) == Counter(r[0] for r in rows)
        for r in found:
            raw = text[r["page_id"]].encode()
            assert r["payload_bytes"] == len(raw)
            assert r["payload_digest"] == hashlib.sha256(raw).hexdigest()
        named = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in found)
        assert named[7, "revisit", 3] == named[8, "revisit", 3] == named[3, "response", None] == 1
        assert named[None, "revisit", 9] == named[9, "response", None] == 1
        assert named[5, "response", None] == named[6, "response", None] == named[10, "response", None] == 1
        assert named[2, "response", None] == named[2, "revisit", 2] == 1

    def test_archives_read_back_whole(self, spark):
        pages = spark.read.parquet(f"{SF}/pages.parquet")
        folder = shared_folder(spark, "test-warc") + "/archives"
        made = warc.write_archives(pages, folder).collect()
        records = warc.read_records(spark, folder)
        assert records.count() == sum(r["records"] for r in made)
        read = {r["page_id"]: r for r in warc.assemble(records).collect()}
        for r in pages.collect():
            assert bytes(read[r["page_id"]]["payload"]).decode() == r["html"]
            assert read[r["page_id"]]["complete"]

    def test_a_lost_segment_is_seen(self, spark):
        page = spark.createDataFrame([(1, "u", "abc" * 20_000)], "page_id long, url string, html string")
        folder = shared_folder(spark, "test-warc") + "/archives"
        warc.write_archives(page, folder)
        records = warc.read_records(spark, folder)
        assert records.count() > 2
        (whole,) = warc.assemble(records).collect()
        assert whole["complete"] and bytes(whole["payload"]) == b"abc" * 20_000
        for lost in ("segment = 2", f"segment = {records.count()}"):
            (broken,) = warc.assemble(records.filter(f"not ({lost})")).collect()
            assert not broken["complete"] and broken["payload"] is None

    def test_chunks(self):
        for payload in (b"", b"a", b"x" * 10_000, b"\r\n0\r\n\r\n" * 900):
            assert warc.unchunked(warc.chunked(payload)) == payload
        for broken in (b"", b"5\r\nabc", b"zz\r\n", b"3\r\nabcX\r\n0\r\n\r\n"):
            assert warc.unchunked(broken) is None
        assert warc.payload_of(b"HTTP/1.1 200 OK\r\n\r\nplain") == b"plain"

    def test_empty_table(self, spark):
        pages = spark.createDataFrame([], "page_id long, url string, html string")
        assert warc.page_records(pages).count() == 0


class TestPipeline:
    @pytest.fixture(scope="class")
    def kept(self, spark):
        """What each stage keeps of the smallest table, stage by stage."""
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        found, folder = [docs], shared_folder(spark, "test-pipeline")
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, found[-1], SF).write.parquet(f"{folder}/{k}")
            found.append(spark.read.parquet(f"{folder}/{k}"))
        return found

    def test_columns(self, kept):
        for df in kept[1:-1]:
            assert df.columns == kept[0].columns
        assert {"doc_id", "sequence_id", "offset", "ids"} <= set(kept[-1].columns)

    def test_stages_against_brute_force(self, kept):
        before = kept[0].select("doc_id", "text").collect()
        named = {r["doc_id"]: r["text"] for r in before if any(c.isalpha() for c in r["text"] or "")}
        assert {r["doc_id"] for r in kept[1].select("doc_id").collect()} == set(named)
        last: dict[str, int] = {}
        for d, t in named.items():
            last[t] = max(d, last.get(t, d))
        single = {d: t for t, d in last.items()}
        assert {r["doc_id"] for r in kept[2].select("doc_id").collect()} == set(single)
        component = brute_components(single, 5, 80)
        assert {r["doc_id"] for r in kept[3].select("doc_id").collect()} == set(component.values())
        mixed = Counter(r["doc_id"] for r in kept[4].select("doc_id").collect())
        assert set(mixed) <= set(component.values()) and max(mixed.values()) <= 2
        packed = kept[5].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
        assert {r["doc_id"]: r["sum(length)"] // r["max(doc_tokens)"] for r in packed} == dict(mixed)

    def test_run(self, spark, kept):
        found = corpus_pipeline.run(spark, SF)
        assert found.columns == kept[-1].columns
        assert found.count() == kept[-1].count()

    def test_odd_rows(self, spark, frame, odd_rows, tmp_path):
        docs = frame(odd_rows)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"file://{tmp_path}/{k}"
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() > 0
        empty = frame(odd_rows).limit(0)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"file://{tmp_path}/empty{k}"
            stage(spark, empty, str(tmp_path)).write.parquet(path)
            empty = spark.read.parquet(path)
        assert empty.count() == 0
