"""Jobs over tables of lines and other tables that no task sees whole."""

import datetime
import fnmatch
import random
import re

import pytest
from pyspark.sql import functions as F

from fleetlens.functions.globs import glob
from fleetlens.operators import logs, paging, redact, select, status
from fleetlens.operators.asof import as_of
from fleetlens.operators.carry import carry_down
from fleetlens.operators.inventory import inventory_changes
from fleetlens.operators.reports import report_lines
from fleetlens.sources.settings import parse_section, parse_section_of_lines, read_large_settings, read_settings
from fleetlens.streaming.runs import EVENT, run_outcome_stream
from helpers import plan_of


class TestCarry:
    @pytest.mark.parametrize("levels", [0, 2])
    def test_brute_force(self, spark, levels):
        rng = random.Random(levels)
        data, want = [], {}
        for file in ("a", "b", None):
            last = None
            for number in sorted(rng.sample(range(2000), 120)):
                head = f"{file}{number}" if rng.random() < 0.05 else None
                last = head or last
                data.append((file, number, head, "text"))
                want[file, number] = last
        rng.shuffle(data)
        rows = spark.createDataFrame(data, "file string, line_no long, head string, line string")
        found = carry_down(rows, F.col("head"), ["file"], "line_no", "under", block=4, levels=levels)
        assert found.columns == [*rows.columns, "under"]
        assert {(r.file, r.line_no): r.under for r in found.collect()} == want

    def test_one_header_over_all_lines(self, spark):
        rows = spark.range(5000).select(F.lit("f").alias("file"), F.col("id").alias("line_no"))
        found = carry_down(rows, F.when(F.col("line_no") == 7, "h"), ["file"], "line_no", "under")
        assert found.groupBy("under").count().orderBy("under").collect() == [(None, 7), ("h", 4993)]

    def test_no_window_over_lines(self, rows):
        lines = rows("file string, line_no long, line string", ("f", 1, "[a]"))
        plan = plan_of(carry_down(lines, F.col("line"), ["file"], "line_no", "under"))
        for spec in re.findall(r"Window \[.*", plan):
            assert "_block" in spec and "line#" not in spec and "line_no" not in spec

    def test_empty(self, rows):
        empty = rows("file string, line_no long, line string", ("f", 1, "x")).limit(0)
        assert carry_down(empty, F.col("line"), ["file"], "line_no", "under").count() == 0


FILES = [
    ("one", "stray = 1\n[Tool]\na = 1\n  more\n\n  still\n# c\n  after\nB: two\nbare\n[Other]\na = no\n[DEFAULT]\nz=9\n[Tool]\na = 2\n"),
    ("two", "[Tool]\n  a = indented\n  next\nb=\n[DEFAULT]\n; x\n\nc : d = e\n"),
    ("three", "nothing here\n"),
    ("four", ""),
]


class TestSettingsOfLines:
    def test_equal_to_whole_files(self, spark):
        files = spark.createDataFrame(FILES, "file string, text string")
        lines = report_lines(files)
        order = ["file", "seq", "key", "value", "from_default"]
        whole, cut = parse_section(files, "Tool"), parse_section_of_lines(lines, "Tool")
        assert cut.columns == order == whole.columns

        def entries(df):
            return [(r.file, r.key, r.value, r.from_default) for r in df.orderBy("file", "seq").collect()]

        assert entries(cut) == entries(whole)
        assert len(entries(cut)) == 8

    def test_files_cut_into_blocks(self, spark, tmp_path):
        folder = tmp_path / "tool.conf.d"
        folder.mkdir()
        body = "".join(f"key{i} = value {i}\n  more {i}\n" for i in range(400))
        (tmp_path / "tool.conf").write_text(f"[Other]\nkey0 = no\n[Tool]\n{body}")
        (folder / "9.conf").write_text("[DEFAULT]\nkey1 = low\n[Tool]\nkey2 = over\n")
        main = str(tmp_path / "tool.conf")

        def rows(df):
            return sorted((r.layer, r.file.rsplit("/", 1)[-1], r.key, r.value) for r in df.collect())

        whole = rows(read_settings(spark, main, "Tool", "run"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        try:
            cut = read_large_settings(spark, main, "Tool", "run")
            assert spark.read.text(main).rdd.getNumPartitions() > 5
            assert rows(cut) == whole and len(whole) == 402
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


class TestLogRecords:
    def test_tracebacks_keep_their_record(self, spark):
        start = "2024-01-01 00:00:00::ERROR::mod::7::root:: failed"
        data = [("f", 1, "lost"), ("f", 2, start), ("f", 3, "Traceback:"), ("f", 4, '  File "x"::y')]
        data += [("f", 5, "2024-01-01 00:00:01::INFO::mod::8::root:: ok"), ("g", 1, "lost too"), ("f", 6, None)]
        found = logs.log_records(spark.createDataFrame(data, "file string, line_no long, line string"))
        got = {(r.file, r.line_no): (r.record_no, r.part, r.level, r.message) for r in found.collect()}
        assert got == {
            ("f", 1): (None, None, None, None),
            ("f", 2): (2, 0, "ERROR", "failed"),
            ("f", 3): (2, 1, "ERROR", "Traceback:"),
            ("f", 4): (2, 2, "ERROR", '  File "x"::y'),
            ("f", 5): (5, 0, "INFO", "ok"),
            ("f", 6): (5, 1, "INFO", None),
            ("g", 1): (None, None, None, None),
        }
        routed = logs.route_records(found).filter("route = 'unparsed'").select("file", "line_no").collect()
        assert sorted(map(tuple, routed)) == [("f", 1), ("g", 1)]


class TestAsOf:
    def test_brute_force(self, spark):
        rng = random.Random(4)
        points = [(rng.choice("abc"), rng.randrange(100), f"p{i}") for i in range(40)]
        data = [(i, rng.choice("abcd"), rng.choice([None, 50, 50, rng.randrange(-5, 110)])) for i in range(400)]
        rows = spark.createDataFrame(data, "id int, line string, at int")
        tiers = spark.createDataFrame(points, "line string, since int, tier string")
        found = as_of(rows, tiers, "at", "since", ["line"])
        assert found.columns == ["id", "line", "at", "tier"]
        for r in found.collect():
            held = [(s, t) for line, s, t in points if line == r.line and r.at is not None and s <= r.at]
            assert r.tier == (max(held)[1] if held else None)

    def test_without_points_and_without_groups(self, spark):
        rows = spark.createDataFrame([(1, 5), (2, None)], "id int, at int")
        none = spark.createDataFrame([], "since int, tier string")
        assert [r.tier for r in as_of(rows, none, "at", "since").collect()] == [None, None]
        some = spark.createDataFrame([(5, "x"), (None, "y"), (9, "z")], "since int, tier string")
        assert {r.id: r.tier for r in as_of(rows, some, "at", "since").collect()} == {1: "x", 2: None}


class TestRedactByNode:
    LINES = [
        "token = abc rest", 'x="q" token: "a b" z', "a.token=1 broken=2", "secret=token=abc", "Authorization: Bearer xyz",
        "a.b-c=1 b-c: 2 c=3", "none", None, '{"token": "x", "secret":"y"}', "tokens=1 token =", "secret= 'a \\' b' c",
    ]

    def test_equal_to_one_list_for_all(self, spark):
        names = ["token", "secret", "Authorization", "b-c", "unused"]
        rows = spark.createDataFrame(
            [(h, i, line) for h in ("h1", "h2") for i, line in enumerate(self.LINES)], "host string, id int, line string"
        )
        keys = spark.createDataFrame([(h, k) for h in ("h1", "h2", "h3") for k in names * 2], "host string, key string")
        found = redact.redact_by_node(rows, keys, "host", ["id"])
        want = redact.redact_rows(rows, names)
        assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))

    def test_each_node_has_its_own(self, spark):
        rows = spark.createDataFrame([("a", 1, "k=1 m=2"), ("b", 1, "k=1 m=2"), (None, 1, "k=1")], "host string, id int, line string")
        keys = spark.createDataFrame([("a", "k"), ("b", "m"), ("b", None)], "host string, key string")
        found = redact.redact_by_node(rows, keys, "host", ["id"])
        assert sorted((r.host or "", r.line) for r in found.collect()) == [
            ("", "k=1"), ("a", "k=******** m=2"), ("b", "k=1 m=********"),
        ]


class TestGlobIndex:
    def test_hits_of_random_globs(self, spark):
        rng = random.Random(6)
        values = ["".join(rng.choice("ab[-.é") for _ in range(rng.randrange(0, 9))) for _ in range(150)]
        tokens = ["a", "b", "ab", "ba", "*", "*", "?", "[a-b]", "[!a]", "[", "-", "é"]
        globs = list({"".join(rng.choice(tokens) for _ in range(rng.randrange(1, 6))) for _ in range(150)})
        rows = spark.createDataFrame([(x,) for x in [*values, None]], "address string")
        patterns = spark.createDataFrame([(x,) for x in [*globs, None]], "pattern string")
        found = {(r.pattern, r.value) for r in select.pattern_hits(rows, patterns).collect()}
        assert found == {(g, x) for g in globs for x in set(values) if fnmatch.fnmatchcase(x, g)}
        hit = {r.address for r in select.match_patterns(rows, patterns.filter("length(pattern) > 2")).collect()}
        assert hit == {x for x in values if any(len(g) > 2 and fnmatch.fnmatchcase(x, g) for g in globs)}

    def test_infix_globs_meet_few_values(self, spark):
        rows = spark.range(3000).select(F.format_string("node%06d.example", "id").alias("address"))
        patterns = spark.range(1000).select(F.format_string("*%05d*", F.col("id") * 7).alias("pattern"))
        keyed, filed, _ = select._looked_up(select._values(rows, "address"), patterns)
        met = keyed.join(filed, ["_end", "_salt"]).count()
        hits = select.pattern_hits(rows, patterns).count()
        assert hits > 400 and met < 60 * hits  # all pairs would be 3,000,000

    def test_class_globs_push_their_ends(self, spark, tmp_path):
        path = str(tmp_path / "hosts")
        spark.createDataFrame([("node-1.a",), ("node-x.a",), ("other",)], "address string").write.parquet(path)
        found = spark.read.parquet(path).filter(glob(F.col("address"), "node-[0-9].?"))
        assert [r.address for r in found.collect()] == ["node-1.a"]
        assert "StringStartsWith(address,node-)" in plan_of(found)
        assert "StringEndsWith(address,.a)" in plan_of(spark.read.parquet(path).filter(glob(F.col("address"), "*[0-9].a")))


class TestRuns:
    EVENTS = [
        (1, 1, 2, None), (1, 2, 0, None), (1, 3, None, False), (2, 1, 1, None), (2, 2, 0, None), (3, 1, 0, None),
        (3, 2, 2, True), (3, 3, 0, None), (3, 4, None, True), (4, 1, None, None),
    ]
    WANT = {1: (0, 2, None), 2: (0, 1, None), 3: (1, 1, 2), 4: (0, 0, None)}

    def test_batch(self, spark):
        found = status.run_outcome(spark.createDataFrame(self.EVENTS * 2, EVENT)).collect()
        assert {r.run_id: (r.status, r.worst_status, r.ended_at) for r in found} == self.WANT

    @pytest.mark.parametrize("seed", [1, 2])
    def test_any_cut_of_the_stream(self, spark, tmp_path, seed):
        rng = random.Random(seed)
        events = self.EVENTS + rng.sample(self.EVENTS, 4)  # some come twice, all in any order
        rng.shuffle(events)
        cut = rng.randrange(3, 9)
        for part in (events[:cut], events[cut:]):
            spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = run_outcome_stream(spark, str(tmp_path / "in"))
        query = (
            stream.writeStream.outputMode("complete").format("memory").queryName(f"runs{seed}")
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination(120)
        found = spark.table(f"runs{seed}").collect()
        assert {r.run_id: (r.status, r.worst_status, r.ended_at) for r in found} == self.WANT


class TestPages:
    def test_pages_after_a_hole_are_not_taken(self, spark):
        data = [("a", 1), ("b", 1), ("b", 2), ("c", 2), ("d", 4), ("a", 5), ("e", None)]
        found = paging.landed_pages(spark.createDataFrame(data, "address string, page int"))
        assert {r.address: (r.first_page, r.times, r.taken) for r in found.collect()} == {
            "a": (1, 2, True), "b": (1, 2, True), "c": (2, 1, True), "d": (4, 1, False), "e": (None, 1, False),
        }
        late = spark.createDataFrame([("x", 2)], "address string, page int")
        assert [r.taken for r in paging.landed_pages(late).collect()] == [False]
        assert paging.landed_pages(late.limit(0)).count() == 0

    def test_rows_of_one_hash_are_told_apart(self, spark, monkeypatch):
        rows = spark.range(300).select((F.col("id") % 3).alias("key"), F.col("id").alias("id"))
        monkeypatch.setattr(paging.F, "xxhash64", lambda *columns: F.lit(1).cast("bigint"))
        numbered = paging.with_page_number(rows, ["key"], 100).collect()
        assert sorted(r.id for r in numbered) == list(range(300))
        assert {(r.page, r.key) for r in numbered} == {(1, 0), (2, 1), (3, 2)}


class TestInventoryChanges:
    @pytest.mark.parametrize("buckets", [1, 4096])
    def test_brute_force(self, spark, buckets):
        old = [("a", "up"), ("b", None), ("b", None), ("c", "up"), ("d", "up")]
        new = [("a", "up"), ("b", None), ("c", "down"), ("d", "up"), ("d", "up"), ("e", "up")]
        schema = "address string, status string"
        found = inventory_changes(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), buckets)
        assert sorted((r.address, r.status or "", r.side, r.times) for r in found.collect()) == [
            ("b", "", "old", 1), ("c", "down", "new", 1), ("c", "up", "old", 1), ("d", "up", "new", 1), ("e", "up", "new", 1),
        ]
        same = spark.createDataFrame(old, schema)
        assert inventory_changes(same, spark.createDataFrame(old[::-1], schema), buckets).count() == 0


def test_dates(spark):
    day = datetime.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(1, day), (2, day + datetime.timedelta(days=3))], "id int, at timestamp")
    tiers = spark.createDataFrame([(day, 30), (day + datetime.timedelta(days=2), 32)], "since timestamp, tier int")
    assert {r.id: r.tier for r in as_of(rows, tiers, "at", "since").collect()} == {1: 30, 2: 32}
