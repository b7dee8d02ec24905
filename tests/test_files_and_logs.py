import datetime
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from fleetlens.functions.names import bundle_name, host_file, stem, without_extension
from fleetlens.functions.text import first_word, megabytes
from fleetlens.operators import bundle, logs, status
from fleetlens.operators.drift import clock_drift
from fleetlens.sinks import files as sinks
from fleetlens.sources.reports import read_collected
from fleetlens.streaming import landing


def test_megabytes_print_like_python(spark):
    rng = random.Random(2)
    values = [0, 1, 1 << 20, 52428, 52429, 262144, 786432, 1000 << 20, (1 << 40) + 12345]
    values += [rng.randrange(1 << rng.randrange(1, 50)) for _ in range(300)]
    values += [(n << 20) + (1 << 18) * k for n in range(5) for k in range(4)]
    df = spark.createDataFrame([(value,) for value in values], "n bigint")
    for row in df.select("n", megabytes(F.col("n")).alias("t")).collect():
        assert row.t == "%.1fM" % (float(row.n) / (1 << 20))


def test_names(rows):
    when = datetime.datetime(2024, 2, 3, 4, 5, 6)
    df = rows("at timestamp_ntz, ticket string", (when, "77"), (when, None), (when, ""))
    got = [row[0] for row in df.select(bundle_name("fleet", F.col("at"), F.col("ticket"))).collect()]
    assert got == ["sosreport-fleet-77-20240203040506.tar.xz"] + ["sosreport-fleet-20240203040506.tar.xz"] * 2
    names = rows("p string", ("/a.b/x.tar.xz",), ("x",), ("/a/.hidden",), ("a.b",))
    assert [row[0] for row in names.select(without_extension(F.col("p"))).collect()] == ["/a.b/x.tar", "x", "/a/.hidden", "a"]
    assert [row[0] for row in names.select(stem(F.col("p"))).collect()] == ["x", "x", "", "a"]
    assert names.select(host_file(F.lit("h"), F.col("p"))).first()[0] == "h-x.tar.xz"


def test_manifests(spark, tmp_path):
    content = {"b1/one.bin": b"\x00\xff" * 500, "b1/two.txt": b"two", "b2/deep/three": b"3", "b2/no thing": b""}
    for name, data in content.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    files = read_collected(spark, str(tmp_path))
    got = {(row.bundle, row.name): (row.length, row.sha256) for row in bundle.file_manifest(files).collect()}
    assert got == {
        (name.split("/")[0], name.split("/")[-1]): (len(data), hashlib.sha256(data).hexdigest())
        for name, data in content.items()
    }
    sizes = bundle.bundle_manifest(files)
    assert sorted(tuple(row) for row in sizes.collect()) == [("b1", 2, 1003, "0.0M", False), ("b2", 2, 1, "0.0M", False)]
    assert "ReadSchema: struct<path:string,length:bigint>" in plan_of(sizes)
    told = {row.bundle: row for row in bundle.bundle_messages(bundle.file_manifest(files), "/out").collect()}
    assert told["b1"].message == (
        "Log files have been collected and placed in /out/b1\n"
        f"The sha256 for this file is {told['b1'].checksum} and its size is 0.0M"
    )
    assert len(told["b1"].checksum) == 60 and told["b1"].checksum != told["b2"].checksum
    again = bundle.bundle_checksums(bundle.file_manifest(files).repartition(7)).collect()
    assert {row.bundle: row.checksum for row in again} == {name: row.checksum for name, row in told.items()}
    sinks.write_manifest(sizes, str(tmp_path / "out" / "manifest"))
    assert spark.read.json(str(tmp_path / "out" / "manifest")).count() == 2
    sinks.write_checksums(bundle.file_manifest(files), str(tmp_path / "out" / "sums"))
    lines = [row.value for row in spark.read.text(str(tmp_path / "out" / "sums")).collect()]
    assert f"{hashlib.sha256(b'two').hexdigest()}  two.txt" in lines
    one = spark.createDataFrame([(lines[0],)], "l string").select(first_word(F.col("l")))
    assert one.first()[0] == lines[0].split()[0]


def test_advice_starts_at_1000_mib(rows):
    df = rows("bundle string, length bigint", ("a", 999 << 20), ("a", 1 << 20), ("b", (1000 << 20) - 1))
    got = {row.bundle: (row.size, row.advise_filters) for row in bundle.bundle_manifest(df).collect()}
    assert got == {"a": ("1000.0M", True), "b": ("1000.0M", False)}


def test_database_files(rows):
    df = rows("path string", ("/s/r.tar.xz",), ("/s/r.tar.xz.sha256",), ("/s/r.tar.xz.md5",), ("/s/q.tar",), ("/s/q.tar.sha256",), ("/s/n.tar",), ("/s/lone.md5",))
    got = {row.path: tuple(row)[1:] for row in bundle.database_files(df).collect()}
    assert got == {
        "/s/r.tar.xz": ("postgresql-r.tar.xz", "/s/r.tar.xz.md5", "postgresql-r.tar.xz.md5"),
        "/s/q.tar": ("postgresql-q.tar", "/s/q.tar.sha256", "postgresql-q.tar.sha256"),
        "/s/n.tar": ("postgresql-n.tar", None, None),
    }


def test_host_folders(rows, spark, tmp_path):
    df = rows("host string, path string", ("h1", "/t/r.tar"), ("h2", "/t/r.tar"))
    sinks.write_host_files(df, str(tmp_path / "out"))
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_host_files(df, str(tmp_path / "out"))
    # Overwriting one host leaves the others as they are.
    sinks.write_host_files(df.filter("host = 'h1'"), str(tmp_path / "out"), mode="overwrite")
    many = df.crossJoin(spark.range(500)).repartition(16)
    sinks.write_host_files(many.select("host", "path"), str(tmp_path / "many"))
    assert len(list((tmp_path / "many").glob("host=h1/*.parquet"))) == 1
    routed = rows("seq int, route string", (1, "file"), (2, "stderr"), (3, None))
    sinks.write_routed(routed, str(tmp_path / "routed"))
    assert spark.read.json(str(tmp_path / "routed")).count() == 3
    assert sorted(path.name for path in (tmp_path / "out").glob("host=*")) == ["host=h1", "host=h2"]
    assert {row.name for row in spark.read.parquet(str(tmp_path / "out")).collect()} == {"h1-r.tar", "h2-r.tar"}


def test_run_status(rows):
    df = rows(
        "run_id string, seq bigint, status_set int",
        ("reset", 1, 2), ("reset", 2, 0), ("reset", 3, None), ("none", 1, None), ("mild", 1, 1), ("mild", 2, 2),
    )
    got = {row.run_id: (row.status, row.worst_status) for row in status.run_status(df).collect()}
    assert got == {"reset": (0, 2), "none": (0, 0), "mild": (2, 1)}


LINES = [
    "2024-01-01 00:00:00::ERROR::mod::12::root:: a::b",
    "2024-01-01 00:00:00::INFO::mod::13::root:: hello",
    "2024-01-01 00:00:00::DEBUG::mod::14::root:: quiet",
    "no fields at all",
]


def test_log_lines(rows):
    df = logs.parse_log_lines(rows("seq int, line string", *enumerate(LINES)))
    first, *_, last = df.orderBy("seq").collect()
    assert tuple(first)[1:] == (LINES[0], True, "2024-01-01 00:00:00", "ERROR", "mod", 12, "root", "a::b", 40)
    assert tuple(last)[1:3] == (LINES[-1], False) and set(tuple(last)[3:]) == {None}

    def routed(**options):
        found = sorted((row.seq, row.route) for row in logs.route_records(df, **options).collect())
        assert found.pop() == (3, "unparsed")  # no line is lost
        return found

    assert routed() == [(0, "file"), (0, "stderr"), (1, "file"), (1, "stdout")]
    assert routed(minimum="DEBUG", log_file=False) == [(0, "stderr"), (1, "stdout"), (2, "stdout")]
    assert routed(quiet=True) == [(0, "file"), (1, "file")]
    assert routed(quiet=True, log_file=False) == [(0, "stderr")]


def test_message_lines(rows):
    got = logs.message_lines(rows("seq int, message string", (1, "a\r\nb\n"), (2, ""))).collect()
    assert [tuple(row) for row in got] == [(1, 1, "a"), (1, 2, "b")]


def _drain(stream, name):
    query = stream.writeStream.format("memory").queryName(name).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_row_wise_jobs_run_on_streams(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "one").write_text("\n".join(LINES))
    _drain(landing.log_stream(spark, str(tmp_path / "log")), "s_log")
    assert spark.table("s_log").count() == 5

    engine = datetime.datetime(2024, 3, 1, 12)
    probes = spark.createDataFrame([(1, "h", "2024-03-01T12:00:01+00:00", engine), (2, "h", "bad", engine)], landing.PROBE)
    probes.write.parquet(str(tmp_path / "probes"))
    _drain(landing.drift_stream(spark, str(tmp_path / "probes")), "s_drift")
    assert sorted(spark.table("s_drift").collect()) == sorted(clock_drift(probes).collect())

    text = "report_id int, line string"
    spark.createDataFrame([(1, "KEY=a"), (2, "b")], text).write.parquet(str(tmp_path / "text"))
    _drain(landing.redacted_stream(spark, str(tmp_path / "text"), text, ["KEY"], "line"), "s_redact")
    assert {row.line for row in spark.table("s_redact").collect()} == {"KEY=********", "b"}

    fleet = "datacenter string, cluster string, address string"
    spark.createDataFrame([("d", "c", "h1"), ("d", "c", "x")], fleet).write.parquet(str(tmp_path / "fleet"))
    _drain(landing.selected_stream(spark, str(tmp_path / "fleet"), fleet, hosts=["h*"]), "s_fleet")
    assert [row.address for row in spark.table("s_fleet").collect()] == ["h1"]
