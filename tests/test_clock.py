import datetime
import random

from pyspark.sql import functions as F

from fleetlens.functions.clock import duration, signed_duration
from fleetlens.operators.drift import DRIFT_HEADER, clock_drift, drift_report
from fleetlens.sinks.files import write_drift_report

UTC = datetime.timezone.utc
ENGINE = datetime.datetime(2024, 3, 1, 12, 0, 0, tzinfo=UTC)


def test_duration_prints_like_timedelta(spark):
    rng = random.Random(3)
    values = [0, 1, 999_999, 1_000_000, 59_999_999, 3_599_999_999, 86_399_999_999, 86_400_000_000, 172_800_000_000]
    values += [rng.randrange(10 ** rng.randrange(1, 15)) for _ in range(500)]
    df = spark.createDataFrame([(value,) for value in values], "us bigint")
    for row in df.select("us", duration(F.col("us")).alias("text")).collect():
        assert row.text == str(datetime.timedelta(microseconds=row.us))


def test_sign(spark):
    df = spark.createDataFrame([(5_000_000,), (-5_000_000,), (0,)], "us bigint")
    got = [row[0] for row in df.select(signed_duration(F.col("us"))).collect()]
    assert got == ["+0:00:05", "-0:00:05", "-0:00:00"]


PROBES = [
    # raw text, outcome, drift in microseconds, shown host time
    ("2024-03-01T12:00:00+00:00", "ok", 0, "2024-03-01 12:00:00+00:00"),
    (" 2024-03-01T13:00:05+01:00\n", "ok", 5_000_000, "2024-03-01 13:00:05+01:00"),
    ("2024-03-01T11:59:59Z", "ok", -1_000_000, "2024-03-01 11:59:59+00:00"),
    ("2024-03-01T07:00:00-0500", "ok", 0, "2024-03-01 07:00:00-05:00"),
    ("2024-03-01T17:30:00.250000+05:30", "ok", 250_000, "2024-03-01 17:30:00.250000+05:30"),
    ("2024-03-03T12:00:00+00", "ok", 172_800_000_000, "2024-03-03 12:00:00+00:00"),
    ("2024-03-01T12:00:00", "warn", None, None),
    ("2024-03-01T12:00", "warn", None, None),
    ("2024-03-01T13:00+01:00", "ok", 0, "2024-03-01 13:00:00+01:00"),
    ("20240301T120001Z", "ok", 1_000_000, "2024-03-01 12:00:01+00:00"),
    ("20240301T1200+0000", "ok", 0, "2024-03-01 12:00:00+00:00"),
    ("2024-03-01 12:00:00,5 +00:00", "ok", 500_000, "2024-03-01 12:00:00.500000+00:00"),
    ("2024-03-01T12:00:00.1234567Z", "ok", 123_456, "2024-03-01 12:00:00.123456+00:00"),
    ("2024-03-01T12:60:00Z", "skipped", None, None),
    ("2024-13-01T12:00:00+00:00", "skipped", None, None),
    ("99999-03-01T12:00:00+00:00", "skipped", None, None),
    ("garbage", "skipped", None, None),
    ("", "skipped", None, None),
    (None, "skipped", None, None),
]


def _probes(spark):
    data = [(number, f"host{number:02d}", probe[0], ENGINE) for number, probe in enumerate(PROBES)]
    return spark.createDataFrame(data, "probe_id bigint, host string, host_time_raw string, engine_time timestamp")


def test_outcomes(spark):
    got = clock_drift(_probes(spark)).orderBy("probe_id").collect()
    assert [(row.outcome, row.drift_us, row.host_time_text) for row in got] == [probe[1:] for probe in PROBES]
    assert got[0].drift == "-0:00:00" and got[5].drift == "+2 days, 0:00:00"
    assert got[0].engine_time_text == "2024-03-01 12:00:00+00:00"


def test_drift_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        got = clock_drift(_probes(spark)).orderBy("probe_id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(row.outcome, row.drift_us, row.host_time_text) for row in got] == [probe[1:] for probe in PROBES]
    assert got[0].engine_time_text == "2024-03-01 17:30:00+05:30"


def test_report_has_header_first_and_is_sorted(spark, tmp_path):
    lines = [row.line for row in drift_report(_probes(spark)).collect()]
    assert lines[0] == DRIFT_HEADER
    count = sum(probe[1] == "ok" for probe in PROBES)
    assert len(lines) == 1 + count and lines[1:] == sorted(lines[1:])
    assert sorted(row.line for row in drift_report(_probes(spark), ordered=False).collect()) == sorted(lines)
    assert lines[2] == "%-17s : %-33s : %-33s : %-35s" % (
        "host01 ", "2024-03-01 13:00:05+01:00", "2024-03-01 12:00:00+00:00", "+0:00:05",
    )
    write_drift_report(_probes(spark), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 1 + count
