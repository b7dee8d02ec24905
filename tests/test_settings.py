import pytest
from pyspark.sql import functions as F

from fleetlens.operators import settings
from fleetlens.operators.reports import report_refs
from fleetlens.sources.reports import (
    host_listings,
    read_collected,
    read_credentials,
    read_host_listings,
    read_report_lines,
    read_reports,
)
from fleetlens.sources.settings import read_files
from fleetlens.sources.settings import parse_section, read_pairs, read_service_settings, read_settings

SCHEMA = "run_id string, layer int, file string, seq bigint, key string, value string"


def resolved(df):
    return {(row.run_id, row.key): row.value for row in df.collect()}


def test_layers(rows):
    df = rows(
        SCHEMA,
        ("r", 0, None, 0, "a", "default"), ("r", 1, "m", 1, "a", "main"), ("r", 3, None, 0, "a", None),
        ("r", 2, "d/10", 9, "b", "early"), ("r", 2, "d/20", 1, "b", "late"), ("r", 1, "m", 99, "b", "main"),
        ("r", 1, "m", 1, "c", "first"), ("r", 1, "m", 2, "c", "last"),
        ("s", 3, None, 0, "a", "cli"), ("s", 2, "d", 0, "a", "file"), ("s", 0, None, 0, "n", None),
    )
    assert resolved(settings.effective_settings(df)) == {
        ("r", "a"): "main", ("r", "b"): "late", ("r", "c"): "last", ("s", "a"): "cli",
    }


def test_old_keys(rows):
    df = rows(
        SCHEMA,
        ("both", 2, "d", 0, "rhevm", "old"), ("both", 1, "m", 0, "engine", "new"),
        ("old", 1, "m", 0, "rhevm", "old"), ("old", 0, None, 0, "engine", "default"),
        ("cli", 1, "m", 0, "rhevm", "old"), ("cli", 3, None, 0, "engine", "cli"),
        ("ca", 2, "d", 0, "engine-ca", "pem"),
    )
    assert resolved(settings.effective_settings(df)) == {
        ("both", "engine"): "new", ("old", "engine"): "old", ("cli", "engine"): "cli", ("ca", "cert-file"): "pem",
    }


INI = """stray = 1
; comment
[Other]
user=nobody
[Collector]
# user=commented
User = alice
engine: host=1:443
empty =
bare
long = one
    two
  # inside
	three

after=%(x)s
[DEFAULT]
shared = base
user = default
[Collector]
user=bob
"""


def test_section_text(rows):
    got = parse_section(rows("file string, text string", ("f", INI)), "Collector").orderBy("seq").collect()
    assert [(row.key, row.value, row.from_default) for row in got] == [
        ("user", "alice", False),
        ("engine", "host=1:443", False),
        ("empty", "", False),
        ("bare", "true", False),
        ("long", "one\ntwo\nthree", False),
        ("after", "%(x)s", False),
        ("shared", "base", True),
        ("user", "default", True),
        ("user", "bob", False),
    ]


def test_settings_files(spark, tmp_path):
    main = tmp_path / "tool.conf"
    (tmp_path / "tool.conf.d").mkdir()
    (tmp_path / "tool.conf.d" / "20-b.conf").write_text("[C]\nkey = b\n")
    (tmp_path / "tool.conf.d" / "10-a.conf").write_text("[C]\r\nkey = a\r\nonly = a\r\n[DEFAULT]\nlow=1\nkey=0\n")
    (tmp_path / "tool.conf.d" / "note.txt").write_text("[C]\nkey = text\n")
    drop_ins = settings.effective_settings(read_settings(spark, str(main), "C"))
    assert resolved(drop_ins) == {("", "key"): "b", ("", "only"): "a", ("", "low"): "1"}
    main.write_text("[C]\nkey = main\nrhevm = old\n")
    both = settings.effective_settings(read_settings(spark, str(main), "C", run_id="r"))
    assert resolved(both) == {("r", "key"): "b", ("r", "only"): "a", ("r", "low"): "1", ("r", "engine"): "old"}


def test_settings_without_files_and_old_keys_among_the_defaults(spark, tmp_path):
    main = tmp_path / "tool.conf"
    assert read_settings(spark, str(main), "C").count() == 0
    main.write_text("[DEFAULT]\nrhevm = old\nlow = 1\n[C]\nlow = 2\n")
    got = settings.effective_settings(read_settings(spark, str(main), "C"))
    assert resolved(got) == {("", "engine"): "old", ("", "low"): "2"}
    main.write_text("[DEFAULT]\nrhevm = old\n[C]\nengine = new\n")
    assert resolved(settings.effective_settings(read_settings(spark, str(main), "C"))) == {("", "engine"): "new"}
    assert read_service_settings(spark, [str(tmp_path / "none"), str(tmp_path / "no")]).count() == 0


def test_files_without_content_keep_their_rows(spark, tmp_path):
    (tmp_path / "h 1" / "d").mkdir(parents=True)
    (tmp_path / "h 1" / "d" / "full").write_text("a\nb")
    (tmp_path / "h 1" / "d" / "no thing").write_text("")
    folder = str(tmp_path / "h 1" / "d")
    reports = read_reports(spark, folder)
    assert sorted(row.text for row in reports.collect()) == ["", "a\nb"]
    refs = {row.report_id.rsplit("/", 1)[-1]: row.missing_report for row in report_refs(reports, "/tmp").collect()}
    assert len(refs) == 2 and all(refs.values())
    listed = host_listings(read_files(spark, folder)).collect()
    assert len(listed) == 2
    assert read_credentials(spark, folder).count() == 2
    assert sorted(row.length for row in read_collected(spark, str(tmp_path)).collect()) == [0, 3]


def test_large_files_are_numbered_across_blocks(spark, tmp_path):
    lines = [f"line {number} " + "x" * (number % 50) for number in range(3000)]
    (tmp_path / "one").write_text("\n".join(lines))
    (tmp_path / "two").write_text("only\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
    try:
        got = read_report_lines(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() >= 1
        rows = sorted((row.report_id[-3:], row.line_no, row.line) for row in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == [("one", number, line) for number, line in enumerate(lines, 1)] + [("two", 1, "only")]


def test_pairs_and_service_layers(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    one.write_text('NAME="Some OS"\nno pair\nID=abc\nEMPTY=""\nX=\n')
    got = {row.key: row.value for row in read_pairs(spark, str(one)).collect()}
    assert got == {"NAME": "Some OS", "ID": "b", "EMPTY": "", "X": ""}
    two.write_text("# ID=no\nID = def\nNEW='q'\n")
    layered = settings.effective_settings(read_service_settings(spark, [str(one), str(two)]), renamed={})
    assert resolved(layered) == {
        ("", "NAME"): "Some OS", ("", "ID"): "def", ("", "EMPTY"): "", ("", "X"): "", ("", "NEW"): "q",
    }


def test_landed_folders(spark, tmp_path):
    host = tmp_path / "h1" / "selinux"
    host.mkdir(parents=True)
    (host / "ls_-lRZ").write_text("/etc:\ntotal 0\n")
    got = read_host_listings(spark, str(tmp_path / "*" / "selinux"))
    assert [tuple(row) for row in got.orderBy("line_no").collect()] == [("h1", 1, "/etc:"), ("h1", 2, "total 0")]
    assert read_reports(spark, str(host)).columns == ["report_id", "text"]
    (tmp_path / "pgpass").write_text("x:1:d:eng:first\n# DB ADMIN credentials\nlocalhost:5432:*:admin:se:cret\n")
    row = read_credentials(spark, str(tmp_path / "pgpass"), user="eng").first()
    assert (row.host, row.port, row.admin, row["pass"]) == ("localhost", "5432", "admin", "first")
    files = read_collected(spark, str(tmp_path))
    assert [(r.bundle, r.length) for r in files.filter("bundle = 'h1'").collect()] == [("h1", 14)]


def test_defaults_and_checks(rows):
    df = rows("run_id string, key string, value string", ("r", "a", "1"), ("r", "b", ""), ("s", "a", "1"), ("s", "b", "2"), ("t", "z", "1"))
    checked = {row.run_id: (row.has_all, row.has_any) for row in settings.settings_check(df, ["a", "b"]).collect()}
    assert checked == {"r": (False, True), "s": (True, True), "t": (False, False)}
    asked = rows("run_id string, key string", ("r", "a"), ("r", "q"), ("r", "x"))
    assert resolved(settings.with_defaults(df, {"q": "dq"}, asked)) == {("r", "a"): "1", ("r", "q"): "dq", ("r", "x"): None}


TEMPLATES = ["%(a)s-%(b)s", "100%% %(a)s%(a)s", "plain", "%(a)s %(c)s", "", "%%(a)s", "%(b)s"]


@pytest.mark.parametrize("template", TEMPLATES)
def test_templates(rows, template):
    values = {"a": "x%(b)s", "b": "$1\\2"}
    try:
        wanted = template % values
    except KeyError:
        wanted = None
    df = rows("run_id string, key string, value string", *[("r", key, value) for key, value in values.items()])
    assert [tuple(row) for row in settings.render_template(df, template).collect()] == [("r", wanted)]
    one = rows("t string, m map<string,string>", (template, values))
    assert one.select(settings.fill(F.col("t"), F.col("m"))).first()[0] == wanted
