import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from fleetlens.functions.text import after, base_name, comma_list, first_word, lines, strip
from fleetlens.operators import redact, reports, sections

BREAKS = ["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " "]


def _column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_lines_are_pythons_lines(spark):
    rng = random.Random(7)
    pieces = ["a", "", " b ", "é", *BREAKS, "\n", "\n"]
    texts = ["", "\n", "\n\n", "a", "a\n", "\r\n", "a\r\n\r\nb"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randrange(9))) for _ in range(500)]
    assert _column(spark, texts, lines) == [text.splitlines() for text in texts]


def test_text_helpers(spark):
    texts = [" a \n", "\t\x1c b ", "", "plain"]
    assert _column(spark, texts, strip) == [text.strip() for text in texts]
    assert _column(spark, ["x: y: z", "none", ": v", ""], lambda t: after(t, ": ")) == ["y: z", "", "v", ""]
    assert _column(spark, ["/a/b", "c", "/d/", ""], base_name) == ["b", "c", "", ""]
    assert _column(spark, ["a, b ,c", "a"], comma_list) == [["a", "b", "c"], ["a"]]
    assert _column(spark, ["abc  file", "  x y"], first_word) == ["abc", "x"]


OUTPUT = [
    ("abs", "note\n /var/tmp/sosreport-h1.tar.xz \nThe sha256sum is: 12: 34\n", ("sosreport-h1.tar.xz", "/var/tmp/sosreport-h1.tar.xz", "12: 34", False)),
    ("rel", "x/sosreport-a.tar\r\n/b/sosreport-b.tar\nThe sha256sum is lost", ("sosreport-a.tar", "/tmp/d/sosreport-a.tar", "", False)),
    ("nosum", "sosreport-a.tar", ("sosreport-a.tar", "/tmp/d/sosreport-a.tar", None, False)),
    ("none", "The sha256sum is: 99\nsosreport tar", (None, None, None, True)),
    ("empty", "", (None, None, None, True)),
]


def test_report_refs(spark):
    df = spark.createDataFrame([(name, text) for name, text, _ in OUTPUT], "report_id string, text string")
    wanted = {name: ref for name, _, ref in OUTPUT}
    whole = {row.report_id: tuple(row)[1:] for row in reports.report_refs(df, "/tmp/d").collect()}
    assert whole == wanted
    cut = reports.report_refs_of_lines(reports.report_lines(df), F.lit("/tmp/d"))
    got = {row.report_id: tuple(row)[1:] for row in cut.collect()}
    assert got == {name: ref for name, ref in wanted.items() if name != "empty"}
    text = [df.select("report_id"), reports.report_lines(df)]
    assert "split(" not in "".join(re.findall(r"Filter [^\n]*", plan_of(text[1])))


def test_first_match_takes_the_first_line(rows):
    df = rows("report_id int, line_no int, line string", (1, 9, "hit b"), (1, 2, "hit a"), (1, 1, "miss"), (2, 1, "miss"))
    assert [tuple(row) for row in reports.first_match(df, F.col("line").startswith("hit")).collect()] == [(1, 2, "hit a")]


def scan(text, marker, user):
    """The rule, told line by line."""
    fields = {"host": None, "port": None, "admin": None, "pass": None}
    entry = early = None
    seen = False
    for line in text.splitlines():
        if marker in line:
            seen = True
        elif line.startswith("#") or not line.strip():
            continue
        elif seen:
            entry = line.split(":", 4)
            break
        elif user and early is None and len(line.split(":", 4)) == 5 and line.split(":", 4)[3] == user:
            early = line.split(":", 4)
    for name, index in (("host", 0), ("port", 1), ("admin", 3), ("pass", 4)):
        source = early if name == "pass" and early else entry
        if source and len(source) > index:
            fields[name] = source[index].strip()
    return tuple(fields.values())


@pytest.mark.parametrize("user", [None, "bob"])
def test_sections(spark, user):
    rng = random.Random(13)
    pieces = [
        "# DB ADMIN credentials.", "# comment", "", "   ", "h1:5432:*:bob: pw:x ", "h2:1:db:eve:s3",
        "h3:2:db:bob:late", "short:1", "h4:5432:*:bob", " h5:7:*: bob :odd",
    ]
    files = [(i, "\n".join(rng.choice(pieces) for _ in range(rng.randrange(8)))) for i in range(400)]
    df = spark.createDataFrame(files, "report_id int, text string")
    wanted = {i: scan(text, sections.ADMIN_MARKER, user) for i, text in files}
    whole = sections.section_lookup(df, user=user)
    assert {row.report_id: tuple(row)[1:] for row in whole.collect()} == wanted
    cut = sections.section_lookup_of_lines(reports.report_lines(df), user=user)
    got = {row.report_id: tuple(row)[1:] for row in cut.collect()}
    blank = (None, None, None, None)
    assert {i: got.get(i, blank) for i in wanted} == wanted


def test_section_with_a_hot_file(spark):
    """One file holds nine tenths of all lines."""
    lines_df = spark.range(60_000).selectExpr(
        "if(id % 10 < 9, 0, id) report_id", "id line_no",
        "case when id = 5000 then 'DB ADMIN credentials' when id % 2 = 0 then '# no' else concat('h', id, ':1:d:u:p') end line",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        got = sections.section_lookup_of_lines(lines_df).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert [(row.report_id, row.host) for row in got] == [(0, "h5001")]


def test_redact(spark):
    keys = redact.sensitive_keys("PASSWORD,TOKEN", None, "TOKEN:a.b")
    assert keys == ["PASSWORD", "TOKEN", "a.b"]
    texts = {
        "PASSWORD=x y": "PASSWORD=******** y",
        'my TOKEN : "a b" c': "my TOKEN : ******** c",
        "TOKEN='q r'\nTOKEN=z": "TOKEN=********\nTOKEN=********",
        "BROKENTOKEN=1": "BROKENTOKEN=1",
        "TOKENS=1": "TOKENS=1",
        "a.b=1 axb=2": "a.b=******** axb=2",
        "nothing": "nothing",
        '{"PASSWORD": "x1", "n": 2}': '{"PASSWORD": ********, "n": 2}',
        "{'TOKEN':'a\\'b c'}": "{'TOKEN':********}",
        "TOKEN: Bearer abc def": "TOKEN: ******** def",
        'PASSWORD="never closed long secret\nnext': "PASSWORD=********\nnext",
        r'PASSWORD="a \"b\" c" d': "PASSWORD=******** d",
        "password=x": "password=x",
    }
    assert _column(spark, list(texts), lambda t: redact.redact(t, keys)) == list(texts.values())
    assert _column(spark, list(texts), lambda t: redact.redact(t, keys, include_sensitive=True)) == list(texts)
    assert _column(spark, list(texts), lambda t: redact.redact(t, [])) == list(texts)
    assert _column(
        spark,
        ["Password=x y", "Cookie: a b; c\nnext", "cookie jar"],
        lambda t: redact.redact(t, keys, case_sensitive=False, whole_line=["cookie"]),
    ) == ["Password=******** y", "Cookie: ********\nnext", "cookie jar"]
