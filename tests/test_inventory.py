import random

from pyspark.sql import functions as F

from fleetlens.operators.inventory import inventory, orphans
from fleetlens.operators.listing import LISTING_HEADER, list_hosts, listing_report, selection_line
from helpers import plan_of
from fleetlens.operators import paging
from fleetlens.operators.paging import page, page_after, with_page_number
from fleetlens.operators.spread import spread_join
from fleetlens.sinks.files import write_listing
from fleetlens.sources.entities import CLUSTER, DATACENTER, HOST, load_inventory

DCS = [("d1", "East"), ("d2", "West"), ("d1", "East")]
CLUSTERS = [
    ("c1", "Prod", True, "d1"),
    ("c2", "Prod", False, "d2"),
    ("c3", "Loose", None, None),
    ("c4", "Lost", False, "gone"),
    ("c5", "Empty", False, "d1"),
    ("c1", "Prod", True, "d1"),
]
HOSTS = [
    ("h1", "n", "up", "spm", "c1"),
    ("h1", "n", "up", "spm", "c1"),
    ("h2", "n", "maintenance", "spm", "c1"),
    ("h3", "n", None, None, "c2"),
    ("h4", "n", "up", "none", "c3"),
    ("h5", "n", "up", "none", None),
    ("h6", "n", "up", "none", "c4"),
    ("h7", "n", "up", "none", "nowhere"),
    ("h8", "n", "UP", "contending", "c2"),
]
WANTED = {
    ("East", "c1", "Prod", True, "h1", True, True),
    ("East", "c1", "Prod", True, "h2", True, False),
    ("West", "c2", "Prod", False, "h3", False, False),
    ("", "c3", "Loose", False, "h4", False, True),
    ("", "", "", False, "h5", False, True),
    ("West", "c2", "Prod", False, "h8", False, False),
}


def _tables(rows):
    return rows(DATACENTER, *DCS), rows(CLUSTER, *CLUSTERS), rows(HOST, *HOSTS)


def test_inventory(rows):
    got = [tuple(row) for row in inventory(*_tables(rows)).collect()]
    assert len(got) == len(WANTED) and set(got) == WANTED


def test_orphans(rows):
    assert {tuple(row) for row in orphans(*_tables(rows)).collect()} == {("h6", "c4"), ("h7", "nowhere")}


def test_empty_tables(rows, spark):
    nothing = [spark.createDataFrame([], schema) for schema in (DATACENTER, CLUSTER, HOST)]
    assert inventory(*nothing).count() == 0
    assert inventory(nothing[0], nothing[1], rows(HOST, *HOSTS)).count() == 1


def test_landed_extracts(rows, spark, tmp_path):
    for name, df in zip("dch", _tables(rows)):
        df.write.json(str(tmp_path / name))
    got = load_inventory(spark, *[str(tmp_path / name) for name in "dch"], fmt="json")
    assert {tuple(row) for row in got.collect()} == WANTED


def test_hot_cluster_and_missing_parents(spark):
    """A third of the hosts in one cluster, a third in none, the rest spread out."""
    count = 30_000
    hosts = spark.range(count).selectExpr(
        "concat('h', id) address", "'n' name", "'up' status", "'none' spm_status",
        "case id % 3 when 0 then 'c1' when 1 then null else concat('x', id % 50) end cluster_id",
    )
    clusters = spark.range(50).selectExpr(
        "if(id = 0, 'c1', concat('x', id)) id", "'K' name", "false gluster_enabled", "'d' data_center_id"
    )
    dcs = spark.createDataFrame([("d", "D")], DATACENTER)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = inventory(dcs, clusters, hosts)
        assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
        missing = hosts.filter("cluster_id = 'x0'").count()
        assert len(df.collect()) == count - missing
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_spread_join_splits_what_is_hot_and_repeats_nothing(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    many = spark.range(0, 30_000, 1, 16).selectExpr("id", "if(id % 2 = 0, 'hot', concat('k', id % 500)) key")
    few = spark.range(500).selectExpr("if(id = 0, 'hot', concat('k', id)) key", "id as extra")
    few = few.groupBy("key").agg(F.max("extra").alias("extra"))
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for how in ("inner", "left", "left_semi", "left_anti"):
            plain = many.join(few, "key", how).select("id", "key")
            assert sorted(spread_join(many, few, ["key"], how).select("id", "key").collect()) == sorted(plain.collect())

        def ran(df):
            df.collect()
            return plan_of(df)

        assert "skew=true" not in ran(many.join(few, "key"))
        assert "skew=true" in ran(spread_join(many, few, ["key"], "inner"))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_listing(rows, spark, tmp_path):
    lines = [row.line for row in list_hosts(inventory(*_tables(rows))).collect()]
    assert lines[0] == "%-20s | %-20s | %-20s | %-7s | %s" % ("East", "Prod", "h1", "True", "True")
    assert [line.split(" | ")[2].strip() for line in lines] == ["h1", "h2", "h3", "h4", "h5", "h8"]
    assert LISTING_HEADER.startswith("Data Center          | Cluster ")
    printed = [row.line for row in listing_report(inventory(*_tables(rows))).collect()]
    asked = "Host list (datacenter=None, cluster=None, host=None):"
    assert printed == [asked, LISTING_HEADER, *lines]
    assert selection_line(["a", "b*"], None, ["c"]) == "Host list (datacenter=None, cluster=c, host=a,b*):"
    write_listing(inventory(*_tables(rows)), str(tmp_path / "out"))
    assert sorted(row.value for row in spark.read.text(str(tmp_path / "out")).collect()) == sorted(printed)


def test_pages(spark):
    names = [f"k{number:05d}" for number in range(1234)]
    shuffled = names[:]
    random.Random(1).shuffle(shuffled)
    df = spark.createDataFrame([(name,) for name in shuffled], "id string").repartition(5)
    assert [row.id for row in page(df, 3, ["id"]).collect()] == names[200:300]
    assert page(df, 14, ["id"]).count() == 0
    assert [row.id for row in page_after(df, "id", "k00999", 10).collect()] == names[1000:1010]
    got = {row.id: row.page for row in with_page_number(df, ["id"]).collect()}
    assert got == {name: number // 100 + 1 for number, name in enumerate(names)}


def test_deep_pages_are_no_top_k(spark, monkeypatch):
    df = spark.range(2_000).selectExpr("concat('k', lpad(id, 5, '0')) id", "id % 7 n", "'x' more").repartition(5)
    df = df.union(df.filter("n = 3"))  # repeated rows
    wanted = [row.id for row in df.orderBy("id").collect()]
    numbered = with_page_number(df, ["id"], 100)
    assert numbered.columns == ["id", "n", "more", "page"]
    assert sorted(row.id for row in numbered.collect()) == wanted
    monkeypatch.setattr(paging, "NEAR_ROWS", 500)
    deep = page(df, 9, ["id"], 100)
    assert [row.id for row in deep.collect()] == wanted[800:900]
    assert "TakeOrdered" not in plan_of(deep)


def test_pages_with_ties_neither_overlap_nor_lose_rows(spark, monkeypatch):
    monkeypatch.setattr(paging, "NEAR_ROWS", 500)
    rows = spark.range(1000).repartition(5).select((F.col("id") % 2).alias("key"), "id")
    pages = [[r["id"] for r in page(rows, number, ["key"], 100).collect()] for number in (1, 4, 5, 6, 7)]
    assert [len(set(p)) for p in pages] == [100] * 5
    assert len({i for p in pages for i in p}) == 500
    numbered = {r["id"]: r["page"] for r in with_page_number(rows, ["key"], 100).collect()}
    assert [{numbered[i] for i in p} for p in pages] == [{1}, {4}, {5}, {6}, {7}]
