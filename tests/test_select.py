import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from helpers import HOST_SCHEMA, plan_of
from fleetlens.operators import select

FLEET = [
    ("Legacy", "1", "LegacyCluster", False, "192.168.122.11", False, True),
    ("Legacy", "2", "NewCluster", True, "192.168.125.42", True, True),
    ("Legacy", "2", "NewCluster", True, "192.168.125.15", True, False),
    ("London", "3", "NewCluster", False, "node1.example.com", True, True),
    ("London", "3", "NewCluster", False, "node[2].example.com", False, True),
    ("", "", "", False, "10.0.0.11", False, False),
]


@pytest.fixture
def fleet(rows):
    return rows(HOST_SCHEMA, *FLEET)


def addresses(df):
    return sorted(row.address for row in df.collect())


def brute(hosts=None, datacenters=None, clusters=None):
    def hit(values, text):
        return not values or any(fnmatch.fnmatchcase(text, value) for value in values)

    return sorted(row[4] for row in FLEET if hit(hosts, row[4]) and hit(datacenters, row[0]) and hit(clusters, row[2]))


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"hosts": ["*.11"]},
        {"hosts": ["*.11", "*.15"]},
        {"clusters": ["L*"], "hosts": ["*.11", "*.15"]},
        {"datacenters": ["L*"], "hosts": ["*.example.com"]},
        {"hosts": ["192.168.125.42", "node[1-3]*"]},
        {"hosts": ["nothing*"]},
        {"datacenters": [""]},
        {"clusters": ["[!N]*", ""]},
    ],
)
def test_options_narrow_each_other(fleet, options):
    assert addresses(select.select_hosts(fleet, **options)) == brute(**options)


def test_names_resolve_both_ways(fleet, rows):
    aliases = rows(
        "name string, ip string",
        ("web", "10.0.0.11"),
        ("node1.example.com", "172.16.0.1"),
        ("192.168.122.11", "old-name"),
        ("web", "10.0.0.99"),
    )
    wanted = rows("name string", ("192.168.125.42",), ("web",), ("172.16.0.1",), ("nobody",), ("web",), (None,))
    got = {tuple(row) for row in select.resolve_names(fleet, wanted, aliases).collect()}
    assert got == {
        ("192.168.125.42", "192.168.125.42", "direct"),
        ("web", "10.0.0.11", "name"),
        ("172.16.0.1", "node1.example.com", "address"),
    }
    assert [row.name for row in select.unknown_hosts(fleet, wanted, aliases).collect()] == ["nobody"]
    assert {row.name for row in select.unknown_hosts(fleet, wanted).collect()} == {"web", "172.16.0.1", "nobody"}
    assert addresses(select.select_wanted(fleet, wanted)) == ["192.168.125.42"]


def test_second_direction_waits_for_the_first(fleet, rows):
    aliases = rows("name string, ip string", ("web", "10.0.0.11"), ("192.168.122.11", "web"))
    wanted = rows("name string", ("web",))
    got = [tuple(row) for row in select.resolve_names(fleet, wanted, aliases).collect()]
    assert got == [("web", "10.0.0.11", "name")]
    more = rows("name string", ("web",), ("nobody",))
    got = {tuple(row) for row in select.resolve_names(fleet, more, aliases).collect()}
    assert got == {("web", "10.0.0.11", "name"), ("web", "192.168.122.11", "address")}


def test_selection_with_aliases(fleet, rows):
    aliases = rows("name string, ip string", ("web", "10.0.0.11"))
    got = select.select_hosts(fleet, hosts=["web", "node1.example.com", "*.42"], datacenters=["L*", ""], aliases=aliases)
    assert addresses(got) == ["10.0.0.11", "192.168.125.42", "node1.example.com"]


def test_one_per_cluster(fleet):
    got = {(row.cluster, row.address) for row in select.one_per_cluster(fleet).collect()}
    assert got == {("LegacyCluster", "192.168.122.11"), ("NewCluster", "192.168.125.42"), ("", "10.0.0.11")}
    by_id = {(row.cluster_id, row.address) for row in select.one_per_cluster(fleet, "cluster_id").collect()}
    assert by_id == {
        ("1", "192.168.122.11"), ("2", "192.168.125.42"), ("3", "node1.example.com"), ("", "10.0.0.11"),
    }


def test_a_down_spm_host_beats_an_up_one(rows):
    df = rows(HOST_SCHEMA, ("d", "1", "c", False, "a", False, True), ("d", "1", "c", False, "b", True, False))
    row = select.one_per_cluster(df).first()
    assert (row.address, row.is_spm, row.is_up) == ("b", True, False)
    assert select.one_per_cluster(df).columns == df.columns


def test_chain_hosts(fleet):
    assert {tuple(row) for row in select.chain_hosts(fleet).collect()} == {
        ("Legacy", "192.168.125.42"), ("London", "node1.example.com"), ("", None),
    }
    only_up = fleet.filter(~F.col("is_spm"))
    assert {tuple(row) for row in select.chain_hosts(only_up).collect()} == {
        ("Legacy", None), ("London", None), ("", None),
    }
    assert {tuple(row) for row in select.chain_hosts(only_up, fallback_to_up=True).collect()} == {
        ("Legacy", "192.168.122.11"), ("London", "node[2].example.com"), ("", None),
    }
    flagged = [row.address for row in select.with_chain_flag(fleet).collect() if row.is_chain_host]
    assert sorted(flagged) == ["192.168.125.42", "node1.example.com"]


def test_summary(fleet, spark):
    assert tuple(select.selection_summary(fleet, fleet).first()) == (6, 6, True, False)
    some = select.select_hosts(fleet, hosts=["*.11"])
    assert tuple(select.selection_summary(fleet, some).first()) == (6, 2, False, False)
    nothing = fleet.filter("false")
    assert tuple(select.selection_summary(nothing, nothing).first()) == (0, 0, False, False)


def test_short_globs_and_whole_fleets(spark):
    """Globs as short as the usual options, one that takes every host, and one ip for half of all names."""
    df = spark.range(4_000).selectExpr("concat('A', id, if(id % 10 = 7, '7', 'x')) address", "id n")
    for globs in (["*7"], ["A*"], ["*7", "A1*", "?1*"]):
        table = spark.createDataFrame([(glob,) for glob in globs], "pattern string")
        got = sorted(row.address for row in select.match_patterns(df, table).collect())
        assert got == sorted(r.address for r in df.collect() if any(fnmatch.fnmatchcase(r.address, g) for g in globs))
    fleet = spark.createDataFrame([("d", "1", "c", False, f"h{i}", False, True) for i in range(50)], HOST_SCHEMA)
    aliases = spark.range(4_000).selectExpr("concat('name', id) name", "if(id % 2 = 0, 'h0', concat('h', id)) ip")
    wanted = aliases.select("name")
    found = select.resolve_names(fleet, wanted, aliases).collect()
    assert sum(row.address == "h0" for row in found) == 2_000
    assert select.unknown_hosts(fleet, wanted, aliases).count() == 4_000 - 2_000 - 25


def test_pattern_table_is_a_keyed_join_and_exact(spark):
    rng = random.Random(11)
    pool = ["host-0000000000000000-", "h", "rack1.", "", "zz%_"]
    names = [rng.choice(pool) + "".join(rng.choice("ab1.") for _ in range(rng.randrange(6))) for _ in range(400)]
    patterns = ["*", "host-0000000000000000-a*", "*b1", "h[ab]*", "rack1.?", "*[!a]", "", "zz%_*1", "[", "*a*b*"]
    for chosen in (patterns[1:], patterns[:1], patterns[2:4], ["none*"]):
        df = spark.createDataFrame([(name, i) for i, name in enumerate(names)], "address string, n int")
        table = spark.createDataFrame([(p,) for p in chosen] + [(None,)], "pattern string")
        matched = select.match_patterns(df, table)
        got = sorted(row.n for row in matched.collect())
        assert got == [i for i, name in enumerate(names) if any(fnmatch.fnmatchcase(name, p) for p in chosen)]
    assert "NestedLoop" not in plan_of(matched) and "Cartesian" not in plan_of(matched)


def test_hits_of_hot_parts_are_made_once_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(select, "MET", 50)
    names = [f"host-{i:04d}x{i % 7}" for i in range(400)]
    patterns = ["*x*", "*00*", "*x3*", "host-*", "*-0?1*", "*none*", "*x*"]
    df = spark.createDataFrame([(name,) for name in names * 2], "address string")
    table = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    hits = select.pattern_hits(df, table)
    wanted = sorted((p, n) for p in set(patterns) for n in names if fnmatch.fnmatchcase(n, p))
    assert sorted((row.pattern, row.value) for row in hits.collect()) == wanted
    plan = plan_of(hits)
    assert "BuildLeft" not in plan and "SortMergeJoin" in plan and "keys=[pattern#0, value" not in plan
    assert hits.rdd.getNumPartitions() == 4
