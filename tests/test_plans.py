import pytest
from pyspark.sql import functions as F

from fleetlens.plans import collect
from fleetlens.plans.tiers import BASE_REPORTS, LOWEST_REPORTS, TIER_30_REPORTS, by_tier, host_tiers, tier_of
from helpers import HOST_SCHEMA

TIERS = host_tiers("prod")


@pytest.mark.parametrize(
    "version, tier",
    [
        ("1.6", None), ("1.7", 17), ("2.1", 17), ("2.2", 22), ("2.9.9", 22), ("3.0", 30), ("3.1", 30), ("3.2", 32),
        ("3.3", 33), ("3.4", 34), ("3.5", 35), ("3.6", 36), ("3.9", 36), ("3.10", 36), ("4.0", 40), ("4.10.2", 40),
        ("4", 40), ("3", 30), ("", None), ("x.1", None), (None, None), ("4.x", None), ("99999999999.1", None),
    ],
)
def test_tiers(rows, version, tier):
    assert rows("v string", (version,)).select(tier_of(F.col("v"), TIERS)).first()[0] == tier


def test_no_report_is_named_twice():
    for tier in TIERS:
        names = [*tier.leading, *(BASE_REPORTS if tier.takes_base else ()), *tier.reports]
        assert len(names) == len(set(names))
        assert not any("," in name for name in names)


@pytest.fixture
def plan(rows):
    hosts = [
        ("d", "1", "c", True, "h40", True, True),
        ("d", "1", "c", False, "h36", False, True),
        ("e", "2", "c", False, "h35", True, True),
        ("f", "3", "c", False, "h34", True, True),
        ("g", "4", "c", True, "h30", False, True),
        ("g", "4", "c", True, "h22", False, True),
        ("g", "4", "c", True, "h17", False, True),
        ("g", "4", "c", True, "h10", False, True),
        ("h", "4", "c", False, "unknown", True, True),
    ]
    versions = rows(
        "host string, version string, plugins string",
        *[(f"h{n}", f"{n // 10}.{n % 10}", "" if n == 35 else "vdsm.dump-volume-chains") for n in (40, 36, 35, 34, 30, 22, 17, 10)],
    )

    def build(**options):
        df = collect.collection_plan(rows(HOST_SCHEMA, *hosts), versions, TIERS, **options)
        return {row.address: row for row in df.collect()}

    return build


def test_host_plans(plan):
    got = plan()
    base, tier30 = ",".join(BASE_REPORTS), ",".join(TIER_30_REPORTS)
    assert got["h40"].command == "sos report" and got["h36"].command == "sosreport"
    assert got["h40"].options == "-k vdsm.dump-volume-chains --batch --all-logs"
    assert got["h36"].options == got["h35"].options == got["h34"].options == "--batch --all-logs"
    assert got["h40"].reports.startswith(f"logs,{base},gluster,processor,pci,md,block,scsi")
    assert got["h40"].reports.endswith("virsh,collectd,prod_imageio,date,host,prod_node,ovn_host")
    assert got["h35"].reports == f"logs,{base},{tier30},firewalld,openvswitch,prod_hosted_engine,virsh,collectd,prod_imageio"
    assert got["h30"].reports == f"logs,{base},gluster,{tier30}"
    assert got["h30"].options == "--batch -k logs.all_logs=True"
    assert got["h22"].reports == f"general,{base},gluster"
    assert got["h22"].options == "--batch -k general.all_logs=True"
    assert got["h17"].reports == ",".join(LOWEST_REPORTS)
    assert got["h17"].options == "--no-progressbar -k general.all_logs=True"
    for name in ("h10", "unknown"):
        assert (got[name].status, got[name].reports, got[name].options, got[name].command) == ("unsupported", None, None, None)
    assert got["h35"].is_chain_host and got["h34"].is_chain_host


def test_the_latest_version_counts(rows):
    hosts = rows(HOST_SCHEMA, ("d", "1", "c", False, "h", False, True))
    versions = rows("host string, version string", ("h", "3.6"), ("h", "4.0"), ("h", "3.10"), ("h", None))
    got = collect.collection_plan(hosts, versions, TIERS).collect()
    assert [(row.version, row.tier) for row in got] == [("4.0", 40)]


def test_tier_values_are_taken_as_they_are(rows):
    odd = "it's \\ n"
    shown = rows("tier int", (17,), (40,)).select(by_tier("tier", TIERS, lambda tier: odd if tier.name == 40 else ""))
    assert [row[0] for row in shown.collect()] == ["", odd]


@pytest.mark.parametrize("size, logs", [(99, False), (100, True), (0, True)])
def test_size_cap(plan, size, logs):
    got = plan(log_size=size, ticket="7")
    assert got["h36"].reports.startswith("logs,") == logs
    cap = f" --log-size={size}" if size else ""
    assert got["h36"].options == f"--ticket-number=7{cap} --batch" + ("" if size else " --all-logs")
    assert got["h22"].options == f"--ticket-number=7{cap} --batch -k general.all_logs=True"


ENGINE = (
    "host string, version string, plugins string, log_size int, ticket string, upload string, "
    "sensitive_keys string, warehouse_keys string"
)


def test_engine_plans(rows):
    df = rows(
        ENGINE,
        ("new", "4.2", "prod.sensitive_keys prod-engine.sensitive_keys rhv_analyzer", None, None, None, "A,B", "B,C"),
        ("dwh", "3.6", "prod-engine.sensitive_keys prod_engine_dwh.sensitive_keys", 100, "5", "u", "A", "W"),
        ("mid", "3.1", "engine.sensitive_keys prod_provider_ovn prod_engine_reports", 99, None, None, None, None),
        ("old", "2.2", "nothing", None, None, None, None, None),
    )
    got = {row.host: row for row in collect.engine_plan(df, "prod").collect()}
    assert got["new"].plugin == "prod" and got["new"].command == "sos report"
    assert got["new"].options == "--batch --build -k rpm.rpmva=off -k apache.log=True -k prod.sensitive_keys=A:B:C --all-logs"
    assert got["new"].reports.endswith("prod_imageio,date,host,ovn_central,grafana,rhv_analyzer,logs")
    assert got["dwh"].options == (
        "--batch --build -k rpm.rpmva=off -k apache.log=True -k prod-engine.sensitive_keys=A -k prod_engine_dwh.sensitive_keys=W "
        "--ticket-number=5 --log-size=100 --upload=u"
    )
    assert got["dwh"].reports.endswith("grafana,logs,prod_engine_dwh")
    assert got["mid"].options == "--batch --build -k rpm.rpmva=off -k apache.log=True --log-size=99"
    assert got["mid"].reports.endswith("systemd,general,prod_provider_ovn,prod_engine_reports")
    assert got["old"].options == "--batch --build -k rpm.rpmva=off -k apache.log=True --report --report -k general.all_logs=True"
    assert got["old"].reports == "prod,rpm,libvirt,networking,hardware,process,filesys,devicemapper,selinux,kernel,apache,memory,general"
    bare = {row.host: row.options for row in collect.engine_plan(df, "prod", include_sensitive=True).collect()}
    assert "-k prod.sensitive_keys=: -k prod_engine_dwh.sensitive_keys=:" in bare["new"]


def test_database_plans(rows):
    df = rows(
        "host string, version string, ticket string, log_size int, dbname string, port int, user string, has_password boolean",
        ("db", "4.0", "9", 10, "engine", 5432, "postgres", True),
        ("old", "2.2", None, None, "engine", 5432, "postgres", True),
        ("locked", "4.0", None, None, "engine", 5432, "postgres", False),
    )
    got = {row.host: tuple(row)[1:] for row in collect.database_plan(df).collect()}
    tail = "-k postgresql.dbname=engine -k postgresql.dbhost={} -k postgresql.dbport=5432 -k postgresql.username=postgres"
    assert got == {
        "db": ("sos report", "postgresql", "--batch --ticket-number=9 --log-size=10 " + tail.format("db")),
        "old": ("sosreport", "postgresql", "--batch --report " + tail.format("old")),
        "locked": (None, None, None),
    }
