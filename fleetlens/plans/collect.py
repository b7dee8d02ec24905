"""Collection plans: reports and options per host, management node and database."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import only_if, options, strings
from ..functions.versions import at_least, version_key
from ..operators.select import with_chain_flag
from .tiers import (
    BASE_REPORTS,
    CHAIN_REPORT,
    GLUSTER_REPORT,
    LOGS_FROM_MIB,
    LOGS_REPORT,
    Tier,
    by_tier,
    tier_of,
)

# The reports of a management node, after its own plugin.
ENGINE_REPORTS = (
    "rpm", "libvirt", "networking", "hardware", "process", "filesys",
    "devicemapper", "selinux", "kernel", "apache", "memory",
)
# What the versions from 3.0, 3.2, 3.4 and 3.6 on add, and what those below 3.6 have.
ENGINE_FROM_30 = ("block", "java", "lvm2", "md", "pci", "processor", "scsi", "chrony", "systemd")
ENGINE_FROM_32 = ("firewalld", "openvswitch")
ENGINE_FROM_34 = ("collectd",)
ENGINE_BELOW_36 = ("general",)
ENGINE_FROM_36 = ("date", "host", "ovn_central", "grafana")
ENGINE_ANALYZER = "rhv_analyzer"  # fixed value
# Options of every management node; how it and a database are run.
ENGINE_OPTIONS = ("-k rpm.rpmva=off", "-k apache.log=True")
ENGINE_MODE = "--batch --build"
DATABASE_MODE = "--batch"
DATABASE_REPORT = "postgresql"  # fixed value


def _given(value: object) -> Column:
    """An argument or a column as a column."""
    return value if isinstance(value, Column) else F.lit(value)


def _flag(name: str, value: Column) -> Column:
    """``name=value`` when the value is set and not empty."""
    return F.concat(F.lit(name + "="), F.nullif(value.cast("string"), F.lit("")))


def _capped(size: Column) -> Column:
    """A size cap of 0 is no cap."""
    return F.coalesce(size.cast("int") != 0, F.lit(False))


def _size_flag(size: Column) -> Column:
    return F.when(_capped(size), _flag("--log-size", size))


def keeps_logs(size: Column) -> Column:
    """The logs report is taken without a size cap, or with one of 100 MiB or more."""
    return ~_capped(size) | (size.cast("int") >= LOGS_FROM_MIB)


def version_tiers(versions: DataFrame, tiers: Sequence[Tier]) -> DataFrame:
    """(host, version) with its tier; null means no usable reporter."""
    return versions.select("host", "version", tier_of(F.col("version"), tiers).alias("tier"))


def collection_plan(
    selected: DataFrame,
    versions: DataFrame,
    tiers: Sequence[Tier],
    ticket: str | None = None,
    log_size: int | None = None,
) -> DataFrame:
    """One row per chosen host: tier, command, reports, options.

    ``versions`` is (host, version) and may have ``plugins``, the host's plugin
    list; where that is given, the volume chains are only dumped if it names
    them. Hosts below the lowest tier have status ``unsupported`` and no reports.
    """
    plugins = F.col("plugins") if "plugins" in versions.columns else F.lit(CHAIN_REPORT)
    # A host that reported several versions counts by the latest of them.
    rank = F.struct(version_key(F.col("version")), "version", plugins.alias("plugins"))
    latest = versions.groupBy("host").agg(F.max(rank).alias("_last"))
    plugins = F.col("plugins")
    known = latest.select("host", "_last.version", "_last.plugins").select(
        F.col("host").alias("address"),
        "version",
        tier_of(F.col("version"), tiers).alias("tier"),
        F.coalesce(plugins.contains(CHAIN_REPORT), F.lit(False)).alias("_can_chain"),
    )
    size = _given(log_size)

    def joined(names: Callable[[Tier], Sequence[str]], separator: str) -> Column:
        return F.nullif(by_tier("tier", tiers, lambda tier: separator.join(names(tier))), F.lit(""))

    def allowed(name: str) -> Column:
        return by_tier("tier", tiers, lambda tier: getattr(tier, name))

    reports = F.concat_ws(
        ",",
        joined(lambda tier: tier.leading, ","),
        F.when(allowed("takes_logs") & keeps_logs(size), LOGS_REPORT),
        joined(lambda tier: BASE_REPORTS if tier.takes_base else (), ","),
        F.when(allowed("takes_base") & F.col("gluster_enabled"), GLUSTER_REPORT),
        joined(lambda tier: tier.reports, ","),
    )
    chain = allowed("takes_chain") & F.col("is_chain_host") & F.col("_can_chain")
    option_text = options(
        _flag("--ticket-number", _given(ticket)),
        _size_flag(size),
        F.when(chain, f"-k {CHAIN_REPORT}"),
        joined(lambda tier: tier.options, " "),
        F.when(allowed("takes_all_logs") & ~_capped(size), "--all-logs"),
    )
    supported = F.col("tier").isNotNull()
    return (
        with_chain_flag(selected)
        .join(known, "address", "left")
        .select(
            "datacenter",
            "cluster",
            "address",
            "version",
            "tier",
            "is_chain_host",
            by_tier("tier", tiers, lambda tier: tier.command).alias("command"),
            F.when(supported, reports).alias("reports"),
            F.when(supported, option_text).alias("options"),
            F.when(supported, "ok").otherwise("unsupported").alias("status"),
        )
    )


def engine_plugin(plugins: Column, product: str) -> Column:
    """The management plugin: the first name whose key option the list holds."""
    names = (product, f"{product}-engine", "engine")
    held = [F.when(plugins.contains(f"{name}.sensitive_keys"), name) for name in names]
    return F.coalesce(*held, F.lit(product))


def engine_plan(nodes: DataFrame, product: str, include_sensitive: bool = False) -> DataFrame:
    """One row per management node: command, reports, options.

    Input is (host, version, plugins, log_size, ticket, upload, sensitive_keys,
    warehouse_keys); only the first three may not be null. Key lists are comma
    lists. Warehouse keys go to the warehouse plugin if the node has it, else they
    join the node's own keys. ``include_sensitive`` turns masking off.
    """
    version, plugins, size = F.col("version"), F.col("plugins"), F.col("log_size")
    warehouse = f"{product}_engine_dwh"
    has_warehouse = plugins.contains(f"{warehouse}.sensitive_keys")
    plugin = engine_plugin(plugins, product)

    def colon(name: str) -> Column:
        return F.nullif(F.replace(F.col(name), F.lit(","), F.lit(":")), F.lit(""))

    own, extra = colon("sensitive_keys"), colon("warehouse_keys")
    if include_sensitive:
        own_keys = extra_keys = F.lit(":")
    else:
        both = F.array_join(F.array_distinct(F.split(F.concat_ws(":", own, extra), ":")), ":")
        own_keys = F.when(has_warehouse, own).otherwise(F.nullif(both, F.lit("")))
        extra_keys = F.when(has_warehouse, extra)

    v30, v32, v34, v35, v36, v40 = (
        at_least(version, major, minor) for major, minor in ((3, 0), (3, 2), (3, 4), (3, 5), (3, 6), (4, 0))
    )
    all_logs = (
        F.when(_capped(size), None)
        .when(~v30, "--report -k general.all_logs=True")
        .when(~v32, "-k logs.all_logs=True")
        .otherwise("--all-logs")
    )
    option_text = options(
        ENGINE_MODE,
        *ENGINE_OPTIONS,
        F.concat(F.lit("-k "), plugin, F.lit(".sensitive_keys="), own_keys),
        F.concat(F.lit(f"-k {warehouse}.sensitive_keys="), extra_keys),
        _flag("--ticket-number", F.col("ticket")),
        F.when(~v30, "--report"),
        _size_flag(size),
        all_logs,
        _flag("--upload", F.col("upload")),
    )
    logs = F.coalesce(F.when(_capped(size), size.cast("int") >= LOGS_FROM_MIB).otherwise(v30), F.lit(False))
    reports = F.concat(
        F.array(plugin),
        strings(ENGINE_REPORTS),
        only_if(v30, *ENGINE_FROM_30),
        only_if(v32, *ENGINE_FROM_32),
        only_if(v34, *ENGINE_FROM_34),
        only_if(v35, f"{product}_imageio"),
        only_if(~v36, *ENGINE_BELOW_36),
        only_if(v36, *ENGINE_FROM_36),
        only_if(v36 & plugins.contains(ENGINE_ANALYZER), ENGINE_ANALYZER),
        only_if(plugins.contains(f"{product}_provider_ovn"), f"{product}_provider_ovn"),
        only_if(logs, LOGS_REPORT),
        only_if(has_warehouse, warehouse),
        only_if(plugins.contains(f"{product}_engine_reports"), f"{product}_engine_reports"),
    )
    return nodes.select(
        "host",
        "version",
        plugin.alias("plugin"),
        F.when(v40, "sos report").otherwise("sosreport").alias("command"),
        F.array_join(reports, ",").alias("reports"),
        option_text.alias("options"),
    )


def database_plan(databases: DataFrame) -> DataFrame:
    """One row per database: command, report, options; null without a password.

    Input is (host, version, ticket, log_size, dbname, port, user, has_password).
    """
    v30, v40 = at_least(F.col("version"), 3, 0), at_least(F.col("version"), 4, 0)
    key = f"-k {DATABASE_REPORT}."
    option_text = options(
        DATABASE_MODE,
        _flag("--ticket-number", F.col("ticket")),
        _size_flag(F.col("log_size")),
        F.when(~v30, "--report"),
        F.concat(F.lit(key + "dbname="), F.col("dbname")),
        F.concat(F.lit(key + "dbhost="), F.col("host").cast("string")),
        F.concat(F.lit(key + "dbport="), F.col("port").cast("string")),
        F.concat(F.lit(key + "username="), F.col("user")),
    )
    asked = F.coalesce(F.col("has_password"), F.lit(False))
    return databases.select(
        "host",
        F.when(asked, F.when(v40, "sos report").otherwise("sosreport")).alias("command"),
        F.when(asked, DATABASE_REPORT).alias("report"),
        F.when(asked, option_text).alias("options"),
    )
