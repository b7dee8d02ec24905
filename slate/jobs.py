"""The registered queries, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.globs import sift_column
from fleetlens.functions.names import bundle_name, stem, without_extension
from fleetlens.functions.text import comma_list
from fleetlens.functions.versions import version_key
from fleetlens.operators import bundle, drift, inventory, listing, logs, paging, redact, reports, sections
from fleetlens.operators import select, settings, status
from fleetlens.operators.asof import as_of
from fleetlens.operators.carry import carry_down
from fleetlens.operators.joined import ordered_text
from fleetlens.plans import collect
from fleetlens.plans.tiers import host_tiers
from fleetlens.functions.text import megabytes
from fleetlens.sources.reports import collected_files, host_listings, read_tree_manifest
from fleetlens.sources.settings import parse_pairs, section_settings, section_settings_of_lines, service_settings

from . import views as v

TIERS = host_tiers(v.PRODUCT)
TEMPLATE = "run %(key_1)s at 100%% -p %(key_2)s:%(key_4)s"
DEFAULTS = {"key_0": "zero", "key_5": "five"}

Query = Callable[[SparkSession, str], DataFrame]


def fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inventory(v.datacenter(spark, sf_dir), v.cluster(spark, sf_dir), v.host(spark, sf_dir))


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.orphans(v.datacenter(spark, sf_dir), v.cluster(spark, sf_dir), v.host(spark, sf_dir))


def page_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page(v.host(spark, sf_dir).select("address", "status", "cluster_id"), 3, ["address"])


def page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.with_page_number(v.host(spark, sf_dir).select("address"), ["address"])


def select_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.select_hosts(
        fleet(spark, sf_dir), hosts=["*7", "*1"], datacenters=["A*"], clusters=["CL_*"]
    )


def select_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.select_hosts(
        fleet(spark, sf_dir), hosts=["*[!0-6][13]", "Customer#00000000?"], clusters=["CL_[0-3]", "CL_7", ""]
    )


def select_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.select_wanted(fleet(spark, sf_dir), v.wanted(spark, sf_dir))


def select_glob_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.match_patterns(fleet(spark, sf_dir), v.pattern(spark, sf_dir))


def select_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literals, an alias and a pattern; then one host per cluster."""
    return select.select_hosts(
        fleet(spark, sf_dir),
        hosts=["Customer#000000003", "Supplier#000000004", "*[2-9]"],
        datacenters=["A*", "*E*", ""],
        aliases=v.alias(spark, sf_dir),
        per_cluster=True,
    )


def alias_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.resolve_names(fleet(spark, sf_dir), v.wanted(spark, sf_dir), v.alias(spark, sf_dir))


def alias_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.resolve_names(fleet(spark, sf_dir), v.wanted(spark, sf_dir), v.alias_both(spark, sf_dir))


def unknown_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.unknown_hosts(fleet(spark, sf_dir), v.wanted(spark, sf_dir), v.alias(spark, sf_dir))


def unknown_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_text(unknown_hosts(spark, sf_dir), "name", chunk=200)


def cluster_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_text(fleet(spark, sf_dir), "address", ["datacenter", "cluster"], separator=",", chunk=500)


def selected_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = fleet(spark, sf_dir)
    every = select.selection_summary(hosts, select.select_hosts(hosts, hosts=["Cust*"]))
    some = select.selection_summary(hosts, select.select_hosts(hosts, datacenters=["ASIA"], clusters=["CL_0"]))
    return every.select(F.lit("Cust*").alias("selection"), "*").union(some.select(F.lit("ASIA, CL_0"), "*"))


def one_per_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.one_per_cluster(fleet(spark, sf_dir))


def chain_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.chain_hosts(fleet(spark, sf_dir))


def chain_host_any_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.chain_hosts(fleet(spark, sf_dir), fallback_to_up=True)


def chain_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.with_chain_flag(fleet(spark, sf_dir)).select("datacenter", "address", "is_chain_host")


def list_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.list_hosts(select.select_hosts(fleet(spark, sf_dir), hosts=["*7"], datacenters=["A*"]))


def list_all_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.list_hosts(fleet(spark, sf_dir))


def listing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = {"hosts": ["*7"], "datacenters": ["A*", "E*"]}
    chosen = select.select_hosts(fleet(spark, sf_dir), **options)
    return listing.listing_report(chosen, **options)


def sift_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    sifted = sift_column(comma_list(F.col("option_value")))
    return v.selection(spark, sf_dir).select(
        "selection_id",
        F.array_join(F.array_sort(sifted["patterns"]), "|").alias("patterns"),
        F.array_join(F.array_sort(sifted["literals"]), "|").alias("literals"),
    )


def version_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collect.version_tiers(v.version(spark, sf_dir), TIERS)


def collection_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collect.collection_plan(fleet(spark, sf_dir), v.host_version(spark, sf_dir), TIERS)


def collection_plan_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collect.collection_plan(fleet(spark, sf_dir), v.several_versions(spark, sf_dir), TIERS)


def collection_plan_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collect.collection_plan(
        fleet(spark, sf_dir), v.host_version(spark, sf_dir), TIERS, ticket="4711", log_size=50
    )


def engine_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collect.engine_plan(v.engine(spark, sf_dir), v.PRODUCT)


def engine_plan_unmasked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collect.engine_plan(v.engine(spark, sf_dir), v.PRODUCT, include_sensitive=True)


def database_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collect.database_plan(v.database(spark, sf_dir))


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_lines(v.report(spark, sf_dir))


def first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = reports.report_lines(v.report(spark, sf_dir))
    return reports.first_match(lines, F.col("line").contains("token"))


def report_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_refs(v.collector_output(spark, sf_dir), "/scratch")


def report_refs_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_refs_of_lines(reports.report_lines(v.collector_output(spark, sf_dir)), "/scratch")


def section_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.section_lookup(v.report(spark, sf_dir), "###")


def section_lookup_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.section_lookup_of_lines(reports.report_lines(v.report(spark, sf_dir)), "###")


def credential_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.section_lookup_of_lines(v.credential_line(spark, sf_dir), user="admin7")


def clock_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.clock_drift(v.clock(spark, sf_dir)).select(
        "probe_id", "host", "host_time_text", "engine_time_text", "drift_us", "drift", "outcome"
    )


def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.drift_report(v.clock(spark, sf_dir))


def effective_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settings.effective_settings(v.setting(spark, sf_dir), renamed={})


def renamed_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old keys in the file layers: one whose new key is set there too, one whose is not."""
    return settings.effective_settings(
        v.setting(spark, sf_dir), renamed={"key_1": "key_2", "key_3": "key_new"}
    )


def render_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settings.render_template(settings.effective_settings(v.run_setting(spark, sf_dir)), TEMPLATE)


def settings_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    effective = settings.effective_settings(v.run_setting(spark, sf_dir))
    return settings.settings_check(effective, ["key_1", "key_2", "key_3"])


def default_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.run_setting(spark, sf_dir)
    asked = rows.select("run_id", "key").distinct()
    return settings.with_defaults(settings.effective_settings(rows), DEFAULTS, asked)


def sectioned_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections, defaults below them, and old keys in either."""
    files = v.sectioned_file(spark, sf_dir)
    run = F.concat(F.lit("run-"), "doc_id")
    rows = section_settings(files, "Tool", F.col("file").endswith("/tool.conf"), run)
    return settings.effective_settings(rows)


def service_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = service_settings(v.service_file(spark, sf_dir), F.col("layer"), F.concat(F.lit("run-"), "doc_id"))
    return settings.effective_settings(rows, renamed={})


def host_listing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_listings(v.listing_file(spark, sf_dir))


def collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collected_files(v.landed_file(spark, sf_dir), "/landing").select("bundle", "path", "length")


def key_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_pairs(v.report(spark, sf_dir))


def redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact.redact_rows(v.report(spark, sf_dir), ["token", "password", "api_key", "secret"], "text")


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle.file_manifest(v.bundle_file(spark, sf_dir))


def bundle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = v.bundle_file(spark, sf_dir)
    return bundle.bundle_manifest(files.select("bundle", F.octet_length("content").alias("length")))


def bundle_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle.bundle_messages(bundle.file_manifest(v.bundle_file(spark, sf_dir)), "/var/tmp/bundles")


def host_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = v.host(spark, sf_dir).select(
        F.col("address").alias("host"), F.concat(F.lit("/var/tmp/sosreport-"), "address", F.lit(".tar.xz")).alias("path")
    )
    return bundle.host_files(placed)


def database_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle.database_files(v.database_file(spark, sf_dir))


def bundle_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = v.table(spark, sf_dir, "events").select(
        "event_id",
        bundle_name("fleet", F.col("ts"), F.when(F.col("event_id") % 3 == 0, F.col("user_id"))).alias("name"),
    )
    return named.select(
        "event_id", "name", without_extension(F.col("name")).alias("uncompressed"), stem(F.col("name")).alias("folder")
    )


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.run_status(v.run_event(spark, sf_dir))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parse_log_lines(v.log_line(spark, sf_dir))


def log_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = logs.route_records(logs.parse_log_lines(v.log_line(spark, sf_dir)))
    return routed.select("seq", "level", "route")


def log_routes_quiet(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = logs.route_records(logs.parse_log_lines(v.log_line(spark, sf_dir)), quiet=True, log_file=False)
    return routed.select("seq", "level", "route")


def message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.message_lines(v.log_message(spark, sf_dir))


def carried_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = v.headed_line(spark, sf_dir)
    return carry_down(lines, F.col("header"), ["file"], "line_no", "under").select("file", "line_no", "under")


def sectioned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settings of ``sectioned_settings`` from a table of lines."""
    lines = reports.report_lines(v.sectioned_file(spark, sf_dir))
    main, run = F.col("file").endswith("/tool.conf"), F.concat(F.lit("run-"), "doc_id")
    return settings.effective_settings(section_settings_of_lines(lines, "Tool", main, run, ["doc_id", "file"]))


def landed_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies in the files of each bundle, read by ranges of a quarter of a megabyte."""
    files = read_tree_manifest(spark, v.landed_texts(spark, sf_dir), 1 << 18)
    # Folders are named bundle=<name>.
    name = F.substring_index("bundle", "=", -1)
    return files.groupBy(name.alias("bundle")).agg(
        F.sum("length").alias("bytes"), F.sum("feeds").alias("feeds"), megabytes(F.sum("length")).alias("size")
    )


def select_infix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.match_patterns(fleet(spark, sf_dir), v.infix_pattern(spark, sf_dir))


def glob_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = select.pattern_hits(v.host(spark, sf_dir), v.infix_pattern(spark, sf_dir))
    return hits.groupBy("pattern").agg(F.count("*").alias("hits"), F.max("value").alias("last_value"))


def tier_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_of(v.dated_probe(spark, sf_dir), v.dated_tier(spark, sf_dir), "at", "valid_from", ["line"])


def tier_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = v.version(spark, sf_dir).withColumn("key", version_key(F.col("version")))
    tiers = v.minimum_tier(spark, sf_dir).select("tier", version_key(F.col("minimum")).alias("minimum"))
    return as_of(hosts, tiers, "key", "minimum").drop("key")


def redact_by_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact.redact_by_node(
        v.node_line(spark, sf_dir), v.node_key(spark, sf_dir), "host", ["report_id", "line_no"]
    )


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = logs.route_records(logs.log_records(v.log_file(spark, sf_dir)))
    return routed.select("file", "line_no", "record_no", "part", "level", "route")


def run_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.run_outcome(v.run_exit(spark, sf_dir))


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.landed_pages(v.landed_page(spark, sf_dir))


def inventory_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inventory_changes(
        v.host(spark, sf_dir).select("address", "status", "cluster_id"), v.later_host(spark, sf_dir)
    )


QUERIES: dict[str, Query] = {
    "inventory": fleet,
    "orphans": orphans,
    "page_slice": page_slice,
    "page_numbers": page_numbers,
    "select_glob": select_glob,
    "select_class": select_class,
    "select_literal": select_literal,
    "select_glob_table": select_glob_table,
    "select_hosts": select_job,
    "sift_options": sift_options,
    "alias_match": alias_match,
    "alias_both_ways": alias_both_ways,
    "unknown_hosts": unknown_hosts,
    "selected_all": selected_all,
    "one_per_cluster": one_per_cluster,
    "chain_host": chain_host,
    "chain_host_any_up": chain_host_any_up,
    "chain_flag": chain_flag,
    "list_hosts": list_hosts,
    "list_all_hosts": list_all_hosts,
    "listing_report": listing_report,
    "version_tier": version_tier,
    "collection_plan": collection_plan,
    "collection_plan_latest": collection_plan_latest,
    "collection_plan_capped": collection_plan_capped,
    "engine_plan": engine_plan,
    "engine_plan_unmasked": engine_plan_unmasked,
    "database_plan": database_plan,
    "report_lines": report_lines,
    "first_match": first_match,
    "report_refs": report_refs,
    "report_refs_of_lines": report_refs_of_lines,
    "section_lookup": section_lookup,
    "section_lookup_of_lines": section_lookup_of_lines,
    "credential_lookup": credential_lookup,
    "clock_drift": clock_drift,
    "drift_report": drift_report,
    "effective_settings": effective_settings,
    "renamed_settings": renamed_settings,
    "render_template": render_template,
    "settings_check": settings_check,
    "default_settings": default_settings,
    "key_values": key_values,
    "sectioned_settings": sectioned_settings,
    "service_layers": service_layers,
    "host_listings": host_listing_files,
    "collected_files": collected,
    "redact": redacted,
    "file_manifest": file_manifest,
    "bundle_manifest": bundle_manifest,
    "bundle_messages": bundle_messages,
    "host_files": host_files,
    "database_files": database_files,
    "bundle_names": bundle_names,
    "run_status": run_status,
    "log_lines": log_lines,
    "log_routes": log_routes,
    "log_routes_quiet": log_routes_quiet,
    "message_lines": message_lines,
    "carried_headers": carried_headers,
    "sectioned_lines": sectioned_lines,
    "select_infix": select_infix,
    "glob_hits": glob_hits,
    "tier_by_date": tier_by_date,
    "tier_by_version": tier_by_version,
    "redact_by_node": redact_by_node,
    "log_records": log_records,
    "run_outcome": run_outcome,
    "landed_pages": landed_pages,
    "inventory_changes": inventory_changes,
    "landed_bundles": landed_bundles,
    "unknown_text": unknown_text,
    "cluster_text": cluster_text,
}
