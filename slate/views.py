"""Fleet-shaped inputs drawn from the test tables, each over the whole table.

``SQL`` holds the same definitions for DuckDB, by name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.reports import report_lines
from fleetlens.session import use_checkpoint_dir

PRODUCT = "fleet"

# Stated, so that opening a table does not first read a file to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The events' time has no zone; the jobs read it as UTC, like the SQL does.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def datacenter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr("cast(r_regionkey as string) id", "r_name name")


def cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as string) id",
        "concat('CL_', n_nationkey % 8) name",
        "n_nationkey % 3 = 0 gluster_enabled",
        "case when n_nationkey % 7 = 0 then null when n_nationkey = 13 then '99' "
        "else cast(n_regionkey as string) end data_center_id",
    )


def host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_name address",
        "c_name name",
        "case c_mktsegment when 'FURNITURE' then null when 'BUILDING' then 'maintenance' else 'up' end status",
        "case c_custkey % 50 when 0 then 'spm' when 1 then 'contending' else 'none' end spm_status",
        "case when c_custkey % 11 = 0 then null when c_custkey % 101 = 0 then '999' "
        "else cast(c_nationkey as string) end cluster_id",
    )


def alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_name name", "concat('Customer#', lpad(cast(s_suppkey as string), 9, '0')) ip"
    )


def alias_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases that also lead from some addresses to a wanted name; half of all names share one ip."""
    back = table(spark, sf_dir, "customer").selectExpr(
        "c_name",
        "case when c_custkey % 500 = 7 then concat('Supplier#', lpad(cast(c_custkey % 60 as string), 9, '0')) "
        "when c_custkey % 2 = 0 then 'shared-address' else concat('other-', c_custkey) end",
    )
    return alias(spark, sf_dir).union(back)


def wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .selectExpr("s_name name")
        .union(
            table(spark, sf_dir, "customer").selectExpr(
                "case when c_custkey % 250 = 3 then c_name else concat('gone-', c_name) end"
            )
        )
        .union(spark.sql("select explode(array('no-such-host', 'Customer#999999999'))"))
    )


def pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "case n_nationkey % 5 when 0 then concat('*', lpad(cast(n_nationkey as string), 2, '0'), '7') "
        "when 1 then concat('Customer#00000000', n_nationkey % 10, '*') "
        "when 2 then concat('*#000*', n_nationkey, '?') "
        "when 3 then concat('Customer#0000*[!0-7]', n_nationkey % 10, '[35]') "
        "else concat('*00', lpad(cast(n_nationkey * 3 as string), 3, '0')) end pattern"
    )


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr("doc_id report_id", "text")


def collector_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the lines a reporter prints, present in some and not in others."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id report_id",
        "concat(text, "
        "case doc_id % 4 when 0 then concat('\\n  /var/tmp/sosreport-', source, '-', doc_id, '.tar.xz \\n') "
        "when 1 then concat('\\nsosreport-', doc_id, '.tar.bz2\\nsosreport-second.tar.xz') else '' end, "
        "case doc_id % 3 when 0 then concat('\\nThe sha256sum is: ', lang, ': ', n_chars) "
        "when 1 then '\\nThe sha256sum is lost' else '' end) text",
    )


def clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probes whose host clock is some hours off, written in all the forms a clock is read in."""
    shifted = table(spark, sf_dir, "events").selectExpr(
        "*", "ts + make_dt_interval(0, 0, 0, (event_id % 7 - 3) * 40000) at"
    )
    return shifted.selectExpr(
        "event_id probe_id",
        "concat('user_', user_id) host",
        "case when event_id % 13 = 0 then 'garbage' "
        "when event_id % 17 = 0 then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") "
        "when event_id % 19 = 0 then date_format(at, \"yyyy-MM-dd'T'HH:mm'+00:00'\") "
        "when event_id % 23 = 0 then date_format(at, \"yyyyMMdd'T'HHmmss'Z'\") "
        "when event_id % 29 = 0 then date_format(at, \"yyyy-MM-dd HH:mm:ss',250+0000'\") "
        "else date_format(at, \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\") end host_time_raw",
        "cast(ts as timestamp) engine_time",
    )


def setting(spark: SparkSession, sf_dir: str, run: str = "'run'", key: str = "user_id % 40") -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        f"{run} run_id",
        "case event_type when 'view' then 0 when 'click' then 1 when 'signup' then 2 "
        "when 'purchase' then 3 else 4 end layer",
        "case event_type when 'click' then 'main' when 'signup' then concat('drop-in-', event_id % 3) end file",
        "event_id seq",
        f"concat('key_', {key}) key",
        "case when cast(get_json_object(props, '$.k') as int) % 10 = 0 then null "
        "else get_json_object(props, '$.k') end value",
    )


def run_setting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setting(spark, sf_dir, "concat('run_', user_id)", "event_id % 6")


def credential_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "user_id report_id",
        "event_id line_no",
        "case when event_type = 'error' and event_id % 9 = 0 then '# DB ADMIN credentials' "
        "when event_type = 'view' then concat('# note ', event_id) "
        "when event_id % 5 = 0 then '  ' "
        "else concat('db', event_id, ':', 5432 + event_id % 3, ':*:admin', event_id % 12, "
        "':p:', value, ' ') end line",
    )


def version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey host", "concat(p_size div 10, '.', p_size % 10) version"
    )


def host_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions and plugin lists of the hosts."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('Customer#', lpad(cast(p_partkey as string), 9, '0')) host",
        "concat(p_size div 10, '.', p_size % 10) version",
        "case when p_partkey % 150 = 0 then 'networking' else 'vdsm vdsm.dump-volume-chains' end plugins",
    )


def several_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with an earlier report of every host, which does not count."""
    now = host_version(spark, sf_dir)
    return now.union(now.selectExpr("host", "'0.0'", "'vdsm'"))


def engine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey host",
        "concat(p_size div 10, '.', p_size % 10) version",
        "case p_partkey % 5 when 0 then 'rpm fleet.sensitive_keys' "
        "when 1 then 'fleet-engine.sensitive_keys fleet_engine_dwh.sensitive_keys' "
        "when 2 then 'engine.sensitive_keys rhv_analyzer' "
        "when 3 then 'fleet_provider_ovn fleet_engine_reports' else 'rpm' end plugins",
        "case when p_size % 4 = 0 then null else p_size * 4 end log_size",
        "case when p_partkey % 7 = 0 then concat('T', p_partkey) end ticket",
        "case when p_partkey % 11 = 0 then p_brand end upload",
        "case p_size % 3 when 1 then 'PASSWORD,TOKEN' when 2 then 'SECRET' end sensitive_keys",
        "case when p_partkey % 2 = 0 then 'DWH_PASSWORD,TOKEN' end warehouse_keys",
    )


def database(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey host",
        "concat(p_size div 10, '.', p_size % 10) version",
        "case when p_partkey % 7 = 0 then concat('T', p_partkey) end ticket",
        "case when p_size % 4 = 0 then null else p_size * 4 end log_size",
        "p_brand dbname",
        "5432 + p_size port",
        "lower(p_type) user",
        "p_partkey % 3 <> 0 has_password",
    )


def run_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "user_id run_id",
        "event_id seq",
        "case event_type when 'error' then 2 when 'purchase' then 1 when 'signup' then 0 end status_set",
    )


def log_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id seq",
        "case when event_id % 29 = 0 then concat('Traceback of ', user_id, '::', props) else "
        "concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '::', case when event_id % 31 = 0 then 'NOTICE' else "
        "case event_type when 'error' then 'ERROR' when 'purchase' then 'CRITICAL' when 'view' then 'DEBUG' "
        "when 'click' then 'INFO' else 'WARNING' end end, '::mod_', user_id % 9, '::', event_id, "
        "'::root:: a::b ', props) end line",
    )


def log_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of one to three lines."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id seq",
        "concat(event_type, case event_id % 3 when 1 then concat('\\n', props) "
        "when 2 then concat('\\n', props, '\\r\\n\\nend\\n') else '' end) message",
    )


def bundle_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "source bundle", "concat(doc_id, '.txt') path", "cast(text as binary) content"
    )


def sectioned_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings files with sections; the old key sits in the section or among the defaults."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "case doc_id % 3 when 0 then concat('/etc/run-', doc_id, '/tool.conf') "
        "else concat('/etc/run-', doc_id, '/tool.conf.d/', doc_id % 7, '.conf') end file",
        "concat('stray = 1\n[Tool]\nlang = ', lang, '\n; lang = none\n', "
        "if(doc_id % 2 = 0, concat('rhevm: host-', doc_id, '\n'), ''), "
        "'[Other]\nlang = other\n[DEFAULT]\nlang = base\nshared = ', source, '\n', "
        "if(doc_id % 2 = 1, concat('rhevm = host-', doc_id, '\n'), ''), "
        "'[Tool]\nsize = ', n_chars, '\n  bytes\n') text",
    )


def service_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service settings in two layers; a third of the services have the upper one."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "explode(filter(array("
        "named_struct('layer', 0, 'file', 'defaults', 'text', concat('# HOST=no\nHOST=\"', source, "
        "'\"\nno pair\nPORT = 1\nLANG=', lang, '\n')), "
        "if(doc_id % 3 = 0, named_struct('layer', 1, 'file', 'override', 'text', concat('PORT=\\'', n_chars, "
        "'\\'\n LANG = x=', lang)), null)), f -> f is not null)) f",
    ).select("doc_id", "f.*")


def listing_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory listings landed per host; every fifth is empty."""
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('/landing/host-', doc_id % 97, '/selinux/ls-', doc_id) file", "if(doc_id % 5 = 0, '', text) text"
    )


def landed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files below a landing folder, some empty."""
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('file:/landing/', source, '/deep/', doc_id, '.txt') path",
        "cast(if(doc_id % 5 = 0, 0, octet_length(text)) as bigint) length",
        "cast(if(doc_id % 5 = 0, '', text) as binary) content",
    )


def database_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of database reports; some with checksum files of either kind."""
    return table(spark, sf_dir, "documents").selectExpr(
        "explode(filter(array("
        "concat('/srv/', source, '/sosreport-', doc_id, '.tar.xz'), "
        "if(doc_id % 3 = 0, concat('/srv/', source, '/sosreport-', doc_id, '.tar.xz.md5'), null), "
        "if(doc_id % 2 = 0, concat('/srv/', source, '/sosreport-', doc_id, '.tar.xz.sha256'), null)"
        "), p -> p is not null)) path"
    )


def selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option values as they are typed: a comma list with blanks around its items."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey selection_id",
        "concat(c_name, ' , ', c_mktsegment, case c_custkey % 4 when 0 then '*' when 1 then ']' "
        "when 2 then '?x' else '' end, ',', c_name) option_value",
    )


def landed_texts(spark: SparkSession, sf_dir: str) -> str:
    """A new folder below the shared one with the texts of documents as files, a folder per source."""
    folder = f"{use_checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
    texts = table(spark, sf_dir, "documents").selectExpr(
        "coalesce(nullif(source, ''), 'none') bundle", "coalesce(text, '') text"
    )
    texts.write.partitionBy("bundle").text(folder)
    return folder


def headed_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents in few files, some lines headers; a third of all lines follow one header."""
    lines = report_lines(report(spark, sf_dir))
    return lines.selectExpr(
        "if(report_id % 3 = 0, 'all', concat('file-', report_id % 7)) file",
        "report_id * 1000000 + line_no line_no",
        "case when report_id % 3 = 0 then if(report_id = 0 and line_no = 1, 'the first', null) "
        "when line rlike '^[A-D]' then concat(report_id, ' ', left(line, 8)) end header",
    )


def infix_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many globs as there are events, hardly any of them with a literal end."""
    return table(spark, sf_dir, "events").selectExpr(
        "case event_id % 4 when 0 then concat('*', lpad(cast(event_id * 37 % 100000 as string), 5, '0'), '*') "
        "when 1 then concat('*', lpad(cast(event_id * 31 % 10000 as string), 4, '0'), '?*') "
        "when 2 then concat('?*#*', lpad(cast(event_id * 29 % 100000 as string), 5, '0'), '??*') "
        "else if(event_id % 1000 = 3, '*~*', concat('*', event_id % 1000, '*x*')) end pattern"
    )


def dated_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of five product lines; a third of all are of one moment."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "if(event_id % 11 = 0, null, user_id % 5) line",
        "if(event_id % 3 = 0, timestamp_ntz '2024-01-15 00:00:00', ts) at",
    )


def dated_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers of four of the product lines, each valid from a date on."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey % 4 line",
        "timestamp_ntz '2024-01-03 00:00:00' + make_dt_interval(0, cast(s_suppkey * 7 as int)) valid_from",
        "s_name tier",
    )


def minimum_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of tiers with the version that each begins with."""
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey tier", "concat(n_nationkey div 4, '.', n_nationkey % 4 * 3) minimum"
    )


def node_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents of each host, some with keys that only part of the hosts mask."""
    lines = report_lines(report(spark, sf_dir))
    return lines.selectExpr(
        "if(report_id % 3 = 0, 'hot', concat('host-', report_id % 8)) host",
        "report_id",
        "line_no",
        "concat(line, case report_id % 5 when 0 then concat('  key_', report_id % 4, ' = v', line_no, ' x') "
        "when 1 then concat(' a.key_1: v', report_id, ' key_2=key_3=z') else '' end) line",
    )


def node_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys that each host masks."""
    return spark.sql(
        "select if(h = 8, 'hot', concat('host-', h)) host, key from (select explode(sequence(0, 8)) h) "
        "lateral view explode(array('key_0', 'key_1', 'key_2', 'key_3', 'token')) k as key "
        "where h = 8 or (h + length(key) + ascii(right(key, 1))) % 3 > 0"
    )


def log_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of several files, with tracebacks; one record of a file holds a third of all lines."""
    return log_line(spark, sf_dir).join(table(spark, sf_dir, "events").selectExpr("event_id seq", "user_id"), "seq").selectExpr(
        "if(user_id % 3 = 0, 'hot.log', concat('host-', user_id % 7, '.log')) file",
        "seq line_no",
        "case when user_id % 3 = 0 and seq >= 20 or seq % 4 = 1 then concat('  File ', seq) else line end line",
    )


def run_exit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events, some of which end their run."""
    return table(spark, sf_dir, "events").selectExpr(
        "user_id run_id",
        "event_id seq",
        "case event_type when 'error' then 2 when 'purchase' then 1 when 'signup' then 0 end status_set",
        "if(event_type = 'error', event_id % 29 = 0, null) ends",
    )


def landed_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts by landed page: a page is missing, and shifted rows are on two pages."""
    pages = table(spark, sf_dir, "customer").selectExpr(
        "c_name address", "c_mktsegment segment", "explode(if(c_custkey % 40 = 0 and c_custkey > 0, "
        "array(c_custkey div 40 + 1, c_custkey div 40), array(c_custkey div 40 + 1))) page"
    )
    return pages.filter("page <> 3")


def later_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hosts some time later: some changed, some gone, some twice, some new."""
    return host(spark, sf_dir).selectExpr(
        "explode(case cast(right(address, 3) as int) % 97 when 0 then array() when 1 then array(address, address) "
        "when 2 then array(address, concat(address, '-new')) else array(address) end) address",
        "if(cast(right(address, 3) as int) % 89 = 5, 'up', status) status",
        "cluster_id",
    )


# DuckDB definitions. Each may use those above it.
SQL = {
    "v_datacenter": "select cast(r_regionkey as varchar) id, r_name as name from region",
    "v_cluster": """
        select cast(n_nationkey as varchar) id, 'CL_' || (n_nationkey % 8) as name,
            n_nationkey % 3 = 0 gluster_enabled,
            case when n_nationkey % 7 = 0 then null when n_nationkey = 13 then '99'
                else cast(n_regionkey as varchar) end data_center_id
        from nation""",
    "v_host": """
        select c_name address,
            case c_mktsegment when 'FURNITURE' then null when 'BUILDING' then 'maintenance' else 'up' end status,
            case c_custkey % 50 when 0 then 'spm' when 1 then 'contending' else 'none' end spm_status,
            case when c_custkey % 11 = 0 then null when c_custkey % 101 = 0 then '999'
                else cast(c_nationkey as varchar) end cluster_id
        from customer""",
    "v_parents": "select id, name from v_datacenter union all select '', ''",
    "v_tree": """
        select c.id, c.name, c.gluster_enabled, d.name datacenter
        from v_cluster c join v_parents d on coalesce(c.data_center_id, '') = d.id
        union all select '', '', false, ''""",
    "v_inventory": """
        select distinct t.datacenter, t.id cluster_id, t.name as cluster, t.gluster_enabled, h.address,
            coalesce(h.spm_status = 'spm', false) is_spm, coalesce(h.status = 'up', false) is_up
        from v_host h join v_tree t on coalesce(h.cluster_id, '') = t.id""",
    "v_alias": "select s_name as name, 'Customer#' || lpad(cast(s_suppkey as varchar), 9, '0') ip from supplier",
    "v_alias_both": """
        select * from v_alias union all
        select c_name, case when c_custkey % 500 = 7 then 'Supplier#' || lpad(cast(c_custkey % 60 as varchar), 9, '0')
            when c_custkey % 2 = 0 then 'shared-address' else 'other-' || c_custkey end
        from customer""",
    "v_wanted": """
        select s_name as name from supplier
        union select case when c_custkey % 250 = 3 then c_name else 'gone-' || c_name end from customer
        union select unnest(['no-such-host', 'Customer#999999999'])""",
    "v_pattern": """
        select case n_nationkey % 5 when 0 then '*' || lpad(cast(n_nationkey as varchar), 2, '0') || '7'
            when 1 then 'Customer#00000000' || (n_nationkey % 10) || '*'
            when 2 then '*#000*' || n_nationkey || '?'
            when 3 then 'Customer#0000*[!0-7]' || (n_nationkey % 10) || '[35]'
            else '*00' || lpad(cast(n_nationkey * 3 as varchar), 3, '0') end pattern
        from nation""",
    "v_chain": """
        select datacenter, min(case when is_spm and is_up then address end) chain_host
        from v_inventory group by datacenter""",
    "v_report": "select doc_id report_id, text from documents",
    "v_report_line": """
        select report_id, cast(unnest(range(1, len(parts) + 1)) as int) line_no, unnest(parts) line
        from (select report_id, string_split(text, chr(10)) parts from v_report)""",
    "v_output": """
        select doc_id report_id, text ||
            case doc_id % 4 when 0 then chr(10) || '  /var/tmp/sosreport-' || source || '-' || doc_id
                    || '.tar.xz ' || chr(10)
                when 1 then chr(10) || 'sosreport-' || doc_id || '.tar.bz2' || chr(10) || 'sosreport-second.tar.xz'
                else '' end ||
            case doc_id % 3 when 0 then chr(10) || 'The sha256sum is: ' || lang || ': ' || n_chars
                when 1 then chr(10) || 'The sha256sum is lost' else '' end as text
        from documents""",
    "v_output_line": """
        select report_id, cast(unnest(range(1, len(parts) + 1)) as int) line_no, unnest(parts) line
        from (select report_id, string_split(text, chr(10)) parts from v_output)""",
    "v_clock": """
        select event_id probe_id, 'user_' || user_id host, ts engine_time,
            case when event_id % 13 = 0 then 'skipped' when event_id % 17 = 0 then 'warn' else 'ok' end outcome,
            case when event_id % 13 = 0 or event_id % 17 = 0 then null
                when event_id % 19 = 0 then date_trunc('minute', shifted)
                when event_id % 23 = 0 then date_trunc('second', shifted)
                when event_id % 29 = 0 then date_trunc('second', shifted) + to_milliseconds(250)
                else date_trunc('second', shifted) end host_at
        from (select *, ts + to_seconds((event_id % 7 - 3) * 40000) shifted from events)""",
    "v_setting": """
        select 'run' run_id, user_id, event_id,
            case event_type when 'view' then 0 when 'click' then 1 when 'signup' then 2
                when 'purchase' then 3 else 4 end layer,
            case event_type when 'signup' then event_id % 3 else 0 end file_no,
            event_id seq, 'key_' || (user_id % 40) as key,
            case when cast(props ->> '$.k' as int) % 10 = 0 then null else props ->> '$.k' end as value
        from events""",
    "v_run_setting": """
        select 'run_' || user_id run_id, layer, file_no, seq, 'key_' || (event_id % 6) as key, value
        from v_setting""",
    "v_run_effective": """
        select run_id, key, arg_max(value, layer * 10000000000000 + file_no * 1000000000000 + seq) as value
        from v_run_setting where value is not null group by run_id, key""",
    "v_credential_line": """
        select user_id report_id, event_id line_no,
            case when event_type = 'error' and event_id % 9 = 0 then '# DB ADMIN credentials'
                when event_type = 'view' then '# note ' || event_id
                when event_id % 5 = 0 then '  '
                else 'db' || event_id || ':' || (5432 + event_id % 3) || ':*:admin' || (event_id % 12)
                    || ':p:' || value || ' ' end line
        from events""",
    "v_version": "select p_partkey host, (p_size // 10) || '.' || (p_size % 10) as version, p_size from part",
    "v_tier": "select unnest([17, 22, 30, 32, 33, 34, 35, 36, 40]) tier",
    "v_engine": """
        select p_partkey host, (p_size // 10) || '.' || (p_size % 10) as version, p_size v,
            case p_partkey % 5 when 0 then 'rpm fleet.sensitive_keys'
                when 1 then 'fleet-engine.sensitive_keys fleet_engine_dwh.sensitive_keys'
                when 2 then 'engine.sensitive_keys rhv_analyzer'
                when 3 then 'fleet_provider_ovn fleet_engine_reports' else 'rpm' end plugins,
            case when p_size % 4 = 0 then null else p_size * 4 end log_size,
            case when p_partkey % 7 = 0 then 'T' || p_partkey end ticket,
            case when p_partkey % 11 = 0 then p_brand end upload,
            case p_size % 3 when 1 then 'PASSWORD:TOKEN' when 2 then 'SECRET' end own_keys,
            case when p_partkey % 2 = 0 then 'DWH_PASSWORD:TOKEN' end dwh_keys
        from part""",
    "v_run_event": """
        select user_id run_id, event_id seq,
            case event_type when 'error' then 2 when 'purchase' then 1 when 'signup' then 0 end status_set
        from events""",
    "v_log_line": """
        select event_id seq, case when event_id % 29 = 0 then 'Traceback of ' || user_id || '::' || props else
            strftime(ts, '%Y-%m-%d %H:%M:%S') || '::' ||
            case when event_id % 31 = 0 then 'NOTICE' else case event_type when 'error' then 'ERROR' when 'purchase' then 'CRITICAL' when 'view' then 'DEBUG'
                when 'click' then 'INFO' else 'WARNING' end end ||
            '::mod_' || (user_id % 9) || '::' || event_id || '::root:: a::b ' || props end line
        from events""",
    "v_log": """
        select seq, line, parsed, case when parsed then g['time'] end as time,
            case when parsed then g['level'] end as level, case when parsed then g['module'] end as module,
            case when parsed then cast(g['lineno'] as int) end lineno,
            case when parsed then g['logger'] end as logger, case when parsed then g['message'] end as message,
            case g['level'] when 'DEBUG' then 10 when 'INFO' then 20 when 'WARNING' then 30
                when 'ERROR' then 40 when 'CRITICAL' then 50 end severity
        from (select seq, line, line not like 'Traceback%' parsed, regexp_extract(line, '(?s)^(.*?)::(.*?)::(.*?)::(.*?)::(.*?):: ?(.*)$',
            ['time', 'level', 'module', 'lineno', 'logger', 'message']) g from v_log_line)""",
    "v_log_message": """
        select event_id seq, event_type || case event_id % 3 when 1 then chr(10) || props
            when 2 then chr(10) || props || chr(13) || chr(10) || chr(10) || 'end' || chr(10) else '' end message
        from events""",
    "v_headed_line": """
        select case when report_id % 3 = 0 then 'all' else 'file-' || (report_id % 7) end file,
            report_id * 1000000 + line_no as line_no,
            case when report_id % 3 = 0 then case when report_id = 0 and line_no = 1 then 'the first' end
                when regexp_matches(line, '^[A-D]') then report_id || ' ' || left(line, 8) end header
        from v_report_line""",
    "v_infix_pattern": """
        select distinct case event_id % 4 when 0 then '*' || lpad(cast(event_id * 37 % 100000 as varchar), 5, '0') || '*'
            when 1 then '*' || lpad(cast(event_id * 31 % 10000 as varchar), 4, '0') || '?*'
            when 2 then '?*#*' || lpad(cast(event_id * 29 % 100000 as varchar), 5, '0') || '??*'
            else case when event_id % 1000 = 3 then '*~*' else '*' || (event_id % 1000) || '*x*' end end pattern
        from events""",
    "v_dated_probe": """
        select event_id, case when event_id % 11 = 0 then null else user_id % 5 end line,
            case when event_id % 3 = 0 then timestamp '2024-01-15 00:00:00' else ts end as at from events""",
    "v_dated_tier": """
        select s_suppkey % 4 line, timestamp '2024-01-03 00:00:00' + to_hours(cast(s_suppkey * 7 as int)) valid_from,
            s_name tier from supplier""",
    "v_node_line": """
        select case when report_id % 3 = 0 then 'hot' else 'host-' || (report_id % 8) end host, report_id, line_no,
            line || case report_id % 5 when 0 then '  key_' || (report_id % 4) || ' = v' || line_no || ' x'
                when 1 then ' a.key_1: v' || report_id || ' key_2=key_3=z' else '' end as line
        from v_report_line""",
    "v_node_key": """
        select case when h = 8 then 'hot' else 'host-' || h end host, key
        from (select unnest(range(0, 9)) h), (select unnest(['key_0', 'key_1', 'key_2', 'key_3', 'token']) as key)
        where h = 8 or (h + length(key) + ascii(right(key, 1))) % 3 > 0""",
    "v_log_file": """
        select case when user_id % 3 = 0 then 'hot.log' else 'host-' || (user_id % 7) || '.log' end file, l.seq line_no,
            case when user_id % 3 = 0 and l.seq >= 20 or l.seq % 4 = 1 then '  File ' || l.seq else l.line end as line,
            not (user_id % 3 = 0 and l.seq >= 20 or l.seq % 4 = 1) and l.parsed as starts, l.level, l.severity
        from v_log l join events e on e.event_id = l.seq""",
    "v_log_record": """
        select *, last_value(case when starts then line_no end ignore nulls) over above record_no,
            last_value(case when starts then struct_pack(level := level, severity := severity) end ignore nulls) over above f
        from v_log_file window above as (partition by file order by line_no rows unbounded preceding)""",
    "v_log_fields": """
        select file, line_no, record_no, line_no - record_no as part, f.level as level, f.severity as severity
        from v_log_record""",
    "v_landed_page": """
        select * from (select c_name address, c_mktsegment segment,
            unnest(case when c_custkey % 40 = 0 and c_custkey > 0 then [c_custkey // 40 + 1, c_custkey // 40]
                else [c_custkey // 40 + 1] end) page from customer) where page <> 3""",
    "v_later_host": """
        select unnest(case cast(right(address, 3) as int) % 97 when 0 then [] when 1 then [address, address]
                when 2 then [address, address || '-new'] else [address] end) address,
            case when cast(right(address, 3) as int) % 89 = 5 then 'up' else status end as status, cluster_id
        from v_host""",
    "v_bundle_file": """
        select source bundle, doc_id || '.txt' path, octet_length(encode(text)) length, sha256(text) sha256
        from documents""",
    "v_database_file": """
        select '/srv/' || source || '/sosreport-' || doc_id || '.tar.xz' path, doc_id from documents""",
    "v_selection": """
        select c_custkey selection_id, [c_name, c_mktsegment || case c_custkey % 4 when 0 then '*'
            when 1 then ']' when 2 then '?x' else '' end] items
        from customer""",
}


def with_views(query: str) -> str:
    """The query with every definition it may use in front."""
    heads = ",\n".join(f"{name} as ({body})" for name, body in SQL.items())
    return f"with {heads}\n{query}"
