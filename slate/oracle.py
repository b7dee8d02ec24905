"""The SQL each registered query is compared with."""

from __future__ import annotations

from .views import with_views

# Report names, here and in the lists inside the queries.
_BASE = (
    "['libvirt','vdsm','networking','hardware','process','filesys',"
    "'devicemapper','selinux','kernel','memory','rpm']"
)
_FROM_30 = (
    "['processor','pci','md','block','general','scsi','multipath','systemd','sanlock','lvm2','chrony','ipmitool']"
)
_INVENTORY = "datacenter, cluster_id, cluster, gluster_enabled, address, is_spm, is_up"
_BEST = "is_spm desc, is_up desc, address, datacenter, cluster_id"

_LISTING = """
    select datacenter, cluster, address, is_spm, is_up,
        format('{:<20} | {:<20} | {:<20} | {:<7} | {}', datacenter, cluster, address,
            case when is_spm then 'True' else 'False' end, case when is_up then 'True' else 'False' end) line
    from v_inventory"""

_RESOLVE = """
    names as (select distinct name from v_wanted),
    addresses as (select distinct address from v_inventory),
    direct as (select n.name, a.address, 'direct' how from names n join addresses a on n.name = a.address),
    by_name as (
        select distinct n.name, a.address, 'name' how
        from names n join {alias} l on l.name = n.name join addresses a on a.address = l.ip
        where n.name not in (select name from direct)),
    remaining as (
        select name from names where name not in (select name from direct)
        and name not in (select name from by_name)),
    by_address as (
        select distinct n.name, a.address, 'address' how
        from addresses a join {alias} l on l.name = a.address join names n on n.name = l.ip
        where exists (select 1 from remaining)),
    resolved as (select * from direct union all select * from by_name union all select * from by_address)"""


def _resolved(alias: str, query: str) -> str:
    return with_views("select 1").rsplit("\nselect 1", 1)[0] + "," + _RESOLVE.format(alias=alias) + "\n" + query


def _plan(ticket: str, size: int | None) -> str:
    logs = "['logs']" if size is None or size >= 100 else "[]"
    head = ([f"--ticket-number={ticket}"] if ticket else []) + ([f"--log-size={size}"] if size else [])
    lead = "".join(f"'{part} ' || " for part in head)
    all_logs = "' --all-logs'" if size is None else "''"
    return with_views(f"""
        select datacenter, cluster, address, version, tier, is_chain_host,
            case when tier is null then null when tier = 40 then 'sos report' else 'sosreport' end command,
            case when tier is null then null else array_to_string(case
                when tier = 17 then ['vdsm','general','networking','hardware','process','filesys']
                when tier = 22 then ['general'] || {_BASE} || gluster
                else {logs} || {_BASE} || gluster
                    || [x for x in {_FROM_30} if tier < 36 or x <> 'general']
                    || case when tier >= 32 then ['firewalld','openvswitch','fleet_hosted_engine'] else [] end
                    || case when tier >= 33 then ['virsh'] else [] end
                    || case when tier >= 34 then ['collectd'] else [] end
                    || case when tier >= 35 then ['fleet_imageio'] else [] end
                    || case when tier >= 36 then ['date','host','fleet_node','ovn_host'] else [] end
                end, ',') end reports,
            case when tier is null then null else {lead}
                case when tier = 17 then '--no-progressbar -k general.all_logs=True'
                    when tier = 22 then '--batch -k general.all_logs=True'
                    when tier = 30 then '--batch -k logs.all_logs=True'
                    else case when tier >= 35 and is_chain_host and plugins like '%vdsm.dump-volume-chains%'
                        then '-k vdsm.dump-volume-chains ' else '' end || '--batch' || {all_logs} end end as options,
            case when tier is null then 'unsupported' else 'ok' end status
        from (
            select i.*, coalesce(c.chain_host = i.address, false) is_chain_host, p.version, p.plugins,
                (select max(tier) from v_tier where tier <= p.p_size) tier,
                case when i.gluster_enabled then ['gluster'] else [] end gluster
            from v_inventory i
            left join v_chain c on c.datacenter = i.datacenter
            left join (select 'Customer#' || lpad(cast(p_partkey as varchar), 9, '0') host, p_size,
                    (p_size // 10) || '.' || (p_size % 10) as version,
                    case when p_partkey % 150 = 0 then 'networking' else 'vdsm vdsm.dump-volume-chains' end plugins
                from part) p on p.host = i.address)""")


def _engine(own: str, dwh: str) -> str:
    return with_views(f"""
        select host, version, plugin, case when v >= 40 then 'sos report' else 'sosreport' end command,
            array_to_string([plugin] || ['rpm','libvirt','networking','hardware','process','filesys',
                    'devicemapper','selinux','kernel','apache','memory']
                || case when v >= 30 then ['block','java','lvm2','md','pci','processor','scsi','chrony','systemd']
                    else [] end
                || case when v >= 32 then ['firewalld','openvswitch'] else [] end
                || case when v >= 34 then ['collectd'] else [] end
                || case when v >= 35 then ['fleet_imageio'] else [] end
                || case when v < 36 then ['general'] else ['date','host','ovn_central','grafana'] end
                || case when v >= 36 and plugins like '%rhv_analyzer%' then ['rhv_analyzer'] else [] end
                || case when plugins like '%fleet_provider_ovn%' then ['fleet_provider_ovn'] else [] end
                || case when coalesce(log_size >= 100, v >= 30) then ['logs'] else [] end
                || case when has_dwh then ['fleet_engine_dwh'] else [] end
                || case when plugins like '%fleet_engine_reports%' then ['fleet_engine_reports'] else [] end,
                ',') reports,
            concat_ws(' ', '--batch --build', '-k rpm.rpmva=off', '-k apache.log=True',
                '-k ' || plugin || '.sensitive_keys=' || {own},
                '-k fleet_engine_dwh.sensitive_keys=' || {dwh},
                '--ticket-number=' || ticket,
                case when v < 30 then '--report' end,
                '--log-size=' || log_size,
                case when log_size is not null then null when v < 30 then '--report -k general.all_logs=True'
                    when v < 32 then '-k logs.all_logs=True' else '--all-logs' end,
                '--upload=' || upload) as options
        from (select *, plugins like '%fleet_engine_dwh.sensitive_keys%' has_dwh,
                case when plugins like '%fleet.sensitive_keys%' then 'fleet'
                    when plugins like '%fleet-engine.sensitive_keys%' then 'fleet-engine'
                    when plugins like '%engine.sensitive_keys%' then 'engine' else 'fleet' end plugin
            from v_engine)""")


def _refs(source: str) -> str:
    return with_views(f"""
        select report_id, regexp_extract(path, '[^/]*$') filename,
            case when path like '/%' then path else '/scratch/' || regexp_extract(path, '[^/]*$') end as path,
            case when path is null then null when instr(checksum, ': ') > 0
                then substr(checksum, instr(checksum, ': ') + 2)
                when checksum is not null then '' end checksum,
            path is null missing_report
        from (select report_id,
                regexp_replace(arg_min(line, line_no) filter (where line like '%sosreport-%tar%'),
                    '^\\s+|\\s+$', '', 'g') as path,
                arg_min(line, line_no) filter (where line like 'The sha256sum is%') checksum
            from {source} group by report_id)""")


def _and(more: str, query: str) -> str:
    return with_views("select 1").rsplit("\nselect 1", 1)[0] + "," + more + "\n" + query


def _section(where: str, every: bool = False) -> str:
    rows = "v_report left join found using (report_id)" if every else "found"
    found = f"""
    found as (
        select report_id, trim(string_split(line, ':')[1]) host, trim(string_split(line, ':')[2]) as port,
            trim(string_split(line, ':')[4]) as admin,
            case when len(string_split(line, ':')) >= 5
                then trim(regexp_extract(line, '^[^:]*:[^:]*:[^:]*:[^:]*:(.*)$', 1)) end as pass
        from (select l.report_id, arg_min(line, line_no) line
            from v_report_line l
            join (select report_id, min(line_no) marker from v_report_line where line like '%###%' group by 1) m
                on l.report_id = m.report_id and l.line_no > m.marker
            where l.line not like '#%' and l.line not like '%###%' and trim(l.line) <> ''
            group by 1)
        where {where})"""
    return _and(found, f"select report_id, host, port, admin, pass from {rows}")


_CREDENTIALS = """
    select coalesce(e.report_id, u.report_id) report_id,
        trim(string_split(e.line, ':')[1]) host, trim(string_split(e.line, ':')[2]) as port,
        trim(string_split(e.line, ':')[4]) as admin,
        trim(regexp_extract(coalesce(u.line, e.line), '^[^:]*:[^:]*:[^:]*:[^:]*:(.*)$', 1)) as pass
    from (select report_id, arg_min(line, line_no) line from entry where line_no > marker group by 1) e
    full join (select report_id, arg_min(line, line_no) line from entry
        where (marker is null or line_no < marker) and string_split(line, ':')[4] = 'admin7' group by 1) u
    on e.report_id = u.report_id"""

_DRIFT = """
    drift as (
        select probe_id, host, outcome, strftime(host_at, '%Y-%m-%d %H:%M:%S') ||
                case when us(host_at) = 0 then '' else '.' || lpad(cast(us(host_at) as varchar), 6, '0') end
                || '+00:00' host_time_text,
            strftime(engine_time, '%Y-%m-%d %H:%M:%S') ||
                case when us(engine_time) = 0 then '' else '.' || lpad(cast(us(engine_time) as varchar), 6, '0') end
                || '+00:00' engine_time_text,
            gap drift_us,
            case when gap > 0 then '+' else '-' end ||
            case when d = 0 then '' when d = 1 then '1 day, ' else d || ' days, ' end ||
            (r // 3600000000) || ':' || lpad(cast(r // 60000000 % 60 as varchar), 2, '0') || ':' ||
            lpad(cast(r // 1000000 % 60 as varchar), 2, '0') ||
            case when r % 1000000 = 0 then '' else '.' || lpad(cast(r % 1000000 as varchar), 6, '0') end drift
        from (select *, abs(gap) // 86400000000 d, abs(gap) % 86400000000 r
            from (select *, date_diff('microsecond', engine_time, host_at) gap from v_clock)))"""
for _time in ("engine_time", "host_at"):
    _DRIFT = _DRIFT.replace(f"us({_time})", f"(epoch_us({_time}) % 1000000)")


ORACLE: dict[str, str] = {
    "inventory": with_views(f"select {_INVENTORY} from v_inventory"),
    "orphans": with_views("""
        select distinct address, cluster_id from v_host
        where cluster_id is not null and cluster_id not in (select id from v_tree)"""),
    "page_slice": with_views("select address, status, cluster_id from v_host order by address limit 100 offset 200"),
    "page_numbers": with_views("""
        select address, (row_number() over (order by address) - 1) // 100 + 1 as page from v_host"""),
    "select_glob": with_views(f"""
        select {_INVENTORY} from v_inventory
        where (address like '%7' or address like '%1') and datacenter like 'A%' and cluster like 'CL\\_%' escape '\\'"""),
    "select_class": with_views(f"""
        select {_INVENTORY} from v_inventory
        where (regexp_full_match(address, '.*[^0-6][13]') or address like 'Customer#00000000_')
            and (regexp_full_match(cluster, 'CL_[0-3]') or cluster in ('CL_7', ''))"""),
    "select_literal": with_views(f"""
        select {_INVENTORY} from v_inventory where address in (select name from v_wanted)"""),
    "select_glob_table": with_views(f"""
        select {_INVENTORY} from v_inventory i
        where exists (select 1 from v_pattern p where i.address glob p.pattern)"""),
    "select_hosts": with_views(f"""
        select {_INVENTORY} from v_inventory
        where (address = 'Customer#000000003' or regexp_full_match(address, '.*[2-9]')
                or address in (select ip from v_alias where name = 'Supplier#000000004'))
            and (datacenter like 'A%' or datacenter like '%E%' or datacenter = '')
        qualify row_number() over (partition by cluster order by {_BEST}) = 1"""),
    "sift_options": with_views("""
        select selection_id,
            array_to_string(list_sort([x for x in items if regexp_matches(x, '[*?\\[\\]]')]), '|') patterns,
            array_to_string(list_sort([x for x in items if not regexp_matches(x, '[*?\\[\\]]')]), '|') literals
        from v_selection"""),
    "alias_match": _resolved("v_alias", "select name, address, how from resolved"),
    "alias_both_ways": _resolved("v_alias_both", "select name, address, how from resolved"),
    "unknown_hosts": _resolved("v_alias", "select name from names where name not in (select name from resolved)"),
    "selected_all": with_views("""
        select 'Cust*' selection, count(*) hosts, count(*) filter (where address like 'Cust%') selected,
            count(*) = count(*) filter (where address like 'Cust%') all_selected,
            count(*) filter (where address like 'Cust%') >= 10 large_fleet
        from v_inventory
        union all
        select 'ASIA, CL_0', count(*), count(*) filter (where datacenter = 'ASIA' and cluster = 'CL_0'),
            count(*) = count(*) filter (where datacenter = 'ASIA' and cluster = 'CL_0'),
            count(*) filter (where datacenter = 'ASIA' and cluster = 'CL_0') >= 10
        from v_inventory"""),
    "one_per_cluster": with_views(f"""
        select {_INVENTORY} from v_inventory
        qualify row_number() over (partition by cluster order by {_BEST}) = 1"""),
    "chain_host": with_views("select datacenter, chain_host from v_chain"),
    "chain_host_any_up": with_views("""
        select datacenter, coalesce(min(case when is_up and is_spm then address end),
            min(case when is_up then address end)) chain_host
        from v_inventory group by datacenter"""),
    "chain_flag": with_views("""
        select i.datacenter, address, coalesce(address = chain_host, false) is_chain_host
        from v_inventory i left join v_chain c on i.datacenter = c.datacenter"""),
    "list_hosts": with_views(_LISTING + " where address like '%7' and datacenter like 'A%'"),
    "list_all_hosts": with_views(_LISTING),
    "version_tier": with_views("""
        select host, version, (select max(tier) from v_tier where tier <= p_size) tier from v_version"""),
    "collection_plan": _plan("", None),
    "collection_plan_capped": _plan("4711", 50),
    "engine_plan": _engine(
        "case when has_dwh then own_keys else nullif(concat_ws(':', own_keys, "
        "case when own_keys like '%TOKEN' then replace(dwh_keys, ':TOKEN', '') else dwh_keys end), '') end",
        "case when has_dwh then dwh_keys end",
    ),
    "engine_plan_unmasked": _engine("':'", "':'"),
    "database_plan": """
        select p_partkey host,
            case when p_partkey % 3 <> 0 then case when p_size >= 40 then 'sos report' else 'sosreport' end end command,
            case when p_partkey % 3 <> 0 then 'postgresql' end report,
            case when p_partkey % 3 <> 0 then concat_ws(' ', '--batch',
                case when p_partkey % 7 = 0 then '--ticket-number=T' || p_partkey end,
                case when p_size % 4 <> 0 then '--log-size=' || (p_size * 4) end,
                case when p_size < 30 then '--report' end,
                '-k postgresql.dbname=' || p_brand, '-k postgresql.dbhost=' || p_partkey,
                '-k postgresql.dbport=' || (5432 + p_size), '-k postgresql.username=' || lower(p_type)) end as options
        from part""",
    "report_lines": with_views("select report_id, line_no, line from v_report_line"),
    "first_match": with_views("""
        select report_id, min(line_no) line_no, arg_min(line, line_no) line
        from v_report_line where line like '%token%' group by report_id"""),
    "report_refs": _refs("v_output_line"),
    "report_refs_of_lines": _refs("v_output_line"),
    "section_lookup": _section("true", every=True),
    "section_lookup_of_lines": _section("true"),
    "credential_lookup": _and(
        """
    entry as (
        select l.*, marker from v_credential_line l
        left join (select report_id, min(line_no) marker from v_credential_line
            where line like '%DB ADMIN credentials%' group by 1) m on l.report_id = m.report_id
        where line not like '#%' and trim(line) <> '' and line not like '%DB ADMIN credentials%')""",
        _CREDENTIALS,
    ),
    "clock_drift": _and(
        _DRIFT, "select probe_id, host, host_time_text, engine_time_text, drift_us, drift, outcome from drift"
    ),
    "drift_report": _and(
        _DRIFT,
        """
        select 0 part, cast(null as varchar) host,
            format('{:<17} : {:<33} : {:<33} : {:<35}', 'Node', 'Node Time', 'Engine Time',
                'Clock Drift Between Engine and Node') line
        union all
        select 1, host, format('{:<17} : {:<33} : {:<33} : {:<35}',
            host || ' ', host_time_text, engine_time_text, drift)
        from drift where outcome = 'ok'""",
    ),
    "effective_settings": with_views("""
        select run_id, key, arg_max(value, layer * 10000000000000 + file_no * 1000000000000 + seq) as value
        from v_setting where value is not null group by run_id, key"""),
    "renamed_settings": with_views("""
        select run_id, new_key as key, arg_max(value, rank) as value
        from (select *, case when layer in (1, 2) and key = 'key_1' then 'key_2'
                    when layer in (1, 2) and key = 'key_3' then 'key_new' else key end new_key,
                case when layer in (1, 2) then 2 else layer end * 10000000000000000
                + case when layer in (1, 2) and key in ('key_1', 'key_3') then 0 else 1000000000000000 end
                + layer * 100000000000000 + file_no * 1000000000000 + seq rank
            from v_setting where value is not null)
        group by 1, 2"""),
    "render_template": with_views("""
        select run_id, 'run ' || max(case when key = 'key_1' then value end) || ' at 100% -p '
            || max(case when key = 'key_2' then value end) || ':' || max(case when key = 'key_4' then value end)
            as rendered
        from v_run_effective group by run_id"""),
    "settings_check": with_views("""
        select run_id, count(*) filter (where key in ('key_1', 'key_2', 'key_3')) = 3 has_all,
            count(*) filter (where key in ('key_1', 'key_2', 'key_3')) > 0 has_any
        from v_run_effective group by run_id"""),
    "default_settings": with_views("""
        select k.run_id, k.key, coalesce(e.value,
            case k.key when 'key_0' then 'zero' when 'key_5' then 'five' end) as value
        from (select distinct run_id, key from v_run_setting) k
        left join v_run_effective e on e.run_id = k.run_id and e.key = k.key"""),
    "key_values": with_views("""
        select report_id, cast(line_no - 1 as bigint) seq, substr(line, 1, instr(line, '=') - 1) as key,
            case when length(v) > 2 then substr(v, 2, length(v) - 2) else '' end as value
        from (select *, regexp_replace(substr(line, instr(line, '=') + 1), '^\\s+|\\s+$', '', 'g') v
            from v_report_line where instr(line, '=') > 0)"""),
    "redact": with_views("""
        select report_id, array_to_string(list_transform(string_split(text, 'token = "'), lambda part, nth:
            case when nth = 1 then part else '********' || substr(part, instr(part, '"') + 1) end), 'token = ') as text
        from v_report"""),
    "sectioned_settings": """
        select 'run-' || doc_id run_id, unnest(['lang', 'engine', 'shared', 'size']) as key,
            unnest([lang, 'host-' || doc_id, source, n_chars || chr(10) || 'bytes']) as value
        from documents""",
    "service_layers": """
        select 'run-' || doc_id run_id, unnest(['HOST', 'PORT', 'LANG']) as key,
            unnest([source, case when doc_id % 3 = 0 then cast(n_chars as varchar) else '1' end,
                case when doc_id % 3 = 0 then 'x=' || lang else lang end]) as value
        from documents""",
    "host_listings": """
        select 'host-' || (doc_id % 97) host, '/landing/host-' || (doc_id % 97) || '/selinux/ls-' || doc_id as file,
            case when doc_id % 5 = 0 then '' else text end as text
        from documents""",
    "collected_files": """
        select source bundle, 'file:/landing/' || source || '/deep/' || doc_id || '.txt' as path,
            cast(case when doc_id % 5 = 0 then 0 else octet_length(encode(text)) end as bigint) length
        from documents""",
    "listing_report": with_views("""
        select 0 part, cast(null as varchar) address,
            'Host list (datacenter=A*,E*, cluster=None, host=*7):' line
        union all
        select 1, null, format('{:<20} | {:<20} | {:<20} | {:<7} | {}',
            'Data Center', 'Cluster', 'Hostname/IP Address', 'SPM', 'Up')
        union all select 2, address, line from (""" + _LISTING + """
            where address like '%7' and (datacenter like 'A%' or datacenter like 'E%'))"""),
    "collection_plan_latest": _plan("", None),
    "bundle_messages": with_views("""
        select bundle, checksum, size,
            'Log files have been collected and placed in /var/tmp/bundles/' || bundle || chr(10) ||
            'The sha256 for this file is ' || checksum || ' and its size is ' || size ||
            case when bytes >= 1048576000 then chr(10) || 'You can use the following filters -c, -d, -H in the next '
                || 'execution to limit the number of Datacenters,' || chr(10) || 'Clusters or Hosts that are collected '
                || 'in order to reduce the archive size.' else '' end message
        from (select bundle, printf('%.1fM', sum(length) / 1048576.0) size, sum(length) bytes,
                lpad(lower(to_hex(bit_xor(cast('0x' || substr(h, 1, 15) as bigint)))), 15, '0') ||
                lpad(lower(to_hex(bit_xor(cast('0x' || substr(h, 16, 15) as bigint)))), 15, '0') ||
                lpad(lower(to_hex(bit_xor(cast('0x' || substr(h, 31, 15) as bigint)))), 15, '0') ||
                lpad(lower(to_hex(bit_xor(cast('0x' || substr(h, 46, 15) as bigint)))), 15, '0') checksum
            from (select *, sha256(sha256(sha256 || '  ' || path) || ' 1') h from v_bundle_file)
            group by bundle)"""),
    "file_manifest": with_views("select bundle, path as name, length, sha256 from v_bundle_file"),
    "bundle_manifest": with_views("""
        select bundle, count(*) files, cast(sum(length) as bigint) bytes,
            printf('%.1fM', sum(length) / 1048576.0) size, sum(length) >= 1048576000 advise_filters
        from v_bundle_file group by bundle"""),
    "host_files": """
        select c_name host, '/var/tmp/sosreport-' || c_name || '.tar.xz' as path,
            c_name || '-sosreport-' || c_name || '.tar.xz' as name
        from customer""",
    "database_files": with_views("""
        select path, 'postgresql-sosreport-' || doc_id || '.tar.xz' kept_as,
            path || ext sidecar, 'postgresql-sosreport-' || doc_id || '.tar.xz' || ext sidecar_kept_as
        from (select *, case when doc_id % 3 = 0 then '.md5' when doc_id % 2 = 0 then '.sha256' end ext
            from v_database_file)"""),
    "bundle_names": """
        select event_id, folder || '.tar.xz' as name, folder || '.tar' uncompressed, folder
        from (select event_id, 'sosreport-fleet-' || case when event_id % 3 = 0 then user_id || '-' else '' end
            || strftime(ts, '%Y%m%d%H%M%S') folder from events)""",
    "run_status": with_views("""
        select run_id, coalesce(arg_max(status_set, seq) filter (where status_set is not null), 0) status,
            case when bool_or(status_set = 1) then 1 when bool_or(status_set = 2) then 2 else 0 end worst_status
        from v_run_event group by run_id"""),
    "log_lines": with_views("select seq, line, parsed, time, level, module, lineno, logger, message, severity from v_log"),
    "log_routes": with_views("""
        select seq, level, 'file' as route from v_log where severity >= 20
        union all select seq, level, 'stderr' from v_log where severity >= 40
        union all select seq, level, 'stdout' from v_log where severity >= 20 and severity < 40
        union all select seq, level, 'unparsed' from v_log where severity is null"""),
    "log_routes_quiet": with_views("""
        select seq, level, 'stderr' as route from v_log where severity >= 40
        union all select seq, level, 'unparsed' from v_log where severity is null"""),
    "message_lines": with_views("""
        select seq, cast(unnest(range(1, len(parts) + 1)) as int) part, unnest(parts) message
        from (select seq, string_split(regexp_replace(replace(message, chr(13) || chr(10), chr(10)), '\\n$', ''),
            chr(10)) parts from v_log_message)"""),
    "carried_headers": with_views("""
        select file, line_no, last_value(header ignore nulls) over (partition by file order by line_no
            rows unbounded preceding) as under from v_headed_line"""),
    "select_infix": with_views(f"""
        select {_INVENTORY} from v_inventory where address in (
            select address from v_host, v_infix_pattern where address like replace(replace(pattern, '*', '%'), '?', '_'))"""),
    "glob_hits": with_views("""
        select pattern, count(*) as hits, max(address) as last_value from v_host, v_infix_pattern
        where address like replace(replace(pattern, '*', '%'), '?', '_') group by pattern"""),
    "tier_by_date": with_views("""
        select p.event_id, p.line, p.at, t.tier from v_dated_probe p asof left join v_dated_tier t
            on p.line = t.line and p.at >= t.valid_from"""),
    "tier_by_version": with_views("""
        select v.host, v.version, t.tier from (select *, cast(p_size as bigint) as key from v_version) v
        asof left join (select n_nationkey tier, cast(n_nationkey // 4 * 10 + n_nationkey % 4 * 3 as bigint) as minimum
            from nation) t on v.key >= t.minimum"""),
    "redact_by_node": with_views(r"""
        select l.host, l.report_id, l.line_no, regexp_replace(l.line, '((?:^|[^0-9A-Za-z_])(?:' || k.names ||
            ')["'']?[ \t]*[=:][ \t]*)(?:"(?:[^"\\]|\\.)*(?:"|.*)|[^ \t]+)', '\1********', 'g') as line
        from v_node_line l join (select host, string_agg(key, '|') as names from v_node_key group by host) k
            on k.host = l.host"""),
    "log_records": with_views("""
        select file, line_no, record_no, part, level, 'file' as route from v_log_fields where severity >= 20
        union all select file, line_no, record_no, part, level, 'stderr' from v_log_fields where severity >= 40
        union all select file, line_no, record_no, part, level, 'stdout' from v_log_fields where severity >= 20 and severity < 40
        union all select file, line_no, record_no, part, level, 'unparsed' from v_log_fields where severity is null"""),
    "run_outcome": """
        with e as (select user_id run_id, event_id seq,
                case event_type when 'error' then 2 when 'purchase' then 1 when 'signup' then 0 end status_set,
                event_type = 'error' and event_id % 29 = 0 as ends from events),
            first_end as (select run_id, min(seq) ended_at from e where ends group by run_id)
        select e.run_id, case when ended_at is not null then 1
                else coalesce(arg_max(status_set, seq) filter (where status_set is not null), 0) end status,
            case when ended_at is not null or bool_or(status_set = 1) then 1 when bool_or(status_set = 2) then 2
                else 0 end worst_status, ended_at
        from e left join first_end f on f.run_id = e.run_id group by e.run_id, ended_at""",
    "landed_pages": with_views("""
        select address, segment, min(page) first_page, count(*) as times,
            min(page) < (select min(n) from (select unnest(range(1, (select max(page) + 2 from v_landed_page))) as n)
                where n not in (select page from v_landed_page)) as taken
        from v_landed_page group by address, segment"""),
    "inventory_changes": with_views("""
        select address, status, cluster_id, case when sum(n) > 0 then 'new' else 'old' end side, abs(sum(n)) as times
        from (select address, status, cluster_id, -1 as n from v_host
            union all select address, status, cluster_id, 1 from v_later_host)
        group by address, status, cluster_id having sum(n) <> 0"""),
}
ORACLE["landed_bundles"] = """
    select coalesce(nullif(source, ''), 'none') bundle, cast(sum(bytes) as bigint) bytes, cast(sum(feeds) as bigint) feeds,
        printf('%.1fM', sum(bytes) / 1048576.0) size
    from (select source, strlen(coalesce(text, '')) + 1 as bytes,
            length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1 as feeds from documents)
    group by 1"""
ORACLE["sectioned_lines"] = ORACLE["sectioned_settings"]
ORACLE["unknown_text"] = _resolved("v_alias", """
    select cast(first_char // 200 as bigint) part, min(first_char) first_char, count(*) n_values,
        string_agg(name, ', ' order by name) as text
    from (select name, cast(coalesce(sum(length(name) + 2) over (order by name rows between unbounded preceding
            and 1 preceding), 0) as bigint) first_char
        from (select name from names where name not in (select name from resolved)))
    group by part""")
ORACLE["cluster_text"] = with_views("""
    select datacenter, cluster, cast(first_char // 500 as bigint) part, min(first_char) first_char, count(*) n_values,
        string_agg(address, ',' order by address) as text
    from (select datacenter, cluster, address, cast(coalesce(sum(length(address) + 1) over (
            partition by datacenter, cluster order by address rows between unbounded preceding and 1 preceding), 0)
            as bigint) first_char from v_inventory)
    group by all""")
