"""Choosing hosts from the inventory.

Values inside one option are alternatives; the options together narrow each
other; an option that is not given does not restrict.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.globs import any_glob, has_literal, literal_prefix, literal_runs, literal_suffix, regex_of, sift
from .spread import spread_join

LARGE_FLEET = 10  # fixed value: from this many hosts on, collecting takes long

# Lengths of the literal ends a pattern table is joined on, longest first.
_ANCHORS = (16, 8, 4, 3)
# Lengths of the inner parts for globs without such an end, longest first.
_GRAMS = (3, 2, 1)
# Parts that the globs of one end are repeated for; values are parted by content.
SALTS = 16
# Values that the globs of one inner part meet at once; a part that more values hold is salted as well.
MET = 50_000


def hosts_predicate(hosts: Iterable[str] | None, address: Column | None = None) -> Column | None:
    """The host option: literals or patterns; None when it is not given."""
    address = F.col("address") if address is None else address
    patterns, literals = sift(hosts)
    parts = []
    if literals:
        parts.append(address.isin(literals))
    if patterns:
        parts.append(any_glob(address, patterns))
    return reduce(lambda left, right: left | right, parts) if parts else None


def selection_predicate(
    hosts: Iterable[str] | None = None,
    datacenters: Iterable[str] | None = None,
    clusters: Iterable[str] | None = None,
) -> Column:
    """All options as one row-wise predicate; works on streams as well."""
    datacenters, clusters = list(datacenters or ()), list(clusters or ())
    parts = [
        hosts_predicate(hosts),
        any_glob(F.col("datacenter"), datacenters) if datacenters else None,
        any_glob(F.col("cluster"), clusters) if clusters else None,
    ]
    return reduce(lambda left, right: left & right, [p for p in parts if p is not None], F.lit(True))


def select_hosts(
    inventory: DataFrame,
    hosts: Iterable[str] | None = None,
    datacenters: Iterable[str] | None = None,
    clusters: Iterable[str] | None = None,
    aliases: DataFrame | None = None,
    per_cluster: bool = False,
) -> DataFrame:
    """The chosen inventory rows.

    With an alias table (name, ip), literal hosts also match through it.
    """
    _, literals = sift(hosts)
    if aliases is None or not literals:
        chosen = inventory.filter(selection_predicate(hosts, datacenters, clusters))
    else:
        one = inventory.sparkSession.range(0, 1, 1, 1)
        wanted = one.select(F.explode(F.split(F.lit("\x00".join(literals)), "\x00")).alias("name"))
        resolved = resolve_names(inventory, wanted, aliases).filter("how <> 'direct'")
        hits = resolved.select("address", F.lit(True).alias("_hit")).distinct()
        narrowed = inventory.filter(selection_predicate(None, datacenters, clusters))
        chosen = (
            spread_join(narrowed, hits, ["address"], "left")
            .filter(hosts_predicate(hosts) | F.col("_hit"))
            .select(*inventory.columns)
        )
    return one_per_cluster(chosen) if per_cluster else chosen


def select_wanted(inventory: DataFrame, wanted: DataFrame) -> DataFrame:
    """Inventory rows whose address is in the wanted table (name)."""
    names = wanted.select(F.col("name").alias("address")).distinct()
    return spread_join(inventory, names, ["address"], "left_semi")


def _names(wanted: DataFrame) -> DataFrame:
    return wanted.select("name").filter("name is not null").distinct()


def _addresses(inventory: DataFrame) -> DataFrame:
    return inventory.select("address").distinct()


def _by_name(missing: DataFrame, addresses: DataFrame, aliases: DataFrame) -> DataFrame:
    """Missing names whose ip is an address; many names may share one ip."""
    pairs = aliases.select("name", F.col("ip").alias("address"))
    asked = spread_join(pairs, missing, ["name"], "left_semi").distinct()
    return spread_join(asked, addresses, ["address"], "left_semi").select("name", "address")


def _by_address(names: DataFrame, addresses: DataFrame, aliases: DataFrame) -> DataFrame:
    """Wanted names that are the ip of an address."""
    pairs = aliases.select(F.col("ip").alias("name"), F.col("name").alias("address"))
    asked = spread_join(pairs, names, ["name"], "left_semi").distinct()
    return spread_join(asked, addresses, ["address"], "left_semi").select("name", "address")


def resolve_names(inventory: DataFrame, wanted: DataFrame, aliases: DataFrame) -> DataFrame:
    """How each wanted name is found: distinct (name, address, how).

    ``direct``: the name is an address. ``name``: the name is not, but its ip is.
    ``address``: the ip of an address is a wanted name; tried only while some
    name is still not found, and then for every wanted name.
    """
    names, addresses = _names(wanted), _addresses(inventory)
    known = addresses.withColumnRenamed("address", "name")
    direct = names.join(known, "name", "left_semi")
    missing = names.join(known, "name", "left_anti")
    by_name = _by_name(missing, addresses, aliases)
    left = missing.join(by_name, "name", "left_anti")
    some_left = left.limit(1).agg((F.count("*") > 0).alias("some")).scalar()
    by_address = _by_address(names, addresses, aliases).filter(some_left)
    return (
        direct.select("name", F.col("name").alias("address"), F.lit("direct").alias("how"))
        .union(by_name.select("name", "address", F.lit("name")))
        .union(by_address.select("name", "address", F.lit("address")))
    )


def unknown_hosts(inventory: DataFrame, wanted: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Wanted names found neither directly nor through the alias table."""
    addresses = _addresses(inventory)
    missing = _names(wanted).join(addresses.withColumnRenamed("address", "name"), "name", "left_anti")
    if aliases is None:
        return missing
    # While a name is unknown, both directions are tried, so no further condition is needed.
    found = _by_name(missing, addresses, aliases).union(_by_address(missing, addresses, aliases))
    return missing.join(found.select("name"), "name", "left_anti")


def _grams(text: Column, size: int) -> Column:
    """The distinct parts of a text that are ``size`` characters long."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    parts = F.transform(starts, lambda at: F.concat(F.lit(f"={size}:"), text.substr(at, F.lit(size))))
    return F.when(F.length(text) >= size, F.array_distinct(parts)).otherwise(F.array().cast("array<string>"))


def _filed(globs: DataFrame, values: DataFrame) -> DataFrame:
    """(pattern, key, salts): the text under which each glob is looked up, and for how many parts of the values.

    The longest literal end, if it is not short; else the inner part (of three characters, or of fewer where no
    literal is that long) that the fewest values hold; ``any`` without a literal. Globs with a part that no value
    holds match none and are left out.
    """
    pattern = F.col("pattern")
    prefix, suffix = literal_prefix(pattern), literal_suffix(pattern)
    end = F.coalesce(
        *[
            F.when(F.length(text) >= size, F.concat(F.lit(f"{end}{size}:"), cut))
            for size in _ANCHORS
            for end, text, cut in (
                ("<", prefix, F.left(prefix, F.lit(size))),
                (">", suffix, F.right(suffix, F.lit(size))),
            )
        ]
    )
    longest = F.array_max(F.transform("_runs", F.length))

    def of_size(size: int) -> Column:
        return F.array_distinct(F.flatten(F.transform("_runs", lambda run: _grams(run, size))))

    parts = F.when(longest >= _GRAMS[0], of_size(_GRAMS[0]))
    for size in _GRAMS[1:]:
        parts = parts.when(longest >= size, of_size(size))
    inner = end.isNull() & has_literal(pattern)
    by_end = globs.filter(~inner).select(pattern, F.coalesce(end, F.lit("any")).alias("_key"), F.lit(SALTS).alias("_salts"))
    # An outer generator: for a plain one Spark infers a filter that cuts the globs again.
    asked = (
        globs.filter(inner)
        .select(pattern, literal_runs(pattern).alias("_runs"))
        .select(pattern, F.explode_outer(parts).alias("_key"))
        .filter("_key is not null")
    )
    held = values.select(F.explode(F.concat(*[_grams(F.col("_value"), size) for size in _GRAMS])).alias("_key"))
    wanted = asked.select("_key").distinct()
    counts = held.join(wanted, "_key", "left_semi").groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    rarest = (
        asked.join(counts, "_key", "left")
        .groupBy("pattern")
        .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_key")).alias("_rarest"))
        .filter("_rarest.n > 0")
        .select("pattern", F.col("_rarest._key").alias("_key"), F.ceil(F.col("_rarest.n") / MET).cast("int").alias("_salts"))
    )
    return by_end.unionByName(rarest)


def _looked_up(values: DataFrame, patterns: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """(distinct values by their keys, globs by theirs, when the two match)."""
    pattern, value = F.col("pattern"), F.col("_value")
    partitions = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    globs = patterns.select("pattern").filter(pattern.isNotNull()).distinct()
    prefix, suffix = literal_prefix(pattern), literal_suffix(pattern)
    # Hot keys meet the values by parts, so their globs are repeated for each part.
    filed = _filed(globs, values).select(
        pattern,
        F.col("_key").alias("_end"),
        F.when(pattern == F.concat(prefix, F.lit("*")), prefix).alias("_starts"),
        F.when(pattern == F.concat(F.lit("*"), suffix), suffix).alias("_ends"),
        F.when(pattern == F.concat(F.lit("*"), F.get(literal_runs(pattern), F.lit(1)), F.lit("*")), F.get(literal_runs(pattern), F.lit(1))).alias("_holds"),
        regex_of(pattern).alias("_regex"),
        "_salts",
        F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"),
    )
    ends = F.array_compact(
        F.array(
            *[
                F.when(F.length(value) >= size, F.concat(F.lit(f"{end}{size}:"), cut(value, F.lit(size))))
                for size in _ANCHORS
                for end, cut in (("<", F.left), (">", F.right))
            ],
            F.lit("any"),
        )
    )
    keyed = values.select("_value", F.explode(F.concat(ends, *[_grams(value, size) for size in _GRAMS])).alias("_end"))
    # Only what some glob is filed under is probed; the distinct keys are the side to build from.
    keys = filed.select("_end", "_salts").distinct().hint("shuffle_hash")
    keyed = keyed.join(keys, "_end").select(
        "_value", "_end", F.pmod(F.xxhash64("_value"), F.col("_salts")).cast("int").alias("_salt")
    )
    # Many times the rows that Spark expects, which knows no explosion: neither broadcast nor put into few tasks.
    keyed = keyed.repartition(partitions, "_end", "_salt").hint("merge")
    matches = (
        (keyed["_end"] == filed["_end"])
        & (keyed["_salt"] == filed["_salt"])
        & F.when(filed["_starts"].isNotNull(), F.startswith(keyed["_value"], filed["_starts"]))
        .when(filed["_ends"].isNotNull(), F.endswith(keyed["_value"], filed["_ends"]))
        .when(filed["_holds"].isNotNull(), F.contains(keyed["_value"], filed["_holds"]))
        .otherwise(F.rlike(keyed["_value"], filed["_regex"]))
    )
    return keyed, filed, matches


def _values(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(F.col(column).alias("_value")).filter("_value is not null").distinct()


def match_patterns(rows: DataFrame, patterns: DataFrame, column: str = "address") -> DataFrame:
    """Rows whose column matches at least one glob of a table (pattern).

    Every glob is filed under a literal text that its matches must hold: its longest
    end, or of a glob such as ``*abc*`` the inner part that the fewest values hold.
    Distinct values look up only the globs filed under their own ends and parts, so
    this is an equi join with the full match as a second condition. ``a*``, ``*a``
    and ``*a*`` are tested by their text alone, other globs by a regular expression.
    A hot end (all hosts share a prefix) is salted by value, as are globs without any
    literal, which alone meet every value.
    """
    keyed, filed, matches = _looked_up(_values(rows, column), patterns)
    hits = keyed.join(filed, matches, "left_semi").select(F.col("_value").alias(column)).distinct()
    return spread_join(rows, hits, [column], "left_semi")


def pattern_hits(rows: DataFrame, patterns: DataFrame, column: str = "address") -> DataFrame:
    """Each distinct glob with each distinct value of the column that it matches: (pattern, value).

    A glob is filed under one key and a value holds each key once, so a pair is met once: no task has to
    remember the pairs it has made.
    """
    keyed, filed, matches = _looked_up(_values(rows, column), patterns)
    return keyed.join(filed, matches).select("pattern", F.col("_value").alias("value"))


def one_per_cluster(inventory: DataFrame, by: str = "cluster") -> DataFrame:
    """One host per cluster: an SPM host, else an up host, else any.

    Ties go to the lowest address, then data center. Clusters are told apart by
    name unless ``by="cluster_id"``. An aggregate, not a window, so a cluster
    with a third of all hosts is reduced before it is shuffled.
    """
    rest = [name for name in ("datacenter", "cluster", "cluster_id", "gluster_enabled") if name != by]
    best = F.min(F.struct(~F.col("is_spm"), ~F.col("is_up"), "address", *rest, "is_spm", "is_up"))
    return (
        inventory.groupBy(by)
        .agg(best.alias("_best"))
        .select(*[F.col(by) if name == by else F.col(f"_best.{name}") for name in inventory.columns])
    )


def selection_summary(inventory: DataFrame, selected: DataFrame) -> DataFrame:
    """One row: how many hosts there are and are chosen, and what to warn about.

    The chosen rows are part of the inventory, so equal counts mean all of it.
    """
    counted = inventory.select(F.lit(1).alias("_all"), F.lit(0).alias("_some")).union(
        selected.select(F.lit(0), F.lit(1))
    )
    return counted.agg(
        F.coalesce(F.sum("_all"), F.lit(0)).alias("hosts"),
        F.coalesce(F.sum("_some"), F.lit(0)).alias("selected"),
    ).select(
        "hosts",
        "selected",
        ((F.col("hosts") > 0) & (F.col("hosts") == F.col("selected"))).alias("all_selected"),
        (F.col("selected") >= LARGE_FLEET).alias("large_fleet"),
    )


def chain_hosts(inventory: DataFrame, fallback_to_up: bool = False) -> DataFrame:
    """Per data center the host that dumps the volume chains, or null.

    It is an up SPM host; with ``fallback_to_up`` any up host will do when there
    is none. Ties go to the lowest address.
    """
    fits = F.col("is_up") if fallback_to_up else F.col("is_up") & F.col("is_spm")
    best = F.min(F.when(fits, F.struct(~F.col("is_spm"), F.col("address").alias("address"))))
    return inventory.groupBy("datacenter").agg(best["address"].alias("chain_host"))


def with_chain_flag(inventory: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """Inventory rows with ``is_chain_host``.

    Joined on data center and address together, which are seldom hot; the data
    center alone would be.
    """
    chosen = chain_hosts(inventory) if chosen is None else chosen
    flags = chosen.filter(F.col("chain_host").isNotNull()).select(
        "datacenter", F.col("chain_host").alias("address"), F.lit(True).alias("_chain")
    )
    return spread_join(inventory, flags, ["datacenter", "address"], "left").select(
        *inventory.columns, F.coalesce("_chain", F.lit(False)).alias("is_chain_host")
    )
