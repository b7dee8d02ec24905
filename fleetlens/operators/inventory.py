"""The flat fleet table: data centers, clusters and hosts in one relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spread import spread_join

# Rows without a parent are spread over this many join keys that match nothing,
# so they do not all meet in one shuffle partition.
_SPREAD = 1024
# Buckets by which two inventories are compared.
BUCKETS = 4096


def _spread(parent: str, spread_by: str) -> Column:
    """The parent id; without one, a key no parent has."""
    return F.expr(f"coalesce({parent}, concat('\\0', pmod(xxhash64({spread_by}), {_SPREAD})))")


def cluster_tree(datacenters: DataFrame, clusters: DataFrame) -> DataFrame:
    """Clusters with the name of their data center, one row per cluster id.

    No data center id means the bucket named "". An id that matches nothing
    drops the cluster. A page that shifts under the reader may deliver an id
    twice: the least row counts, for clusters and data centers alike.
    """
    parents = datacenters.selectExpr("id as _parent", "name as datacenter", "true as _found")
    row = "struct(name, gluster_enabled, data_center_id, _found, datacenter)"
    return (
        clusters.withColumn("_parent", _spread("data_center_id", "id"))
        .join(parents, "_parent", "left")
        .groupBy("id")
        .agg(F.expr(f"min({row})").alias("_row"))
        .filter("_row._found or _row.data_center_id is null")
        .selectExpr(
            "if(_row._found, _row.datacenter, '') as datacenter",
            "id as cluster_id",
            "_row.name as cluster",
            "coalesce(_row.gluster_enabled, false) as gluster_enabled",
        )
    )


def inventory(datacenters: DataFrame, clusters: DataFrame, hosts: DataFrame) -> DataFrame:
    """One row per host and cluster, distinct.

    Hosts without a cluster go to the bucket whose cluster and data center are
    both "". Hosts whose cluster (or whose cluster's data center) is unknown
    are dropped; see :func:`orphans`. Clusters without hosts give no row.
    """
    tree = cluster_tree(datacenters, clusters).selectExpr(
        "cluster_id as _key", "datacenter", "cluster", "gluster_enabled", "true as _found"
    )
    placed = hosts.select(
        "address",
        F.col("cluster_id").alias("_cluster"),
        _spread("cluster_id", "address").alias("_key"),
        F.expr("spm_status <=> 'spm'").alias("is_spm"),
        F.expr("status <=> 'up'").alias("is_up"),
    )
    return (
        spread_join(placed, tree, ["_key"], "left")
        .filter("_found or _cluster is null")
        .selectExpr(
            "if(_found, datacenter, '') as datacenter",
            "coalesce(_cluster, '') as cluster_id",
            "if(_found, cluster, '') as cluster",
            "coalesce(gluster_enabled, false) as gluster_enabled",
            "address",
            "is_spm",
            "is_up",
        )
        .distinct()
    )


def orphans(datacenters: DataFrame, clusters: DataFrame, hosts: DataFrame) -> DataFrame:
    """Hosts the inventory leaves out, with the cluster id they name."""
    tree = cluster_tree(datacenters, clusters).select("cluster_id")
    placed = hosts.filter("cluster_id is not null").select("address", "cluster_id")
    return spread_join(placed, tree, ["cluster_id"], "left_anti").distinct()


def inventory_changes(old: DataFrame, new: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows that two tables of the same columns do not share: the columns, side ``old`` or ``new``, times.

    Rows are counted, so a row held twice and once differs by one. Both sides are first compared by the count and
    the sum of the row hashes of each bucket; only buckets that differ are opened, so equal tables cost two scans
    and no shuffle of rows.
    """
    columns = old.columns
    hashed = F.xxhash64(*columns)
    bucket = F.pmod(hashed, F.lit(buckets)).cast("int").alias("_bucket")

    def sums(table: DataFrame, side: str) -> DataFrame:
        total = F.sum(hashed.cast("decimal(38,0)")).alias(f"_sum_{side}")
        return table.select(*columns).groupBy(bucket).agg(total, F.count(F.lit(1)).alias(f"_n_{side}"))

    differs = ~(F.col("_sum_old").eqNullSafe(F.col("_sum_new")) & F.col("_n_old").eqNullSafe(F.col("_n_new")))
    # No more rows than there are buckets.
    opened = sums(old, "old").join(sums(new.select(*columns), "new"), "_bucket", "full").filter(differs).select("_bucket")

    def within(table: DataFrame, sign: int) -> DataFrame:
        held = table.select(*columns, bucket).join(F.broadcast(opened), "_bucket", "left_semi")
        return held.select(*columns, F.lit(sign).alias("_sign"))

    counted = within(old, -1).union(within(new, 1)).groupBy(*columns).agg(F.sum("_sign").alias("_more"))
    return counted.filter("_more <> 0").select(
        *columns, F.when(F.col("_more") > 0, "new").otherwise("old").alias("side"), F.abs("_more").alias("times")
    )
