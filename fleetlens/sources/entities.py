"""Landed extracts of data centers, clusters and hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.inventory import inventory

DATACENTER = "id string, name string"
CLUSTER = "id string, name string, gluster_enabled boolean, data_center_id string"
HOST = "address string, name string, status string, spm_status string, cluster_id string"


def read_entities(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """One entity table in any file format Spark reads; the schema is never inferred."""
    return spark.read.format(fmt).schema(schema).load(path)


def load_inventory(
    spark: SparkSession, datacenters: str, clusters: str, hosts: str, fmt: str = "parquet"
) -> DataFrame:
    """The distinct inventory of three landed extracts."""
    return inventory(
        read_entities(spark, datacenters, DATACENTER, fmt),
        read_entities(spark, clusters, CLUSTER, fmt),
        read_entities(spark, hosts, HOST, fmt),
    )
