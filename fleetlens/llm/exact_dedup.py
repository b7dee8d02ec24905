"""Exact dedup as a stateful stream over digests, with full bytes checked on hits.

A narrow landing table (digest, id, place of the row) is read as a stream. Its state is keyed by
digest and kept in RocksDB on disk without expiry: the number of rows seen, the identifier that stays
(the largest) and where its content lies. A later run over more rows goes on with the same state.
Rows whose digest was hit are then read by their place and compared byte by byte with the row that
stays; should one digest ever stand for two texts, the texts of that digest are told apart in full.

Defined results: a null text counts as empty, so null and empty texts are equal; of rows that repeat
an identifier and its text exactly one stays (the last by place); a null identifier is smaller than
any other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import partitions, shared_folder, stored, with_locator

#: Landed rows that are worth a state partition.
STATE_ROWS = 10_000
#: Native memory of an executor for state, in MB.
STATE_MB = 128

_PLACE = ("doc_id", "_file", "_row")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def land(docs: DataFrame, path: str, digest=sha256) -> DataFrame:
    """Write the landing table: digest, length in bytes, identifier, place. ``docs`` has a locator."""
    text = F.coalesce("text", F.lit(""))
    return stored(
        docs.select(digest(text).alias("digest"), F.octet_length(text).alias("n_bytes"), *_PLACE), path
    )


def update_state(spark: SparkSession, landing: str, schema, state: str, rows: int) -> DataFrame:
    """Run the stream over what ``landing`` holds beyond the last run; return the state of every digest.

    The stream has no watermark, so no key ever expires. Copies within a task are counted
    before the shuffle, so a digest that a third of all rows share is one row a task. Each
    state partition is a RocksDB of its own, some megabytes even if empty: there are as many as shuffle
    partitions, but none for fewer than STATE_ROWS of the ``rows`` of the first run.
    """
    session = spark.newSession()
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    # What all state stores of an executor take together outside its heap.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", str(STATE_MB))
    stores = max(1, min(partitions(spark), -(-rows // STATE_ROWS)))
    session.conf.set("spark.sql.streaming.internal.stateStore.partitions", str(stores))
    (
        session.readStream.schema(schema)
        .parquet(landing)
        .groupBy("digest", "n_bytes")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct(*_PLACE)).alias("keeper"))
        .writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    kept = spark.read.format("statestore").load(state)
    n, keeper = kept.schema["value"].dataType.names
    return kept.select(
        "key.digest", "key.n_bytes", F.col(f"value.{n}").alias("n"), F.col(f"value.{keeper}").alias("keeper")
    )


def _decide(rows: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
    here = F.struct(*_PLACE)
    return rows.join(groups, on).select(
        *_PLACE,
        "digest",
        F.col("keeper.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        here.eqNullSafe(F.col("keeper")).alias("kept"),
    )


def exact_dedup(docs: DataFrame, folder: str | None = None, digest=sha256) -> DataFrame:
    """One row per document: doc_id, its place (_file, _row), digest, keep_id, group_size, kept.

    ``folder`` keeps landing table and state; a second call with more rows needs a folder of its own
    for the tables, see ``update_state`` for going on with a state.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "exact")
    docs = with_locator(docs, folder)
    landed = land(docs, f"{folder}/landing", digest)
    state = update_state(spark, f"{folder}/landing", landed.schema, f"{folder}/state", landed.count())
    groups = stored(state, f"{folder}/groups")
    decided = stored(_decide(landed, groups, ["digest", "n_bytes"]), f"{folder}/decided")

    # Every hit, read by its place and compared in full with the row that stays.
    hits = decided.filter("group_size > 1").select("_file", "_row", "digest", "kept")
    texts = stored(
        docs.select(*_PLACE, F.coalesce("text", F.lit("")).alias("text")).join(hits, ["_file", "_row"]),
        f"{folder}/hits",
    )
    keepers = texts.filter("kept").select("digest", F.octet_length("text").alias("n_bytes"), F.col("text").alias("full"))
    odd = (
        texts.filter("not kept")
        .withColumn("n_bytes", F.octet_length("text"))
        .join(keepers, ["digest", "n_bytes"])
        .filter("text <> full")
        .select("digest")
    )
    if odd.isEmpty():
        return decided
    odd = stored(odd.distinct(), f"{folder}/odd")
    mixed = texts.join(odd, "digest", "left_semi").select(*_PLACE, "digest", "text")
    classes = mixed.groupBy("digest", "text").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct(*_PLACE)).alias("keeper")
    )
    apart = _decide(mixed, stored(classes, f"{folder}/classes"), ["digest", "text"])
    settled = apart.select("_file", "_row")
    return decided.join(settled, ["_file", "_row"], "left_anti").select(decided.columns).unionByName(apart)
