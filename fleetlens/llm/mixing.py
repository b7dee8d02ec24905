"""Mixing sources to target weights by Pareto order sampling.

Sources, in code-point order with null last, weigh ``weights``, repeating. They share ``share`` of all
words; a target stops at ``cap`` times its source's words and the excess is shared again by weight until
none is above. A document is expected ``target / source words`` times: the whole part of that are
copies it certainly has, the rest is its inclusion probability for one copy more. Those copies are
drawn by Pareto order sampling: documents are ranked by random odds over inclusion odds,
u/(1-u) : p/(1-p), and taken in that order up to the words that are left to the target. Words, not
rows, are the fixed size; the document that crosses it is taken if that comes nearer.

The random number comes from a hash of the identifier, so reruns and retried tasks agree. No source
is ever sorted as a whole: words are summed per source and slice of the order, then per
finer slice of the one that holds the cut, and only the documents of that slice are ranked.

Defined results: a null text has no words; a null source is a source of its own, the last; empty
documents take no words; rows that repeat an identifier and its text are taken or left together;
an empty table gives no rows; other columns are kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import WORD, partitions, shared_folder, stored

#: Slices of the order per level; two levels give 2**20 slices.
SLICES = 1024


def words(text: str | Column) -> Column:
    """Number of words of a text; a null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _uniform(doc_id: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from the identifier's SHA-256 (52 bits of it)."""
    digits = F.substring(F.sha2(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def weighted_sources(sized: DataFrame, weights: tuple[int, ...], folder: str) -> DataFrame:
    """(source, source_size, weight), the weight by the source's place; no task sees all sources."""
    order = [F.col("source").isNull(), F.col("source")]
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    dealt = stored(
        sums.repartitionByRange(partitions(sized.sparkSession), *order).withColumn("part", F.spark_partition_id()),
        f"{folder}/sources",
    )
    # One row per partition.
    before = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part",
        F.coalesce(
            F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
    )
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    return dealt.join(before, "part").select(
        "source", "source_size", F.get(cycle, (place % len(weights)).cast("int")).cast("long").alias("weight")
    )


def targets(sources: DataFrame, share: float, cap: int) -> DataFrame:
    """(source, source_size, weight) -> with ``target``; only three sums a round reach the driver."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, done = 0.0, -1
    while True:
        full = F.col("source_size") * float(cap) <= F.col("weight") * level
        stopped, used, left = sources.agg(
            F.coalesce(F.count_if(full), F.lit(0)),
            F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if stopped == done or not left:
            break
        done, pool = stopped, share * total - float(cap) * used
        level = pool / left
    if not left:
        return sources.withColumn("target", F.col("source_size") * float(cap))
    return sources.withColumn(
        "target",
        F.when(full, F.col("source_size") * float(cap)).otherwise(F.lit(pool) * F.col("weight") / F.lit(float(left))),
    )


def _ranked(rows: DataFrame) -> DataFrame:
    """Add ``whole`` copies, the order key ``q`` and its slice; ``rows`` have source_size, target, doc_id."""
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("whole", F.floor(times)).withColumn("rest", times - F.floor(times))
    u = _uniform(F.col("doc_id"), "mix:")
    odds = (u / (1 - u)) / (F.col("rest") / (1 - F.col("rest")))
    rows = rows.withColumn("q", F.when(F.col("rest") > 0, odds))
    return rows.withColumn("slice", F.floor(F.col("q") / (F.col("q") + 1) * (SLICES * SLICES)))


def _crossing(sums: DataFrame, slice_of: str) -> DataFrame:
    """Of (source, slice, words, left): the first slice at which a source's words reach what is left."""
    upto = Window.partitionBy("source").orderBy(slice_of).rowsBetween(Window.unboundedPreceding, 0)
    run = sums.withColumn("upto", F.sum("words").over(upto)).filter("upto >= left")
    return run.groupBy("source").agg(F.min(F.struct(slice_of, "upto", "words", "left")).alias("at")).select(
        "source",
        F.col(f"at.{slice_of}").alias(slice_of),
        (F.col("at.left") - F.col("at.upto") + F.col("at.words")).alias("left"),
    )


def mix_plan(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: int = 2,
    folder: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(sized documents, plan): the plan has a source's words, target and where its order is cut."""
    folder = folder or shared_folder(docs.sparkSession, "mix")
    sized = stored(
        docs.select(
            "doc_id", "source", words("text").alias("size"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")
        ),
        f"{folder}/sized",
    )
    sources = stored(weighted_sources(sized, weights, folder), f"{folder}/weighted")
    plan = stored(targets(sources, share, cap), f"{folder}/targets")
    same = sized["source"].eqNullSafe(plan["source"])
    ranked = _ranked(sized.join(plan, same).drop(plan["source"]))
    # Words left to the target once every document has its whole copies.
    sums = stored(
        ranked.groupBy("source", (F.floor(F.col("slice") / SLICES)).alias("coarse")).agg(
            F.sum("size").alias("words"),
            F.first(F.col("target") - F.col("whole") * F.col("source_size")).alias("left"),
        ),
        f"{folder}/coarse",
    )
    coarse = stored(_crossing(sums.filter("coarse is not null and left > 0"), "coarse"), f"{folder}/coarse-cut")
    open_rows = ranked.filter("q is not null").select("source", "slice", "q", "doc_id", "tie", "size")
    within = open_rows.withColumn("coarse", F.floor(F.col("slice") / SLICES)).join(
        coarse.select(F.col("source").alias("cut_source"), F.col("coarse").alias("cut"), "left"),
        F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("coarse") == F.col("cut")),
    ).select("source", "slice", "q", "doc_id", "tie", "size", "left")
    within = stored(within, f"{folder}/within")
    fine = stored(
        _crossing(
            within.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("left").alias("left")),
            "slice",
        ),
        f"{folder}/fine-cut",
    )
    last = within.drop("left").join(
        fine.select(F.col("source").alias("cut_source"), F.col("slice").alias("cut"), "left"),
        F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("slice") == F.col("cut")),
    )
    key = F.struct("q", "doc_id", "tie")
    last = last.groupBy("source", key.alias("key")).agg(F.sum("size").alias("size"), F.first("left").alias("left"))
    upto = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    taken = (
        last.withColumn("upto", F.sum("size").over(upto))
        .filter("upto - size / 2 <= left")
        .groupBy("source")
        .agg(F.max("key").alias("last"))
    )
    first = plan.join(
        fine.select(F.col("source").alias("s1"), F.col("slice").alias("cut_slice")),
        F.col("source").eqNullSafe(F.col("s1")),
        "left",
    ).join(taken.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2")), "left")
    plan = first.select(
        "source",
        "source_size",
        "target",
        # Without a crossing every document is taken once more, unless nothing is left to take.
        F.coalesce("cut_slice", F.lit(SLICES * SLICES + 1)).alias("cut_slice"),
        "last",
    )
    return sized, stored(plan, f"{folder}/plan")


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Add source_size, target and ``copies`` to rows that have doc_id, source and tie."""
    named = plan.withColumnRenamed("source", "plan_source")
    ranked = _ranked(rows.join(named, rows["source"].eqNullSafe(named["plan_source"])).drop("plan_source"))
    more = (F.col("slice") < F.col("cut_slice")) | (
        (F.col("slice") == F.col("cut_slice")) & (F.struct("q", "doc_id", "tie") <= F.col("last"))
    )
    extra = F.when(F.col("q").isNotNull() & F.coalesce(more, F.lit(False)), 1).otherwise(0)
    return ranked.withColumn("copies", (F.col("whole") + extra).cast("int")).drop(
        "whole", "rest", "q", "slice", "cut_slice", "last"
    )


def mix_sources(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken (words)."""
    sized, plan = mix_plan(docs, folder=folder, **options)
    return with_copies(sized, plan).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``."""
    _, plan = mix_plan(docs, folder=folder, **options)
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source").withColumn(
        "tie", F.xxhash64(F.coalesce("row.text", F.lit("")))
    )
    drawn = with_copies(rows, plan).filter("copies > 0")
    return drawn.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
