"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

Each source's documents stand in a queue in shuffled order, twice over. The virtual finish time of a
document is the running total of its source's words up to and with it, divided by the target of the
source. All queues are merged by a global range sort on that time and cut where the budget is spent.
Within a source the merged order is that of the shuffle key, so what is taken is known from one
border per source; texts are never shuffled.

The running totals of a source are worked out over 4096 shards of the key, so that no source, however
large, is in one task. Sources are ordered by code point, a null source last; their weights go round
``WEIGHTS``. Targets share out ``SHARE`` of all words by weight; none exceeds ``REPEATS`` times its source.

A null or blank text has size 0 and is not taken. Rows with a null id have their own place in the
shuffle. Identical rows are taken alike, so at the border of a source the cut may be passed by
copies of one row. An empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.textkit import unused
from millrace.session import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def shuffle_key(doc_id: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``source, source_size, source_rank, target``: one row per source of ``sized`` (source, size).

    What sources above their limit leave is shared out by weight again until none is above. That ends
    at one level for all others: going up by limit per weight, the first source whose limit reaches
    the level that is left. The windows see one row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sources.withColumn("source_rank", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(cycle, ((F.col("source_rank") - 1) % len(weights) + 1).cast("int"))
    )
    limit = F.col("source_size") * REPEATS
    up = W.orderBy((limit / F.col("weight")).asc(), "source_rank")
    before, onward = up.rowsBetween(W.unboundedPreceding, -1), up.rowsBetween(0, W.unboundedFollowing)
    budget = F.sum("source_size").over(W.partitionBy(F.lit(1))) * F.lit(share)
    leveled = ranked.withColumn(
        "level", (budget - F.coalesce(F.sum(limit).over(before), F.lit(0))) / F.sum("weight").over(onward)
    ).withColumn("place", F.row_number().over(up))
    free = limit / F.col("weight") >= F.col("level")
    level = F.min_by("level", F.when(free, F.col("place"))).over(W.partitionBy(F.lit(1)))
    return leveled.select(
        "source", "source_size", "source_rank",
        F.least(limit.cast("double"), F.coalesce(level * F.col("weight"), limit.cast("double"))).alias("target"),
    )


def virtual_queue(sized: DataFrame, targets: DataFrame, share: float = SHARE) -> DataFrame:
    """Every copy of every document in merged order, with the words taken up to and with it.

    ``sized`` has ``doc_id, source, size, key``. Returns these with ``source_rank, copy, finish, running``;
    the budget takes the rows whose ``running`` it covers.
    """
    rows = sized.where("size > 0").withColumn("shard", F.substring("key", 1, 3))
    named = targets.withColumnRenamed("source", "t_source")
    rows = rows.join(named, rows["source"].eqNullSafe(named["t_source"])).drop("t_source")
    shard_order = W.partitionBy("source_rank").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    shards = (
        rows.groupBy("source_rank", "shard").agg(F.sum("size").alias("held"))
        .select("source_rank", "shard", F.coalesce(F.sum("held").over(shard_order), F.lit(0)).alias("ahead"))
    )
    inside = W.partitionBy("source_rank", "shard").orderBy("key", "doc_id", "size")
    total = F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0))
    queued = (
        rows.withColumn("within", total).join(shards, ["source_rank", "shard"])
        .withColumn("copy", F.explode(F.array(*[F.lit(k) for k in range(REPEATS)])))
        .withColumn("finish", (F.col("copy") * F.col("source_size") + F.col("ahead") + F.col("within")) / F.col("target"))
    )
    order = ("finish", "source_rank", "copy", "key", "doc_id", "size")
    ranged = written(
        queued.select(*order, "source").repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "queue"
    )
    range_order = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = (
        ranged.groupBy("range").agg(F.sum("size").alias("held"))
        .select("range", F.coalesce(F.sum("held").over(range_order), F.lit(0)).alias("before"))
    )
    running = F.sum("size").over(W.partitionBy("range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return (
        ranged.withColumn("running", running).join(ranges, "range")
        .withColumn("running", F.col("running") + F.col("before")).drop("range", "before")
    )


def _measured(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), shuffle_key(F.col("doc_id")).alias("key"))


def source_cuts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sized rows of ``docs``, and per source its size, target and the last place taken (``cut``)."""
    sized = written(_measured(docs), "sized")
    targets = written(source_targets(sized), "targets")
    budget = targets.agg(F.sum("source_size") * F.lit(SHARE)).scalar()
    taken = virtual_queue(sized, targets).where(F.col("running") <= budget)
    last = taken.groupBy("source_rank").agg(F.max(F.struct("copy", "key", "doc_id", "size")).alias("cut"))
    return sized, written(targets.join(last, "source_rank", "left").withColumnRenamed("source", "t_source"), "cuts")


def _copies(doc_id: Column, size: Column, key: Column, cut: Column) -> Column:
    """How many copies of a document stand at or before the cut of its source."""
    held = [F.struct(F.lit(k).alias("copy"), key.alias("key"), doc_id.alias("doc_id"), size.alias("size")) for k in range(REPEATS)]
    counts = [F.when((size > 0) & (h <= cut), 1).otherwise(0) for h in held]
    return sum(counts[1:], counts[0])


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of ``docs``."""
    sized, cuts = source_cuts(docs)
    copies = _copies(F.col("doc_id"), F.col("size"), F.col("key"), F.col("cut"))
    return sized.join(cuts, sized["source"].eqNullSafe(cuts["t_source"])).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, as often as it takes them; columns as given."""
    _, cuts = source_cuts(docs)
    source, cut, size, key, copy = unused(docs, "cut_source", "cut", "size", "key", "copy")
    cuts = cuts.select(F.col("t_source").alias(source), F.col("cut").alias(cut))
    # Counted once per row, in columns of their own, before copies are worked out from them.
    measured = docs.withColumns({size: word_count(F.col("text")), key: shuffle_key(F.col("doc_id"))})
    joined = measured.join(cuts, measured["source"].eqNullSafe(cuts[source]))
    copies = F.array_repeat(F.lit(0), _copies(F.col("doc_id"), F.col(size), F.col(key), F.col(cut)))
    return joined.select(*[measured[c] for c in docs.columns], F.explode(copies).alias(copy)).drop(copy)
