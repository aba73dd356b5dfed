"""Operator 10: mix sources to target weights by systematic sampling.

Targets: the sources share the total size by their weights; a target stops at
``max_copies`` times its source's size and the excess is shared by weight among
the others until none is above.  With the sources ordered by size per weight
that is a prefix sum over the sources.

Sampling: a document's expected number of copies is its source's target over
its source's size.  Within a source the expected copies are added up in the
order of size and id, one offset (from the seed) is added, and a document is
emitted once for each integer that its step crosses.  Ordering by size keeps
the words taken near the target.

The running sum needs a document's rank in its source.  The rows are range
partitioned by (source, size, id), sorted and written once with their position;
the counts per (source, partition) give every partition its offset.  So no
source, however large, is gathered in one task.

Cases: null text has size 0; documents without a source form the last source;
a source without words has target 0 and is never taken; equal rows are
interchangeable; an empty table gives an empty result; extra columns pass
through (those named like an output are replaced); a text of any
length is one document, taken whole.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphcluster.llm.common import WORD, Table, partitions

WEIGHTS = (1, 2, 3)    #: weights of the sources by code point, repeating
MAX_COPIES = 3
SEED = 10

OUTPUTS = ["size", "source_size", "target", "copies", "taken"]


def offset(seed: int = SEED) -> float:
    return random.Random(seed).random()


def with_size(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("size", F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            max_copies: int = MAX_COPIES) -> DataFrame:
    """``sources`` (source, source_size; one row each) with ``target``."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int"))
    s = sources.withColumn("w", weight.cast("long")).withColumn("cap", max_copies * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("left", F.sum("source_size").over(Window.partitionBy())
                      - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("w_left", F.sum("w").over(Window.partitionBy())
                     - F.coalesce(F.sum("w").over(before), F.lit(0)))
         .withColumn("level", F.col("left") / F.col("w_left"))
         .withColumn("open", F.col("cap") / F.col("w") > F.col("level")))
    # the level at the first source that stays below its cap holds for all that follow
    level = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return s.select("source", "source_size",
                    F.coalesce(level * F.col("w"), F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text",
        weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES,
        seed: int = SEED) -> DataFrame:
    """Append size, source_size, target, copies and taken (copies times size)."""
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c.lower() not in OUTPUTS]
    rows = with_size(docs.select(*columns), text)
    return sampled(rows, source, key, weights, max_copies, seed, partitions(spark))


def sampled(rows: DataFrame, source: str, key: str, weights, max_copies, seed, n: int) -> DataFrame:
    """The mix of rows that have a ``size``."""
    columns = [c for c in rows.columns if c != "size"]
    placed = Table(rows.repartitionByRange(n, F.col(source).asc_nulls_last(), "size", key)
                   .sortWithinPartitions(F.col(source).asc_nulls_last(), "size", key)
                   .withColumn("_at", F.monotonically_increasing_id()), "placed").df
    # a row for each source and partition that holds some of it
    part = F.shiftright("_at", 33)
    pieces = Table(placed.groupBy(F.col(source).alias("source"), part.alias("part")).agg(
        F.min("_at").alias("first"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("s")), "pieces").df
    goal = targets(pieces.groupBy("source").agg(F.sum("s").alias("source_size")), weights, max_copies)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = pieces.select("source", "part", "first",
                         F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    plan = Table(base.alias("b").join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source")))
                 .select(F.col("b.source").alias("_source"), F.col("part").alias("_part"),
                         (F.col("first") - F.col("base")).alias("_zero"), "source_size", "target"),
                 "mixplan").df
    out = placed.join(plan, F.col(source).eqNullSafe(F.col("_source")) & (part == F.col("_part")))
    u = offset(seed)
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rank = (F.col("_at") - F.col("_zero") + 1).cast("double")
    copies = F.floor(rank * step + u) - F.floor((rank - 1) * step + u)
    out = out.withColumn("copies", F.least(F.lit(max_copies), copies).cast("long"))
    out = out.withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*columns, *OUTPUTS)


def repeat_documents(docs: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text",
                     weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES,
                     seed: int = SEED) -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    rows = with_size(docs.select(F.struct("*").alias("_row"), F.col(source).alias("source"),
                                 F.col(key).alias("doc_id"), F.col(text).alias("text"))).drop("text")
    mixed = sampled(rows, "source", "doc_id", weights, max_copies, seed, partitions(docs.sparkSession))
    return (mixed.where(F.col("copies") > 0)
            .select("_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
            .select("_row.*"))
