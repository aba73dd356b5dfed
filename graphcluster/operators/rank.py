"""Row numbers inside groups without gathering a group into one task.

A window ``row_number() OVER (PARTITION BY g ORDER BY k)`` sends every row of
a group to one task, which fails when one group holds a third of the data.
``group_rank`` instead range-partitions on ``(g, k)`` -- a hot group is spread
over many partitions -- numbers rows inside each partition, and adds for
each (group, partition) the count of the same group's rows in earlier
partitions.  The only window runs over one row per (group, partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphcluster.plans.loop import Stored, shuffle_partitions, store

# Low bits of monotonically_increasing_id() hold the row index inside a partition.
_LOCAL_BITS = 33


def group_rank(df: DataFrame, group: list[str | Column], order: list[str | Column],
               name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name`` = 1-based position of the row inside its group in
    ``order`` (which must be a total order inside the group).  Group keys
    must not be NULL."""
    return ranked_table(df, group, order, name, partitions).df


def ranked_table(df: DataFrame, group: list[str | Column], order: list[str | Column],
                 name: str = "rank", partitions: int | None = None) -> Stored:
    """``group_rank`` as a table the caller may drop."""
    gcols = [F.col(g) if isinstance(g, str) else g for g in group]
    keys = [F.col(k) if isinstance(k, str) else k for k in order]
    gnames = [f"_g{i}" for i in range(len(gcols))]
    with_keys = df.select("*", *[g.alias(n) for g, n in zip(gcols, gnames)])
    by = [*map(F.col, gnames), *keys]
    # Range bounds come from sampling: written, so every use sees one layout.
    ranged = store(with_keys.repartitionByRange(partitions or shuffle_partitions(df), *by)
                   .sortWithinPartitions(*by)
                   .select("*", F.spark_partition_id().alias("_part"),
                           F.monotonically_increasing_id()
                           .bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_pos")), "ranged")
    chunks = ranged.df.groupBy(*gnames, "_part").agg(F.min("_pos").alias("_first"),
                                                     F.count("*").alias("_k"))
    before = Window.partitionBy(*gnames).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    chunks = chunks.select(*gnames, "_part", "_first",
                           F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_offset"))
    out = ranged.df.join(chunks, [*gnames, "_part"]).select(
        *df.columns,
        (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).cast("bigint").alias(name))
    result = store(out, "ranked")
    ranged.drop()
    return result
