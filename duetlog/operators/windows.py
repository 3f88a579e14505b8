"""Window helpers that scale past one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _laid(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], partitions: int | None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``(keys, order)`` with the
    layout written into data: ``_pid`` and the place ``_mid``.

    The last sort key is each row's number before the exchange, which no two
    rows share, so equal rows - even a single hot value - are cut over several
    partitions.  The layout is checkpointed reliably: a recomputation after
    executor loss cannot number the rows anew."""
    full = [*keys, *order, "_tie"]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    spread = tied.repartitionByRange(partitions, *full) if partitions else tied.repartitionByRange(*full)
    return cut_lineage(spread.sortWithinPartitions(*full).withColumn("_pid", F.spark_partition_id())
                             .withColumn("_mid", F.monotonically_increasing_id()))


def _with_offsets(laid: DataFrame, keys: Sequence[str], amount: Column) -> DataFrame:
    """``laid`` with ``_off``: the sum of ``amount`` over the group's earlier
    partitions, and ``_m0``, the group's first place in this partition."""
    counts = laid.groupBy("_pid", *keys).agg(F.sum(amount).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    if not keys:                     # one row per partition: a bounded broadcast
        offsets = F.broadcast(offsets)
    o = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in ["_pid", *keys]], "_off", "_m0")
    cond = F.col("_pid") == F.col("_o__pid")
    for k in keys:                   # null group keys must still meet their own counts
        cond = cond & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return laid.join(o, cond).drop(*[f"_o_{c}" for c in ["_pid", *keys]])


def global_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "row_number",
                      partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by ...)`` across the whole frame, without
    moving every row into one task: ``row_number_within`` with no group
    columns."""
    return row_number_within(df, [], order, out, partitions)


def row_number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                      out: str = "row_number", partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by ...)`` without putting
    a group into one task.

    Rows are laid out by ``_laid``; rows per (partition, group) are counted,
    and a running sum of those counts over each group's partitions gives the
    offset added to each row's position in its partition.  Ties in ``order``
    are numbered in an arbitrary order, fixed once laid out."""
    laid = _laid(df, keys, order, partitions)
    return (_with_offsets(laid, keys, F.lit(1))
            .withColumn(out, F.col("_off") + F.col("_mid") - F.col("_m0") + 1)
            .drop("_pid", "_mid", "_m0", "_off", "_tie"))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], amount: str,
                out: str, partitions: int | None = None) -> DataFrame:
    """``sum(amount) over (partition by keys order by ... rows unbounded
    preceding)`` in the same way: sums inside a partition plus the sums of the
    group's earlier partitions."""
    laid = _laid(df, keys, order, partitions)
    w = Window.partitionBy("_pid", *keys).orderBy("_mid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (_with_offsets(laid, keys, F.col(amount))
            .withColumn(out, F.col("_off") + F.sum(amount).over(w))
            .drop("_pid", "_mid", "_m0", "_off", "_tie"))
