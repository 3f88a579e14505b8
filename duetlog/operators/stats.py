"""Grouped statistics that the studied jobs compute with collected lists or
self-joins, re-expressed so no group is ever gathered into one array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import running_sum


#: ``percentile_approx`` is off by at most 1 / ACCURACY of a group's rows; the
#: bracket around the median is four times that wide on either side.
ACCURACY = 5000
BRACKET = 4 / ACCURACY


def upper_median(df: DataFrame, keys: Sequence[str], value: str | Column,
                 out: str = "median", where: Column | None = None) -> DataFrame:
    """Element ``n div 2 + 1`` (1-based) of the sorted non-null values per
    group - the studied jobs' ``element_at(sort_array(collect_list(x)), n/2+1)``
    without building the list.  ``where`` keeps only rows meeting a
    condition.  NaN sorts last, after infinity.

    Approximate quantiles just below and above the middle (merged map-side)
    bracket it for certain.  One more aggregate counts the rows under the
    bracket and the values inside it, and only those few values are ranked, by
    a running sum over range partitions: neither a hot group nor its bracket
    is sorted in one task."""
    rows = _bracketed(df, keys, F.col(value) if isinstance(value, str) else value, where)
    rows = running_sum(rows, keys, ["_inside", "_value"], "_c", "_through")
    goal = F.floor(F.col("_n") / 2) + 1
    return rows.where((F.col("_through") >= goal) & (F.col("_through") - F.col("_c") < goal)).select(
        *keys, F.col("_value").alias(out))


def sorted_list(df: DataFrame, keys: Sequence[str], value: str, out: str = "values") -> DataFrame:
    """``sort_array(collect_list(value))`` per group; nulls are left out.  Each
    value is counted first, so what is shuffled and sorted is the distinct
    values; the list itself is one row of its group, whose length is the
    caller's to bound (``row_number_within`` gives the long form)."""
    counted = df.groupBy(*keys, value).agg(F.count(value).cast("int").alias("_n"))
    runs = F.sort_array(F.collect_list(F.when(F.col("_n") > 0, F.struct(F.col(value).alias("v"), "_n"))))
    return counted.groupBy(*keys).agg(runs.alias("_runs")).select(
        *keys, F.flatten(F.transform("_runs", lambda r: F.array_repeat(r["v"], r["_n"]))).alias(out))


def _bracketed(df: DataFrame, keys: Sequence[str], v: Column, where: Column | None = None) -> DataFrame:
    """(keys, _inside, _value, _c, _n): per group the count of rows under the
    bracket (``_inside`` false) and of every value in it; ``_n`` rows in all."""
    # the row condition is applied inside the aggregates rather than filtered
    # before them, so the input subtree stays identical to the caller's other
    # aggregates and its shuffle is reused, not redone
    cond = v.isNotNull() if where is None else (where & v.isNotNull())
    x = _order_number(df.select(*keys, F.when(cond, v).alias("_v")), keys, "_v")
    bounds = x.groupBy(*keys).agg(
        F.percentile_approx("_o", [0.5 - BRACKET, 0.5 + BRACKET], ACCURACY).alias("_p"), F.count("_v").alias("_n"))
    x = _join_keys(x, bounds.where("_n > 0"), keys)
    lo, hi, o = F.get("_p", F.lit(0)), F.get("_p", F.lit(1)), F.col("_o")
    inside = (o >= lo) & (o <= hi)
    return (x.groupBy(*keys, "_n", F.when(o < lo, F.lit(False)).when(inside, F.lit(True)).alias("_inside"),
                      F.when(inside, F.col("_v")).alias("_value"))
             .agg(F.count("_v").alias("_c")).where(F.col("_inside").isNotNull() & (F.col("_c") > 0)))


def _join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Inner join on keys that may be null; the right side's keys are dropped."""
    r = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & left[k].eqNullSafe(r[f"_k{i}"])
    for c in more:
        cond = cond & c
    return left.join(r, cond).drop(*[f"_k{i}" for i in range(len(keys))])


def _order_number(h: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``h`` with ``_o``, a double that never decreases along ``value``.

    Numbers, dates and times are cast; text takes the six bytes after the
    prefix that all of the group's values share (the least and the greatest
    share it), so ids and ISO dates of one decade still differ."""
    kind = dict(h.dtypes)[value].split("(")[0]
    v = F.col(value)
    if kind in ("string", "char", "varchar", "binary"):
        ends = h.groupBy(*keys).agg(F.min(v.cast("binary")).alias("_lo"), F.max(v.cast("binary")).alias("_hi"))
        lo, hi = F.hex("_lo"), F.hex("_hi")
        same = F.size(F.filter(F.sequence(F.lit(0), F.least(F.length("_lo"), F.length("_hi"))),
                               lambda i: F.substring(lo, F.lit(1), 2 * i) == F.substring(hi, F.lit(1), 2 * i))) - 1
        h = _join_keys(h, ends.select(*keys, same.alias("_same")), keys)
        six = F.rpad(F.substring(F.hex(v.cast("binary")), 2 * F.col("_same") + 1, F.lit(12)), 12, "0")
        return h.withColumn("_o", F.conv(six, 16, 10).cast("double")).drop("_same")
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return h.withColumn("_o", F.unix_micros(v.cast("timestamp")).cast("double"))
    d = v.cast("double")
    return h.withColumn("_o", F.when(F.isnan(d), F.lit(float("inf"))).otherwise(d))   # ties with infinity: inside, ranked by value


def with_percent_of_total(df: DataFrame, count_col: str, partition: Sequence[str], out: str = "percent") -> DataFrame:
    """``df`` with ``count / sum(count) of the group * 100``: the totals come
    from an aggregate (combined map-side) joined back, so no task buffers a
    whole group; adaptive execution broadcasts the totals while they are
    small and splits a hot group otherwise."""
    totals = df.groupBy(*partition).agg(F.sum(count_col).alias("_total"))
    return _join_keys(df, totals, partition).withColumn(out, F.col(count_col) / F.col("_total") * 100).drop("_total")


def topk_per_group(df: DataFrame, partition: Sequence[str], order_col: str, k: int,
                   rank_col: str = "rk", percent_col: str | None = "percent") -> DataFrame:
    """Rank (ties share, gaps) by ``order_col`` descending inside each group,
    keep ``rank <= k``; optionally add the percent of the group total.

    The total is aggregated from all rows of the group and joined to the few
    that are kept; ``rank`` + filter is planned as a ``WindowGroupLimit`` below
    the rank window, so each task keeps at most ``k`` rows per group before
    anything is shuffled.
    """
    w = Window.partitionBy(*partition).orderBy(F.col(order_col).desc())
    out = df.withColumn(rank_col, F.rank().over(w)).where(F.col(rank_col) <= k)
    if percent_col:
        totals = df.groupBy(*partition).agg(F.sum(order_col).alias("_total"))
        out = _join_keys(out, totals, partition).withColumn(
            percent_col, F.col(order_col) / F.col("_total") * 100).drop("_total").select(*df.columns, percent_col, rank_col)
    return out


def rank_within(df: DataFrame, partition: Sequence[str], order_col: str, out: str = "rk") -> DataFrame:
    """``rank()`` by ``order_col`` descending per group (ties share, gaps)
    without sorting a group in one task: a value's rank is one more than the
    rows above it, and rows are first counted per (group, value)."""
    values = df.groupBy(*partition, order_col).agg(F.count(F.lit(1)).alias("_n"))
    above = running_sum(values, partition, [F.col(order_col).desc()], "_n", "_through")
    above = above.select(*partition, F.col(order_col).alias("_value"), (F.col("_through") - F.col("_n") + 1).cast("int").alias(out))
    return _join_keys(df, above, partition, df[order_col].eqNullSafe(F.col("_value"))).drop("_value")
