"""Farm activity per user (PIPE-18).

The studied SQL joins seven derived tables (distinct users + six
per-behaviour aggregates) on ``(space_id, user_id)``.  Here it is one scan and
two aggregations: level 1 by ``(space, user, item)`` with one filtered
aggregate per kind, level 2 by ``(space, user)`` collecting the set of
``{item_id, count}`` entries per kind (ids are cut to whole numbers, so two
items may give one entry).  Both levels combine map-side, so a hot user
collapses to at most one row per item before the second shuffle; a set holds
at most one entry per item of the catalogue.  Feed, plant and produce test ``behavior_type``; coins and materials
test ``bn``; one row may count in both, as in the studied SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.writers import write_bucketed

KINDS = ("feed_op", "plant_op", "produce_op", "materials_op")


def valid_ids(df: DataFrame, cols=("space_id", "user_id")) -> DataFrame:
    """Rows whose ids are neither null nor 0."""
    cond = None
    for c in cols:
        e = F.col(c).isNotNull() & (F.col(c) != 0)
        cond = e if cond is None else cond & e
    return df.where(cond)


def per_item(farm: DataFrame) -> DataFrame:
    """Level 1: per (space, user, item) the sum and row count of every kind
    and the coins got and spent."""
    bt, bn, num = F.col("behavior_type"), F.col("bn"), F.col("number")
    conds = {
        "feed_op": (bt == "feed", num),
        "plant_op": (bt == "plant", num),
        "produce_op": (bt == "produce", F.lit(1).cast("bigint")),
        "materials_op": (bn == "building_materials_get", num),
    }
    aggs = []
    for k, (cond, val) in conds.items():
        aggs += [F.sum(F.when(cond, val)).alias(f"{k}_n"), F.count_if(cond).alias(f"{k}_rows")]
    aggs += [F.sum(F.when(bn == "rainbow_coin_get", F.col("amount"))).alias("get_coin"),
             F.sum(F.when(bn == "rainbow_coin_cost", F.col("amount"))).alias("cost_coin")]
    return valid_ids(farm).groupBy("space_id", "user_id", "item_id").agg(*aggs)


def entries(k: str) -> Column:
    """The sorted set of one kind's ``{item_id, count}`` entries; null when
    the kind does not occur."""
    e = F.when(F.col(f"{k}_rows") > 0,
               F.struct(F.col("item_id").cast("int").alias("item_id"), F.col(f"{k}_n").alias("count")))
    arr = F.sort_array(F.collect_set(e))
    return F.when(F.size(arr) > 0, arr).alias(k)


def farm_activity(farm: DataFrame, with_cost_coin: bool = False) -> DataFrame:
    """``space_id, user_id, coin_op, feed_op, plant_op, produce_op,
    materials_op`` (+ ``cost_coin``), kinds as sorted arrays of
    ``struct(item_id int, count)``; an absent kind is null.  Users with no
    coins and no kind are dropped."""
    lvl1 = per_item(farm)
    lvl2 = lvl1.groupBy("space_id", "user_id").agg(
        F.coalesce(F.sum("get_coin"), F.lit(0)).alias("coin_op"),
        *[entries(k) for k in KINDS],
        F.sum("cost_coin").alias("cost_coin"))
    keep = (F.col("coin_op") != 0)
    for k in KINDS:
        keep = keep | (F.coalesce(F.size(k), F.lit(0)) > 0)
    cols = ["space_id", "user_id", "coin_op", *KINDS] + (["cost_coin"] if with_cost_coin else [])
    return lvl2.where(keep).select(*cols)


def render_entries(col: str | Column) -> Column:
    """``[{item_id, count}, ...]`` -> ``"item:count,item:count"`` text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["item_id"].cast("string"),
                                                               x["count"].cast("string"))), ",")


def farm_text_lines(activity: DataFrame) -> DataFrame:
    """One ``value`` line per user: the seven fields joined by a space
    (nulls print as ``null``), as the studied client wrote them."""
    fields = [F.col("space_id"), F.col("user_id"), F.col("coin_op")] + [render_entries(k) for k in KINDS]
    return activity.select(F.concat_ws(" ", *[F.coalesce(f.cast("string"), F.lit("null")) for f in fields])
                           .alias("value"))


def farm_activity_star(farm: DataFrame) -> DataFrame:
    """JOIN-07: distinct users left-joined with one aggregate per kind on the
    two keys.  All seven inputs come from one per-item aggregate, written once
    in buckets of the keys: the aggregates and the joins over it need no
    exchange.  Same rows as ``farm_activity``."""
    keys = ["space_id", "user_id"]
    items = write_bucketed(per_item(farm), keys)
    out = items.select(*keys).distinct().join(
        items.groupBy(*keys).agg(F.sum("get_coin").alias("coins")), keys, "left")
    for k in KINDS:
        out = out.join(items.where(F.col(f"{k}_rows") > 0).groupBy(*keys).agg(entries(k)), keys, "left")
    out = out.select(*keys, F.coalesce("coins", F.lit(0)).alias("coin_op"), *KINDS)
    some = F.col("coin_op") != 0
    for k in KINDS:
        some = some | F.col(k).isNotNull()
    return out.where(some)
