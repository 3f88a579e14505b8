"""Farm activity queries (PIPE-18, JOIN-07, AGG-13/14, FLT-11, SNK-04 form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import farm as P
from ..session import staging_path
from ..sinks.writers import write_text
from ..sources.readers import read_text_lines
from .registry import query

def _entries(kind: str) -> str:
    """A kind's distinct ``item:count`` entries in order, as text."""
    return (f"array_to_string(list_transform(list_sort(list_distinct(list({{'i': CAST(floor(item_id) AS INT), 'n': {kind}}}) "
            f"FILTER (WHERE {kind} IS NOT NULL))), lambda e: CAST(e.i AS VARCHAR) || ':' || CAST(e.n AS VARCHAR)), ',') AS {kind}_op")


_FARM_SQL = f"""
WITH per_item AS (
  SELECT space_id, user_id, item_id, sum(amount) FILTER (WHERE bn = 'rainbow_coin_get') AS coins,
    sum(number) FILTER (WHERE behavior_type = 'feed') AS feed, sum(number) FILTER (WHERE behavior_type = 'plant') AS plant,
    nullif(count(*) FILTER (WHERE behavior_type = 'produce'), 0) AS produce,
    sum(number) FILTER (WHERE bn = 'building_materials_get') AS materials
  FROM farm WHERE coalesce(space_id, 0) <> 0 AND coalesce(user_id, 0) <> 0 GROUP BY ALL),
per_user AS (
  SELECT space_id, user_id, coalesce(sum(coins), 0) AS coin_op, {_entries('feed')}, {_entries('plant')}, {_entries('produce')},
    {_entries('materials')} FROM per_item GROUP BY space_id, user_id)
SELECT * FROM per_user WHERE coin_op <> 0 OR coalesce(feed_op, plant_op, produce_op, materials_op) IS NOT NULL"""


def _rendered(t):
    act = P.farm_activity(t["farm"])
    return act.select("space_id", "user_id", "coin_op", *[P.render_entries(k).alias(k) for k in P.KINDS])


@query("pipe_farm_activity", sql=_FARM_SQL, fixtures=("farm",))
def pipe_farm_activity(t):
    """PIPE-18: coins, feed, plant, produce and materials per user; the
    per-item sets are rendered ``item:count,...`` for a flat compare."""
    return _rendered(t)


@query("join_left_star", sql=_FARM_SQL, fixtures=("farm",))
def join_left_star(t):
    """JOIN-07: left-join star of the distinct keys with an aggregate per
    kind on the composite key."""
    act = P.farm_activity_star(t["farm"])
    return act.select("space_id", "user_id", "coin_op", *[P.render_entries(k).alias(k) for k in P.KINDS])


@query("agg_two_level_set", sql=f"""
SELECT space_id, user_id, {_entries('feed')} FROM (SELECT space_id, user_id, item_id, sum(number) AS feed FROM farm
  WHERE behavior_type = 'feed' GROUP BY ALL) GROUP BY space_id, user_id""", fixtures=("farm",))
def agg_two_level_set(t):
    """AGG-13: per item, then per user, a sorted set of {item_id, count}."""
    lvl1 = (t["farm"].where(F.col("behavior_type") == "feed").groupBy("space_id", "user_id", "item_id")
            .agg(F.sum("number").alias("count")))
    lvl2 = lvl1.groupBy("space_id", "user_id").agg(
        F.sort_array(F.collect_set(F.struct(F.col("item_id").cast("int").alias("item_id"), "count"))).alias("feed_op"))
    return lvl2.select("space_id", "user_id", P.render_entries("feed_op").alias("feed_op"))


@query("agg_sum_one", sql="""
SELECT space_id, item_id, CAST(sum(1) AS BIGINT) AS produce_rows FROM farm WHERE behavior_type = 'produce' GROUP BY ALL""",
       fixtures=("farm",))
def agg_sum_one(t):
    """AGG-14: ``sum(1)`` as a row count."""
    return (t["farm"].where(F.col("behavior_type") == "produce").groupBy("space_id", "item_id")
            .agg(F.sum(F.lit(1)).alias("produce_rows")))


@query("snk_text_farm", sql=f"""
SELECT CAST(space_id AS VARCHAR) || ' ' || CAST(user_id AS VARCHAR) || ' ' || CAST(coin_op AS VARCHAR) || ' ' ||
  coalesce(feed_op, 'null') || ' ' || coalesce(plant_op, 'null') || ' ' || coalesce(produce_op, 'null') || ' ' ||
  coalesce(materials_op, 'null') AS value FROM ({_FARM_SQL.strip()})""", fixtures=("farm",))
def snk_text_farm(t):
    """SNK-04: the activity rows written as space-joined text lines, read
    back."""
    path = staging_path(t.spark, "farm_text")
    write_text(P.farm_text_lines(P.farm_activity(t["farm"])), path)
    return read_text_lines(t.spark, path)
