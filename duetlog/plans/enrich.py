"""IP enrichment jobs (PIPE-01..05): user lists -> region, then counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.columns import ip_to_long
from ..operators.joins import ip_range_join
from ..operators.stats import with_percent_of_total

REGION_ATTRS = ("country", "area", "province", "city")


def enrich_users(users: DataFrame, ranges: DataFrame, ip: str = "ip", user: str = "user_id",
                 text_ip: bool = False, attrs: Sequence[str] = REGION_ATTRS, **kw) -> DataFrame:
    """``(user_id, ip)`` -> ``(user_id, country, area, province, city)``.

    Every input row gives exactly one output row (null region when no range
    holds the address); the studied job's self-join on ``(ip, user_id)``
    turned k equal rows into k*k, which is not reproduced.
    """
    ip_col = ip_to_long(F.col(ip)) if text_ip else F.col(ip).cast("bigint")
    fact = users.select(F.col(user).alias("user_id"), ip_col.alias("_ipnum"))
    dim = ranges.select("lo", "hi", *attrs)
    return ip_range_join(fact, dim, "_ipnum", **kw).drop("_ipnum")


def ip_region_string(users: DataFrame, ranges: DataFrame, ip: str = "ip_addr", sep: str = "|",
                     attrs: Sequence[str] = ("country", "area", "province", "city", "isp")) -> DataFrame:
    """The region lookup as one ``country|area|province|city|isp`` string per
    input row; null address or no match -> null."""
    fact = users.withColumn("_ipnum", ip_to_long(F.col(ip)))
    dim = ranges.select("lo", "hi", F.concat_ws(sep, *[F.col(a) for a in attrs]).alias("region"))
    return ip_range_join(fact, dim, "_ipnum").drop("_ipnum")


def city_active_new(active: DataFrame, new: DataFrame, region: str = "city",
                    unknown: str = K.UNKNOWN_REGION) -> DataFrame:
    """Distinct active and new users per city, inner-joined, largest first.

    The studied job de-duplicates whole rows before ``count(distinct)``;
    a distinct count cannot change under row de-duplication, so that extra
    shuffle is left out."""
    def per_city(df, name):
        return (df.where(F.col(region) != unknown).groupBy(region)
                  .agg(F.countDistinct("user_id").alias(name)))
    return (per_city(active, "act_number").join(per_city(new, "new_number"), region)
            .orderBy(F.desc("act_number"), F.desc("new_number"), F.asc(region)))


def province_share(enriched: DataFrame, unknown: str = K.UNKNOWN_REGION) -> DataFrame:
    """Distinct users per (country, province) and the percent of the country."""
    counts = (enriched.where(F.col("province") != unknown)
                      .groupBy("country", "province")
                      .agg(F.countDistinct("user_id").alias("act_number")))
    return (with_percent_of_total(counts, "act_number", ["country"], "province_percent")
                  .orderBy(F.asc("country"), F.desc("province_percent"), F.asc("province")))
