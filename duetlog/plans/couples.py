"""Couple-profile statistics (PIPE-06..13).

Input: one row per couple space with partner A and partner B columns
(``a_*`` / ``b_*``), enriched with a region per partner address.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..operators.joins import enrich_sides
from ..operators.stats import topk_per_group, upper_median

PARTNER_FIELDS = ("province", "city", "country", "birthday", "regist_time", "last_use_time")


def enrich_couples(couple: DataFrame, ranges: DataFrame, **kw) -> DataFrame:
    """Add ``a_country/a_province/a_city`` and the ``b_*`` twins by looking
    up both partner addresses in the range table."""
    return enrich_sides(couple, ranges, {"a": "a_ip", "b": "b_ip"},
                        attrs=("country", "province", "city"), **kw)


def partner_rows(couple: DataFrame, fields: Sequence[str] = PARTNER_FIELDS,
                 keep: Sequence[str] = ("space_id", "registe_space_dt", "anniversary_day")) -> DataFrame:
    """One row per person: ``stack`` the A and B columns in a single scan
    (the studied jobs scan twice and union)."""
    a = ", ".join(f"a_{f}" for f in fields)
    b = ", ".join(f"b_{f}" for f in fields)
    names = ", ".join(fields)
    return couple.select(*keep, F.expr(f"stack(2, 'a', {a}, 'b', {b}) AS (side, {names})"))


def person_features(people: DataFrame, as_of: str = K.REFERENCE_AS_OF) -> DataFrame:
    """``since_days``, ``love_days``, ``last_active_days``, ``user_type``,
    ``love_days_type`` and ``age`` of each person row."""
    since = C.days_since(as_of, "regist_time")
    love = C.days_between("registe_space_dt", "anniversary_day")
    last = C.days_since(as_of, "last_use_time")
    return people.withColumns({
        "since_days": since, "love_days": love, "last_active_days": last,
        "user_type": C.user_type(since, last), "love_days_type": C.love_days_type(love),
        "age": C.age_at(F.col("birthday"), as_of)})


# --- PIPE-06 ----------------------------------------------------------------------

def cohort_stats(profile: DataFrame, step: int, dedup: bool = True,
                 max_days: int = K.LOVE_DAYS_MAX) -> DataFrame:
    """Per love-days bucket of width ``step``: retention %, pay rate, ARPU,
    upper median of paid cost, ARPPU, sample std-dev of paid cost, sample size.

    The studied job self-joins a paid and an all-rows aggregate and takes the
    median from a collected, sorted list.  Here the de-duplicated rows (the
    only full shuffle, computed once and reused) feed two aggregations: the
    bucket totals with filtered aggregates, and the exact upper median
    (``upper_median``: only the values between two quantiles next to the middle
    are ranked, so a hot love-days bucket is not sorted in one task).  No bucket
    is ever gathered as a list.  A bucket without payers gets null pay rate /
    median / ARPPU / std-dev, as the left join gave.
    """
    base = profile.dropDuplicates() if dedup else profile
    x = (base.select("space_id", "a_retention", "b_retention", "total_cost",
                     F.datediff("registe_space_dt", "anniversary_day").alias("love_days"),
                     "anniversary_day")
             .where(F.col("love_days").isNotNull() & (F.col("love_days") >= 0)
                    & (F.col("love_days") <= max_days) & F.col("anniversary_day").isNotNull())
             .withColumn("love_days", C.bucket_floor("love_days", step))
             # stated explicitly so the joins below cannot add it to one branch
             # only (inferred filters would make the de-dup subtrees differ)
             .where(F.col("love_days").isNotNull()))
    cost = F.col("total_cost")
    paid = cost != 0                                   # null cost: neither paid nor counted
    med = upper_median(x, ["love_days"], "total_cost", "median_paid_cost", where=paid)
    agg = x.groupBy("love_days").agg(
        F.count("space_id").alias("space_cnt"),
        F.sum("total_cost").alias("cost"),
        (F.sum("a_retention") + F.sum("b_retention")).alias("retention"),
        F.count(F.when(paid, F.col("space_id"))).alias("paid_cnt"),
        F.sum(F.when(paid, cost)).alias("paid_cost"),
        F.stddev_samp(F.when(paid, cost)).alias("std_paid_cost"))
    paid_cnt = F.nullif(F.col("paid_cnt"), F.lit(0))
    return (agg.join(med, "love_days", "left")
               .select("love_days",
                       (F.col("retention") / (F.col("space_cnt") * 2) * 100).alias("retention_rate"),
                       (paid_cnt / F.col("space_cnt")).alias("pay_rate"),
                       (F.col("cost") / (F.col("space_cnt") * 2)).alias("arpu"),
                       "median_paid_cost",
                       (F.col("paid_cost") / (paid_cnt * 2)).alias("arppu"),
                       "std_paid_cost",
                       "space_cnt")
               .orderBy("love_days"))


def titled(df: DataFrame, titles: Mapping[str, str] = K.COHORT_TITLES) -> DataFrame:
    """Presentation aliases (e.g. the Chinese report titles)."""
    return df.select(*[F.col(c).alias(titles.get(c, c)) for c in df.columns])


# --- PIPE-07 / PIPE-08 --------------------------------------------------------------

def top_provinces(couple_enriched: DataFrame, by: str = "user_type", k: int = K.TOP_K,
                  as_of: str = K.REFERENCE_AS_OF, unknown: str = K.UNKNOWN_REGION) -> DataFrame:
    """Top-``k`` provinces (rank, ties kept) per user type or per love-days
    type, with the percent of the group total."""
    people = person_features(partner_rows(couple_enriched, ("province", "regist_time", "last_use_time", "birthday")),
                             as_of)
    people = people.where(F.col("province") != unknown)
    if by == "user_type":
        people = people.where(F.col("user_type") != K.NEITHER_USER_TYPE)
    elif by == "love_days_type":
        people = people.where(F.col("love_days").isNotNull() & (F.col("love_days") >= 0))
    else:
        raise ValueError(by)
    counts = people.groupBy(by, "province").agg(F.count("space_id").alias("nums"))
    return topk_per_group(counts, [by], "nums", k)


def top_provinces_both(couple_enriched: DataFrame, k: int = K.TOP_K, as_of: str = K.REFERENCE_AS_OF,
                       unknown: str = K.UNKNOWN_REGION) -> DataFrame:
    """PIPE-07 and PIPE-08 in one pass: the person rows are built once and
    counted with ``GROUPING SETS ((user_type, province), (love_days_type,
    province))`` - one scan and one shuffle instead of two jobs over the
    same union.  ``report`` says which ranking a row belongs to and ``type``
    holds the user type or the love-days type."""
    people = person_features(partner_rows(couple_enriched, ("province", "regist_time", "last_use_time", "birthday")),
                             as_of).where(F.col("province") != unknown)
    ut = F.when(F.col("user_type") != K.NEITHER_USER_TYPE, F.col("user_type"))
    lt = F.when(F.col("love_days").isNotNull() & (F.col("love_days") >= 0), F.col("love_days_type"))
    g = (people.select("space_id", "province", ut.alias("ut"), lt.alias("lt"))
               .groupingSets([["ut", "province"], ["lt", "province"]], "ut", "lt", "province")
               .agg(F.count("space_id").alias("nums"), F.grouping_id().alias("_g")))
    by_user = F.col("_g") == 2                       # bits (ut, lt, province): lt aggregated away
    rows = (g.select(F.when(by_user, F.lit("user_type")).otherwise(F.lit("love_days_type")).alias("report"),
                     F.when(by_user, F.col("ut")).otherwise(F.col("lt")).alias("type"), "province", "nums")
             .where(F.col("type").isNotNull()))
    return topk_per_group(rows, ["report", "type"], "nums", k)


# --- PIPE-09 / PIPE-10 --------------------------------------------------------------

def country_spend(couple_enriched: DataFrame, home: str = K.HOME_COUNTRY,
                  partners: Mapping[str, str] = K.COUNTRY_PAIR_LABELS,
                  active_within: int | None = None, as_of: str = K.REFERENCE_AS_OF,
                  unknown: str = K.UNKNOWN_REGION) -> DataFrame:
    """Spend by country pair; with ``active_within`` only couples where a
    partner was active within that many days of ``as_of``."""
    df = couple_enriched.where((F.col("a_country") != unknown) & (F.col("b_country") != unknown))
    if active_within is not None:
        df = df.where((C.days_since(as_of, "a_last_use_time") <= active_within)
                      | (C.days_since(as_of, "b_last_use_time") <= active_within))
    return (df.withColumn("country_type", C.country_pair_type("a_country", "b_country", home, partners))
              .groupBy("country_type")
              .agg(F.count("space_id").alias("space_num"), F.sum("total_cost").alias("total_cost"))
              .select("country_type", "space_num", (F.col("space_num") * 2).alias("user_num"),
                      (F.col("total_cost") / (F.col("space_num") * 2)).alias("avg_cost")))


# --- PIPE-11 / PIPE-12 --------------------------------------------------------------

def _valid_people(couple_enriched: DataFrame, provinces: Sequence[str], as_of: str) -> DataFrame:
    people = person_features(partner_rows(couple_enriched), as_of)
    return people.where(F.col("province").isin(list(provinces))
                        & (F.col("user_type") != "null") & (F.col("user_type") != K.NEITHER_USER_TYPE))


def city_share(couple_enriched: DataFrame, provinces: Sequence[str],
               as_of: str = K.REFERENCE_AS_OF) -> DataFrame:
    """Users per city as a percent of their province, per user type."""
    counts = (_valid_people(couple_enriched, provinces, as_of)
              .groupBy("user_type", "province", "city").agg(F.count("city").alias("city_user_num")))
    w = Window.partitionBy("user_type", "province")
    return (counts.withColumn("city_province_percent", F.col("city_user_num") / F.sum("city_user_num").over(w) * 100)
                  .orderBy(F.asc("user_type"), F.asc("province"), F.desc("city_province_percent"), F.asc("city")))


def avg_age(couple_enriched: DataFrame, provinces: Sequence[str], as_of: str = K.REFERENCE_AS_OF) -> DataFrame:
    """Average age per (user type, province) and per user type, in one
    aggregation with grouping sets (``province`` null on the per-type rows)."""
    people = _valid_people(couple_enriched, provinces, as_of).where(F.col("age") != -1)
    return (people.rollup("user_type", "province")
                  .agg(F.avg("age").alias("avg_age"), F.grouping_id().alias("_g"))
                  .where(F.col("_g") < 3).drop("_g"))


# --- PIPE-13 ------------------------------------------------------------------------

def cross_country_list(couple_enriched: DataFrame, max_since_days: int = 1000,
                       as_of: str = K.REFERENCE_AS_OF) -> DataFrame:
    """Couples in different countries that opened their space within
    ``max_since_days`` of ``as_of``: a detail list."""
    return (couple_enriched
            .select("space_id", "a_gender", "b_gender", "a_birthday", "b_birthday",
                    C.days_since(as_of, "registe_space_dt").alias("since_days"), "total_cost",
                    "a_country", "a_province", "a_city", "b_country", "b_province", "b_city")
            .withColumn("a_age", C.age_at(F.col("a_birthday"), as_of))
            .withColumn("b_age", C.age_at(F.col("b_birthday"), as_of))
            .withColumn("country_type", C.same_country_type("a_country", "b_country"))
            .where((F.col("country_type") == K.DIFFERENT_COUNTRY) & (F.col("since_days") <= max_since_days)))
