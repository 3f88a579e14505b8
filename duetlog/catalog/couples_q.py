"""Couple-profile queries (PIPE-06..13, AGG-10..17, PRJ-06/08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import couples as P
from ..plans.fixtures import COUPLE_AS_OF
from ..operators.stats import upper_median
from ..functions import columns as C
from .. import constants as K
from .registry import query

AS_OF = COUPLE_AS_OF
# parameters fitted to the fixture's regions (the library defaults are the
# studied jobs' own country names and provinces)
HOME = "ASIA"
PARTNERS = {"AMERICA": "ASIA-AMERICA", "EUROPE": "ASIA-EUROPE", "AFRICA": "ASIA-AFRICA",
            "MIDDLE EAST": "ASIA-MIDDLE EAST"}
PROVINCES = ("NATION_1", "NATION_2", "NATION_7", "NATION_12")

_Y, _M, _D = (int(x) for x in AS_OF.split("-"))
_AGE = f"""CASE WHEN birthday = 'NULL' THEN -1 ELSE CAST({_Y} - TRY_CAST(split_part(birthday, '-', 1) AS INT)
  - (CASE WHEN {_M} < TRY_CAST(split_part(birthday, '-', 2) AS INT) THEN 1
          WHEN {_D} < TRY_CAST(split_part(birthday, '-', 3) AS INT) AND TRY_CAST(split_part(birthday, '-', 2) AS INT) = {_M} THEN 1
          ELSE 0 END) AS INT) END"""

_SIDE = ("SELECT space_id, registe_space_dt, anniversary_day, '{s}' AS side, {s}_province AS province, {s}_city AS city, "
         "{s}_country AS country, {s}_birthday AS birthday, {s}_regist_time AS regist_time, "
         "{s}_last_use_time AS last_use_time FROM couple_enriched")

PEOPLE = {
    "people": _SIDE.format(s="a") + " UNION ALL " + _SIDE.format(s="b"),
    "feat0": f"""SELECT *,
  CAST(date_diff('day', TRY_CAST(regist_time AS DATE), DATE '{AS_OF}') AS INT) AS since_days,
  CAST(date_diff('day', anniversary_day, registe_space_dt) AS INT) AS love_days,
  CAST(date_diff('day', CAST(TRY_CAST(last_use_time AS TIMESTAMP) AS DATE), DATE '{AS_OF}') AS INT) AS last_active_days
FROM people""",
    "feat": f"""SELECT *,
  CASE WHEN since_days IS NULL OR last_active_days IS NULL THEN NULL WHEN since_days <= 365 THEN 'new'
       WHEN last_active_days <= 365 THEN 'old' ELSE '0' END AS user_type,
  CASE WHEN love_days IS NULL THEN NULL WHEN love_days <= 30 THEN '30days-' ELSE '30days+' END AS love_days_type,
  {_AGE} AS age
FROM feat0""",
}


def _cohort_sql(step: int) -> str:
    return f"""
WITH x AS (SELECT space_id, a_retention, b_retention, total_cost, anniversary_day,
             CAST(date_diff('day', anniversary_day, registe_space_dt) AS INT) AS ld FROM (SELECT DISTINCT * FROM couple)),
xb AS (SELECT *, CAST(ld - (((ld % {step}) + {step}) % {step}) AS INT) AS love_days FROM x
       WHERE ld IS NOT NULL AND ld >= 0 AND ld <= 1095 AND anniversary_day IS NOT NULL),
a AS (SELECT love_days, count(space_id) AS space_cnt, sum(total_cost) AS cost, sum(a_retention) + sum(b_retention) AS retention,
        count(CASE WHEN total_cost != 0 THEN space_id END) AS paid_cnt,
        sum(CASE WHEN total_cost != 0 THEN total_cost END) AS paid_cost,
        stddev_samp(CASE WHEN total_cost != 0 THEN total_cost END) AS std_paid_cost,
        list_sort(list(total_cost) FILTER (WHERE total_cost != 0)) AS lst
      FROM xb GROUP BY love_days)
SELECT love_days, retention / (space_cnt * 2) * 100 AS retention_rate, nullif(paid_cnt, 0) / space_cnt AS pay_rate,
  cost / (space_cnt * 2) AS arpu, lst[CAST(floor(len(lst) / 2) AS INT) + 1] AS median_paid_cost,
  paid_cost / (nullif(paid_cnt, 0) * 2) AS arppu, std_paid_cost, space_cnt FROM a"""


_COHORT_ROUND = ("retention_rate", "pay_rate", "arpu", "median_paid_cost", "arppu", "std_paid_cost")


@query("pipe_cohort_stats", sql=_cohort_sql(5), fixtures=("couple",), rounded=_COHORT_ROUND)
def pipe_cohort_stats(t):
    """PIPE-06 / JOIN-05: cohort statistics by 5-day love-days buckets."""
    return P.cohort_stats(t["couple"], 5)


@query("agg_bucketed", sql=_cohort_sql(20), fixtures=("couple",), rounded=_COHORT_ROUND)
def agg_bucketed(t):
    """AGG-17: the same statistics over 20-day buckets."""
    return P.cohort_stats(t["couple"], 20)


@query("agg_filtered_vs_all", sql="""
WITH x AS (SELECT CAST(date_diff('day', anniversary_day, registe_space_dt) AS INT) AS ld, total_cost FROM couple)
SELECT CAST(ld - (((ld % 10) + 10) % 10) AS INT) AS love_days, count(*) AS space_cnt,
  count(*) FILTER (WHERE total_cost != 0) AS paid_cnt,
  count(*) FILTER (WHERE total_cost != 0) / count(*) AS pay_rate
FROM x WHERE ld BETWEEN 0 AND 1095 GROUP BY 1""", fixtures=("couple",), rounded=("pay_rate",))
def agg_filtered_vs_all(t):
    """AGG-16: a filtered and an unfiltered count in one aggregation."""
    ld = F.datediff("registe_space_dt", "anniversary_day")
    x = t["couple"].select(ld.alias("ld"), "total_cost").where(F.col("ld").between(0, 1095))
    return (x.groupBy(C.bucket_floor("ld", 10).alias("love_days"))
             .agg(F.count(F.lit(1)).alias("space_cnt"), F.count_if(F.col("total_cost") != 0).alias("paid_cnt"))
             .withColumn("pay_rate", F.col("paid_cnt") / F.col("space_cnt")))


@query("agg_upper_median", sql="""
SELECT o_orderpriority, (list_sort(list(o_totalprice)))[CAST(floor(count(o_totalprice) / 2) AS INT) + 1] AS median_price
FROM orders GROUP BY o_orderpriority""", rounded=("median_price",))
def agg_upper_median(t):
    """AGG-12: upper median (element n div 2 + 1 of the sorted values)."""
    return upper_median(t["orders"], ["o_orderpriority"], "o_totalprice", out="median_price")


@query("agg_sorted_list", sql="""
SELECT c_nationkey, c_mktsegment, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS pos FROM customer""")
def agg_sorted_list(t):
    """AGG-11: the sorted list of values per group, in long form
    ``(group, value, position)`` - the studied ``sort_array(collect_list(x))``
    without gathering a group into one array or one task."""
    from ..operators.windows import row_number_within
    c = t["customer"].select("c_nationkey", "c_mktsegment")
    return row_number_within(c, ["c_nationkey"], ["c_mktsegment"], out="pos")


@query("agg_value_list", sql="""
SELECT c_nationkey, array_to_string(list_sort(list(c_mktsegment)), ',') AS segments, count(c_mktsegment) AS n FROM customer GROUP BY c_nationkey""")
def agg_value_list(t):
    """AGG-11: the sorted list of values per group as one list (rendered as
    text for a flat compare)."""
    from ..operators.stats import sorted_list
    lists = sorted_list(t["customer"], ["c_nationkey"], "c_mktsegment", "segments")
    return lists.select("c_nationkey", F.array_join("segments", ",").alias("segments"), F.size("segments").cast("long").alias("n"))


@query("agg_stddev", sql="""
SELECT o_orderstatus, stddev_samp(o_totalprice) AS std_price, count(*) AS n FROM orders GROUP BY o_orderstatus""",
       rounded=("std_price",))
def agg_stddev(t):
    """AGG-10: sample standard deviation (one row -> null)."""
    return (t["orders"].groupBy("o_orderstatus")
            .agg(F.stddev("o_totalprice").alias("std_price"), F.count(F.lit(1)).alias("n")))


@query("agg_derived_ratios", sql="""
SELECT CAST(date_diff('day', anniversary_day, registe_space_dt) >= 365 AS INT) AS long_love,
  (sum(a_retention) + sum(b_retention)) / (count(space_id) * 2) * 100 AS retention_rate,
  sum(total_cost) / (count(space_id) * 2) AS cost_avg, count(space_id) * 2 AS user_num
FROM couple GROUP BY 1""", fixtures=("couple",), rounded=("retention_rate", "cost_avg"))
def agg_derived_ratios(t):
    """AGG-15: arithmetic over aggregates."""
    c = t["couple"]
    return (c.groupBy((F.datediff("registe_space_dt", "anniversary_day") >= 365).cast("int").alias("long_love"))
             .agg(((F.sum("a_retention") + F.sum("b_retention")) / (F.count("space_id") * 2) * 100).alias("retention_rate"),
                  (F.sum("total_cost") / (F.count("space_id") * 2)).alias("cost_avg"),
                  (F.count("space_id") * 2).alias("user_num")))


def _top_sql(by: str, cond: str) -> str:
    return f"""
WITH c AS (SELECT {by}, province, count(space_id) AS nums FROM feat WHERE province != '0' AND {cond} GROUP BY {by}, province)
SELECT {by}, province, nums, nums / sum(nums) OVER (PARTITION BY {by}) * 100 AS percent, rk FROM
 (SELECT *, CAST(rank() OVER (PARTITION BY {by} ORDER BY nums DESC) AS INT) AS rk FROM c) WHERE rk <= 20"""


@query("pipe_top_provinces_user_type", sql=_top_sql("user_type", "user_type != '0'"),
       fixtures=("couple_enriched",), extra=PEOPLE, rounded=("percent",))
def pipe_top_provinces_user_type(t):
    """PIPE-07: top-20 provinces per user type, with percent."""
    return P.top_provinces(t["couple_enriched"], "user_type", as_of=AS_OF)


@query("pipe_top_provinces_love_days", sql=_top_sql("love_days_type", "love_days >= 0 AND love_days IS NOT NULL"),
       fixtures=("couple_enriched",), extra=PEOPLE, rounded=("percent",))
def pipe_top_provinces_love_days(t):
    """PIPE-08: top-20 provinces per love-days type."""
    return P.top_provinces(t["couple_enriched"], "love_days_type", as_of=AS_OF)


def _spend_sql(active: bool) -> str:
    pairs = " ".join(f"WHEN (a_country = '{HOME}' AND b_country = '{p}') OR (a_country = '{p}' AND b_country = '{HOME}') THEN '{l}'"
                     for p, l in PARTNERS.items())
    where = "a_country != '0' AND b_country != '0'"
    if active:
        where += (f" AND (date_diff('day', CAST(TRY_CAST(a_last_use_time AS TIMESTAMP) AS DATE), DATE '{AS_OF}') <= 365"
                  f" OR date_diff('day', CAST(TRY_CAST(b_last_use_time AS TIMESTAMP) AS DATE), DATE '{AS_OF}') <= 365)")
    return f"""
WITH x AS (SELECT CASE {pairs} ELSE 'other' END AS country_type, space_id, total_cost FROM couple_enriched WHERE {where})
SELECT country_type, count(space_id) AS space_num, count(space_id) * 2 AS user_num, sum(total_cost) / (count(space_id) * 2) AS avg_cost
FROM x GROUP BY country_type"""


@query("pipe_country_spend", sql=_spend_sql(False), fixtures=("couple_enriched",), rounded=("avg_cost",))
def pipe_country_spend(t):
    """PIPE-09: spend by country pair, all couples."""
    return P.country_spend(t["couple_enriched"], HOME, PARTNERS).drop("total_cost")


@query("pipe_country_spend_active", sql=_spend_sql(True), fixtures=("couple_enriched",), rounded=("avg_cost",))
def pipe_country_spend_active(t):
    """PIPE-10: spend by country pair, couples active within 365 days."""
    return P.country_spend(t["couple_enriched"], HOME, PARTNERS, active_within=365, as_of=AS_OF).drop("total_cost")


_PROV = ", ".join(f"'{p}'" for p in PROVINCES)
_VALID = f"province IN ({_PROV}) AND user_type != 'null' AND user_type != '0'"


@query("pipe_city_share", sql=f"""
WITH c AS (SELECT user_type, province, city, count(city) AS city_user_num FROM feat WHERE {_VALID} GROUP BY ALL)
SELECT *, city_user_num / sum(city_user_num) OVER (PARTITION BY user_type, province) * 100 AS city_province_percent FROM c""",
       fixtures=("couple_enriched",), extra=PEOPLE, rounded=("city_province_percent",))
def pipe_city_share(t):
    """PIPE-11: city share of province by user type, four provinces."""
    return P.city_share(t["couple_enriched"], PROVINCES, as_of=AS_OF)


@query("pipe_avg_age", sql=f"""
SELECT user_type, province, avg(age) AS avg_age FROM feat WHERE {_VALID} AND age != -1
GROUP BY GROUPING SETS ((user_type, province), (user_type))""",
       fixtures=("couple_enriched",), extra=PEOPLE, rounded=("avg_age",))
def pipe_avg_age(t):
    """PIPE-12: average age by (user type, province) and by user type."""
    return P.avg_age(t["couple_enriched"], PROVINCES, as_of=AS_OF)


_AGE_A = _AGE.replace("birthday", "a_birthday")
_AGE_B = _AGE.replace("birthday", "b_birthday")


@query("pipe_cross_country_list", sql=f"""
SELECT space_id, a_gender, b_gender, a_birthday, b_birthday,
  CAST(date_diff('day', registe_space_dt, DATE '{AS_OF}') AS INT) AS since_days, total_cost,
  a_country, a_province, a_city, b_country, b_province, b_city,
  {_AGE_A} AS a_age, {_AGE_B} AS b_age,
  CASE WHEN a_country IS NOT DISTINCT FROM b_country THEN '同国' ELSE '异国' END AS country_type
FROM couple_enriched
WHERE (a_country IS DISTINCT FROM b_country) AND date_diff('day', registe_space_dt, DATE '{AS_OF}') <= 1000""",
       fixtures=("couple_enriched",))
def pipe_cross_country_list(t):
    """PIPE-13: couples in different countries within 1000 days, detail."""
    return P.cross_country_list(t["couple_enriched"], 1000, as_of=AS_OF)


@query("prj_partner_unpivot", sql="""
SELECT space_id, side, province, city, country, birthday, regist_time, last_use_time FROM people""",
       fixtures=("couple_enriched",), extra={"people": PEOPLE["people"]})
def prj_partner_unpivot(t):
    """PRJ-08: partner A and B columns -> one row per person, one scan."""
    return P.partner_rows(t["couple_enriched"]).drop("registe_space_dt", "anniversary_day")


_TITLED_SQL = ("SELECT " + ", ".join(f'{c} AS "{t}"' for c, t in K.COHORT_TITLES.items())
               + " FROM (" + _cohort_sql(10).strip() + ")")


@query("prj_unicode_alias", sql=_TITLED_SQL, fixtures=("couple",),
       rounded=tuple(K.COHORT_TITLES[c] for c in _COHORT_ROUND))
def prj_unicode_alias(t):
    """PRJ-06: the cohort report with its Chinese column titles (10-day buckets)."""
    return P.titled(P.cohort_stats(t["couple"], 10))
