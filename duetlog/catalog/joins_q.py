"""Join and IP-enrichment queries (JOIN-*, PIPE-01..05, UDF-09)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import explode_ranges, ip_range_join, left_anti, measured_bytes
from ..operators.prefixes import bits_of_long, prefix_join
from ..plans import enrich
from ..session import staging_path
from ..sinks.writers import write_bucketed, write_csv
from ..sources.readers import read_json, read_user_ip_csv
from .registry import query

_ENRICH_DUCK = """
SELECT u.user_id, r.country, r.area, r.province, r.city
FROM user_ip u LEFT JOIN ip_ranges r ON u.ip BETWEEN r.lo AND r.hi"""


@query("join_ip_range", sql=_ENRICH_DUCK, fixtures=("user_ip", "ip_ranges"))
def join_ip_range(t):
    """JOIN-01 / UDF-11: prefix-bucket equi-join, the measured dimension
    broadcast."""
    return enrich.enrich_users(t["user_ip"], t["ip_ranges"])


@query("join_ip_range_bucketed", sql=_ENRICH_DUCK, fixtures=("user_ip", "ip_ranges"))
def join_ip_range_bucketed(t):
    """JOIN-01: the form for a dimension too large to broadcast: shuffled on
    the salted prefix bucket."""
    return enrich.enrich_users(t["user_ip"], t["ip_ranges"], max_broadcast_bytes=0)


@query("join_ip_nested", sql="""
WITH h AS (SELECT DISTINCT u.ip, r.place, r.hi - r.lo AS width, r.lo FROM user_ip u JOIN ip_nested r ON u.ip BETWEEN r.lo AND r.hi),
b AS (SELECT ip, place FROM (SELECT *, row_number() OVER (PARTITION BY ip ORDER BY width, lo, place) AS n FROM h) WHERE n = 1)
SELECT u.user_id, u.ip, b.place FROM user_ip u LEFT JOIN b USING (ip)""", fixtures=("user_ip", "ip_nested"))
def join_ip_nested(t):
    """JOIN-01 / UDF-11: nested ranges, the innermost one wins: dyadic
    prefixes and the longest match."""
    return prefix_join(t["user_ip"], t["ip_nested"], bits_of_long(F.col("ip")))


@query("join_broadcast_dim", sql="""
SELECT u.user_id, u.ip, r.country FROM user_ip u JOIN ip_ranges r ON u.ip BETWEEN r.lo AND r.hi""",
       fixtures=("user_ip", "ip_ranges"))
def join_broadcast_dim(t):
    """JOIN-02: inner lookup against the broadcast (size-checked) dimension."""
    return ip_range_join(t["user_ip"], t["ip_ranges"].select("lo", "hi", "country"), "ip", how="inner")


@query("join_left_two_keys", sql="""
SELECT u.user_id, u.ip, e.country FROM user_ip u
LEFT JOIN (SELECT u2.user_id, u2.ip, r.country FROM user_ip u2 JOIN ip_ranges r ON u2.ip BETWEEN r.lo AND r.hi) e
  ON u.ip = e.ip AND u.user_id = e.user_id""", fixtures=("user_ip", "ip_ranges"))
def join_left_two_keys(t):
    """JOIN-03: left equi-join on two keys attaching a region back."""
    u = t["user_ip"]
    matched = ip_range_join(u, t["ip_ranges"].select("lo", "hi", "country"), "ip", how="inner")
    return u.join(matched, ["ip", "user_id"], "left").select("user_id", "ip", "country")


@query("join_left_bucketed", sql="""
SELECT u.user_id, u.ip, e.country FROM user_ip u
LEFT JOIN (SELECT u2.user_id, u2.ip, r.country FROM user_ip u2 JOIN ip_ranges r ON u2.ip BETWEEN r.lo AND r.hi) e
  ON u.ip = e.ip AND u.user_id = e.user_id""", fixtures=("user_ip", "ip_ranges"))
def join_left_bucketed(t):
    """JOIN-03: the two-key left join over tables kept in buckets of both
    keys: no exchange on either side."""
    matched = ip_range_join(t["user_ip"], t["ip_ranges"].select("lo", "hi", "country"), "ip", how="inner")
    left, right = write_bucketed(t["user_ip"], ["ip", "user_id"]), write_bucketed(matched, ["ip", "user_id"])
    return left.join(right, ["ip", "user_id"], "left").select("user_id", "ip", "country")


@query("join_inner_using", sql="""
WITH e AS (SELECT u.user_id, r.city FROM user_ip u JOIN ip_ranges r ON u.ip BETWEEN r.lo AND r.hi),
a AS (SELECT city, CAST(count(*) AS BIGINT) AS users FROM e GROUP BY city),
b AS (SELECT city, CAST(count(DISTINCT user_id % 10) AS BIGINT) AS digits FROM e GROUP BY city)
SELECT a.city, a.users, b.digits FROM a JOIN b USING (city)""", fixtures=("user_ip", "ip_ranges"))
def join_inner_using(t):
    """JOIN-04: inner ``USING`` join of two per-city aggregates."""
    e = ip_range_join(t["user_ip"], t["ip_ranges"].select("lo", "hi", "city"), "ip", how="inner")
    a = e.groupBy("city").agg(F.count(F.lit(1)).alias("users"))
    b = e.groupBy("city").agg(F.countDistinct(F.col("user_id") % 10).alias("digits"))
    return a.join(b, "city")


@query("join_inner_notnull", sql="""
SELECT p.user_id, p.price, l.platform FROM
 (SELECT user_id, sum(price) AS price FROM orders_paid WHERE pay_date IS NOT NULL GROUP BY user_id) p
 JOIN (SELECT DISTINCT user_id, platform FROM login_os_plat) l ON p.user_id = l.user_id
WHERE p.user_id IS NOT NULL""", fixtures=("orders_paid", "login_os_plat"))
def join_inner_notnull(t):
    """JOIN-08: inner join, then the (redundant) not-null test on the key."""
    paid = (t["orders_paid"].where(F.col("pay_date").isNotNull()).groupBy("user_id")
            .agg(F.sum("price").alias("price")))
    plat = t["login_os_plat"].select("user_id", "platform").dropDuplicates()
    return (plat.join(paid, "user_id").where(paid["user_id"].isNotNull())
                .select("user_id", "price", "platform"))


@query("join_left_anti", sql="""
WITH d AS (SELECT CAST(ts AS DATE) AS day, sv, url, err_code, CAST(count(*) AS BIGINT) AS n FROM error_log GROUP BY ALL)
SELECT CAST(s.day AS VARCHAR) AS day, s.sv, s.url, s.err_code, s.n FROM d s
WHERE NOT EXISTS (SELECT 1 FROM d b WHERE b.day = s.day + 1 AND b.url = s.url AND b.err_code = s.err_code)""", fixtures=("error_log",))
def join_left_anti(t):
    """JOIN-06 / STR-07: every day's state keys absent from the next day's
    batch, on ``(url, err_code)``; a null key never matches so it is always
    absent (and so is every key after the last day)."""
    d = t["error_log"].groupBy(F.to_date("ts").alias("day"), "sv", "url", "err_code").agg(F.count(F.lit(1)).alias("n"))
    state = d.withColumn("next", F.date_add("day", 1))
    batch = d.select(F.col("day").alias("next"), "url", "err_code")
    return left_anti(state, batch, ["next", "url", "err_code"]).select(
        F.col("day").cast("string").alias("day"), "sv", "url", "err_code", "n")


@query("pipe_ip_enrich_csv", sql="""
SELECT CAST(u.user_id AS VARCHAR) AS user_id, r.country, r.area, r.province, r.city
FROM user_ip_text u LEFT JOIN ip_ranges r ON
  (CAST(split_part(u.ip_addr, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(u.ip_addr, '.', 2) AS BIGINT) * 65536
   + CAST(split_part(u.ip_addr, '.', 3) AS BIGINT) * 256 + CAST(split_part(u.ip_addr, '.', 4) AS BIGINT)) BETWEEN r.lo AND r.hi""",
       fixtures=("user_ip_text", "ip_ranges"))
def pipe_ip_enrich_csv(t):
    """PIPE-01: ``user_id,ip`` rows of a CSV file (string id, dotted
    address), staged, read and enriched."""
    p = staging_path(t.spark, "enrich_csv")
    write_csv(t["user_ip_text"].select("user_id", "ip_addr"), p, header=False)
    return enrich.enrich_users(read_user_ip_csv(t.spark, p), t["ip_ranges"], ip="ip_num")


@query("pipe_ip_enrich_json", sql="""
SELECT u.user_id, r.country, r.area, r.province, r.city
FROM user_ip_text u LEFT JOIN ip_ranges r ON
  (CAST(split_part(u.ip_addr, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(u.ip_addr, '.', 2) AS BIGINT) * 65536
   + CAST(split_part(u.ip_addr, '.', 3) AS BIGINT) * 256 + CAST(split_part(u.ip_addr, '.', 4) AS BIGINT)) BETWEEN r.lo AND r.hi""",
       fixtures=("user_ip_text", "ip_ranges"))
def pipe_ip_enrich_json(t):
    """PIPE-02: ``(ip_addr, user_id)`` records of a JSON file, numeric user
    id, staged, read and enriched."""
    p = staging_path(t.spark, "enrich_json")
    t["user_ip_text"].write.json(p)
    return enrich.enrich_users(read_json(t.spark, p, "ip_addr STRING, user_id BIGINT"), t["ip_ranges"], ip="ip_addr", text_ip=True)


@query("udf_ip_region_string", sql="""
SELECT u.user_id, u.ip_addr, r.country || '|' || r.area || '|' || r.province || '|' || r.city || '|' || r.isp AS region
FROM user_ip_text u LEFT JOIN ip_ranges r ON
  (CAST(split_part(u.ip_addr, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(u.ip_addr, '.', 2) AS BIGINT) * 65536
   + CAST(split_part(u.ip_addr, '.', 3) AS BIGINT) * 256 + CAST(split_part(u.ip_addr, '.', 4) AS BIGINT)) BETWEEN r.lo AND r.hi""",
       fixtures=("user_ip_text", "ip_ranges"))
def udf_ip_region_string(t):
    """UDF-09: the region lookup as one pipe-joined string (a join, not a
    per-row database call)."""
    return enrich.ip_region_string(t["user_ip_text"], t["ip_ranges"])


_CITY_DUCK = """
WITH ea AS (SELECT u.user_id, r.city FROM user_ip_text u LEFT JOIN ip_ranges r ON
  (CAST(split_part(u.ip_addr, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(u.ip_addr, '.', 2) AS BIGINT) * 65536
   + CAST(split_part(u.ip_addr, '.', 3) AS BIGINT) * 256 + CAST(split_part(u.ip_addr, '.', 4) AS BIGINT)) BETWEEN r.lo AND r.hi),
en AS (SELECT u.user_id, r.city FROM new_user_ip_text u LEFT JOIN ip_ranges r ON
  (CAST(split_part(u.ip_addr, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(u.ip_addr, '.', 2) AS BIGINT) * 65536
   + CAST(split_part(u.ip_addr, '.', 3) AS BIGINT) * 256 + CAST(split_part(u.ip_addr, '.', 4) AS BIGINT)) BETWEEN r.lo AND r.hi),
a AS (SELECT city, count(DISTINCT user_id) AS act_number FROM ea WHERE city != '0' GROUP BY city),
n AS (SELECT city, count(DISTINCT user_id) AS new_number FROM en WHERE city != '0' GROUP BY city)
SELECT a.city, a.act_number, n.new_number FROM a JOIN n USING (city)"""


@query("pipe_city_active_new", sql=_CITY_DUCK, fixtures=("user_ip_text", "new_user_ip_text", "ip_ranges"))
def pipe_city_active_new(t):
    """PIPE-03: weekly active and new users per city."""
    r = t["ip_ranges"]
    size = measured_bytes(explode_ranges(r.select("lo", "hi", *enrich.REGION_ATTRS)))      # one check for both lists
    active = enrich.enrich_users(t["user_ip_text"], r, ip="ip_addr", text_ip=True, dim_bytes=size)
    new = enrich.enrich_users(t["new_user_ip_text"], r, ip="ip_addr", text_ip=True, dim_bytes=size)
    return enrich.city_active_new(active, new)


@query("pipe_province_share", sql="""
WITH e AS (SELECT u.user_id, r.country, r.province FROM user_ip_text u LEFT JOIN ip_ranges r ON
  (CAST(split_part(u.ip_addr, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(u.ip_addr, '.', 2) AS BIGINT) * 65536
   + CAST(split_part(u.ip_addr, '.', 3) AS BIGINT) * 256 + CAST(split_part(u.ip_addr, '.', 4) AS BIGINT)) BETWEEN r.lo AND r.hi),
c AS (SELECT country, province, count(DISTINCT user_id) AS act_number FROM e WHERE province != '0' GROUP BY country, province)
SELECT country, province, act_number, act_number / sum(act_number) OVER (PARTITION BY country) * 100 AS province_percent FROM c""",
       fixtures=("user_ip_text", "ip_ranges"))
def pipe_province_share(t):
    """PIPE-05: province share of distinct users per country."""
    e = enrich.enrich_users(t["user_ip_text"], t["ip_ranges"], ip="ip_addr", text_ip=True)
    return enrich.province_share(e)
