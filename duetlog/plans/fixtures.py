"""Inputs of the studied jobs, derived by Spark from the driver's tables.

The studied code base ships no data, so each input it expects (a user/IP
list, an IP range table, couple profiles, farm behaviour rows, error logs,
text logs ...) is derived here from the driver's Parquet tables.  Each
fixture has one SQL text for Spark (``{name}`` placeholders are bound to
DataFrames with ``spark.sql(text, **frames)``) and one for DuckDB (the oracle);
they differ only where the dialects do (epoch millis).  Work grows with the
source tables; nothing is sampled or capped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..session import table

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# As-of date used with the couple fixture (its dates lie in 1992-2003; the
# studied jobs' own fixed date 2021-04-15 is the library default).
COUPLE_AS_OF = "1999-06-30"

_SPARK_MS = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)"
_DUCK_MS = "(epoch_us(ts) // 1000)"
_DAY = "CAST(CAST(ts AS DATE) AS VARCHAR(10))"


@dataclass
class Fixture:
    sql: str                      # shared text, or Spark text when duck is set
    duck: str | None = None       # DuckDB text when it differs
    deps: tuple[str, ...] = field(default_factory=tuple)
    builder: object = None        # Spark-side builder fn(Tables) -> DataFrame

    def duck_sql(self) -> str:
        return self.duck if self.duck is not None else self.sql


def _deps(text: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def _fx(sql: str, duck: str | None = None) -> Fixture:
    return Fixture(sql=sql, duck=duck, deps=_deps(sql))


FIXTURES: dict[str, Fixture] = {}

FIXTURES["ip_ranges"] = _fx("""
SELECT CAST(n_nationkey AS BIGINT)*10000000+1 AS lo, CAST(n_nationkey AS BIGINT)*10000000+8000000 AS hi,
  r_name AS country, 'area_' || CAST(n_regionkey AS VARCHAR(10)) AS area,
  CASE WHEN n_nationkey % 5 = 4 THEN '0' ELSE n_name END AS province,
  'city_' || CAST(n_nationkey % 7 AS VARCHAR(10)) AS city,
  CASE WHEN n_nationkey % 3 = 1 THEN '"isp_1' ELSE 'isp_' || CAST(n_nationkey % 3 AS VARCHAR(10)) END AS isp
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""")

# three levels of ranges, each inside one of the level above; the innermost ones repeat
FIXTURES["ip_nested"] = _fx("""
SELECT lo, hi, 'nation ' || CAST(lo AS VARCHAR(20)) AS place FROM {ip_ranges}
UNION ALL
SELECT lo + k * 800000 AS lo, lo + k * 800000 + 500000 AS hi, 'area ' || CAST(k AS VARCHAR(2)) AS place
FROM {ip_ranges} JOIN (SELECT DISTINCT s_nationkey, CAST(s_suppkey % 10 AS BIGINT) AS k FROM {supplier}) ks
  ON lo = CAST(s_nationkey AS BIGINT) * 10000000 + 1
UNION ALL
SELECT lo + (s_suppkey % 10) * 800000 + (s_suppkey % 400) * 1000 AS lo, lo + (s_suppkey % 10) * 800000 + (s_suppkey % 400) * 1000 + 499 AS hi,
  s_name AS place
FROM {ip_ranges} JOIN {supplier} ON lo = CAST(s_nationkey AS BIGINT) * 10000000 + 1""")

FIXTURES["user_ip"] = _fx("""
SELECT c_custkey AS user_id, (c_custkey*104729+7) % 260000000 AS ip FROM {customer}""")

_DOTTED = ("CAST(CAST(FLOOR(ip/16777216) AS BIGINT) % 256 AS VARCHAR(3)) || '.' || "
           "CAST(CAST(FLOOR(ip/65536) AS BIGINT) % 256 AS VARCHAR(3)) || '.' || "
           "CAST(CAST(FLOOR(ip/256) AS BIGINT) % 256 AS VARCHAR(3)) || '.' || CAST(ip % 256 AS VARCHAR(3))")

FIXTURES["user_ip_text"] = _fx(f"SELECT user_id, {_DOTTED} AS ip_addr FROM {{user_ip}}")

# users whose account is in two market segments play the "new users" list
FIXTURES["new_user_ip_text"] = _fx("""
SELECT t.user_id, t.ip_addr FROM {user_ip_text} t JOIN {customer} c ON t.user_id = c.c_custkey
WHERE c.c_mktsegment IN ('BUILDING', 'MACHINERY')""")

FIXTURES["couple"] = _fx("""
SELECT o_orderkey AS space_id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'F' ELSE 'M' END AS a_gender,
  CASE WHEN o_orderkey % 2 = 0 THEN 'M' ELSE 'F' END AS b_gender,
  CASE WHEN o_orderkey % 11 = 0 THEN 'NULL' ELSE CAST(CAST(o_orderdate AS DATE) - CAST(7000 + o_orderkey % 9000 AS INT) AS VARCHAR(10)) END AS a_birthday,
  CASE WHEN o_orderkey % 13 = 0 THEN 'NULL' ELSE CAST(CAST(o_orderdate AS DATE) - CAST(6500 + (o_orderkey * 7) % 9000 AS INT) AS VARCHAR(10)) END AS b_birthday,
  CAST(o_orderkey % 2 AS INT) AS a_retention,
  CAST(CAST(FLOOR(o_orderkey/2) AS BIGINT) % 2 AS INT) AS b_retention,
  CAST(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 800 AS INT) AS VARCHAR(10)) AS a_regist_time,
  CAST(CAST(o_orderdate AS DATE) - CAST((o_orderkey * 3) % 800 AS INT) AS VARCHAR(10)) AS b_regist_time,
  CAST(o_orderdate AS DATE) AS registe_space_dt,
  CAST(o_orderdate AS DATE) - CAST(o_orderkey % 1300 - 50 AS INT) AS anniversary_day,
  CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_totalprice END AS DECIMAL(12,2)) AS total_cost,
  CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1000 AS INT) AS VARCHAR(10)) || ' 08:30:00' AS a_last_use_time,
  CAST(CAST(o_orderdate AS DATE) + CAST((o_orderkey * 5) % 1000 AS INT) AS VARCHAR(10)) || ' 21:15:00' AS b_last_use_time,
  (o_custkey*104729+7) % 260000000 AS a_ip, (o_custkey*224737+11) % 260000000 AS b_ip
FROM {orders}""")

FIXTURES["farm"] = _fx("""
SELECT o_custkey % 100 AS space_id, l_suppkey AS user_id, CAST(l_linenumber AS DOUBLE) * 0.5 AS item_id,
  CAST(l_quantity AS BIGINT) AS number, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
  CASE l_returnflag WHEN 'A' THEN 'feed' WHEN 'N' THEN 'plant' ELSE 'produce' END AS behavior_type,
  CASE WHEN l_orderkey % 4 = 0 THEN 'rainbow_coin_get' WHEN l_orderkey % 4 = 1 THEN 'rainbow_coin_cost'
       WHEN l_orderkey % 4 = 2 THEN 'building_materials_get' ELSE 'login' END AS bn
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""")

_ERROR_LOG = """
SELECT event_id, ts, event_type AS sv, 'api' AS bn, '/p/' || CAST(user_id % 3 AS VARCHAR(5)) AS url,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'E' || CAST(event_id % 3 AS VARCHAR(5)) END AS err_code,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'timeout' END AS err_msg,
  CAST(user_id AS VARCHAR(10)) AS ip_addr, {MS} AS ts_ms
FROM {events}"""
FIXTURES["error_log"] = _fx(_ERROR_LOG.replace("{MS}", _SPARK_MS),
                            _ERROR_LOG.replace("{MS}", _DUCK_MS))

_APP_LOG = """
SELECT CAST(user_id % 6 AS INT) AS source_no,
  CASE WHEN event_id % 19 = 0 THEN 0 WHEN user_id % 2 = 0 THEN 700000 + user_id ELSE 100000 + user_id END AS space_id,
  CASE WHEN event_id % 23 = 0 THEN 0 WHEN event_id % 29 = 0 THEN NULL ELSE user_id END AS user_id,
  CASE event_type WHEN 'signup' THEN 'login' WHEN 'view' THEN 'login' WHEN 'click' THEN 'click_trace' ELSE event_type END AS bn,
  CASE WHEN event_id % 9 = 0 THEN 'other' ELSE 'main' END AS app_name,
  {MS} AS ts_ms
FROM {events}"""
FIXTURES["app_log"] = _fx(_APP_LOG.replace("{MS}", _SPARK_MS), _APP_LOG.replace("{MS}", _DUCK_MS))

FIXTURES["space_user_list"] = _fx("""
SELECT CAST(700000 + c_custkey * 10 + c_nationkey % 10 AS BIGINT) AS space_id, c_custkey AS user_id FROM {customer}""")

FIXTURES["mic_log"] = _fx(f"""
SELECT CASE
  WHEN event_id % 50 = 0 THEN {_DAY} || ' broken line'
  WHEN event_id % 31 = 0 THEN {_DAY} || ' Microscopic_view 0 1.1.1.1 0 0'
  ELSE {_DAY} || ' INFO ' || event_type || ' 10.0.' || CAST(user_id % 8 AS VARCHAR(10)) || '.' || CAST(user_id % 250 AS VARCHAR(10))
       || ' ' || CAST(user_id AS VARCHAR(20)) || ' ' || CAST(user_id * 13 AS VARCHAR(20))
END AS value FROM {{events}}""")

FIXTURES["micro_log"] = _fx(f"""
SELECT CASE WHEN event_id % 4 = 0 THEN 'Other ' || {_DAY} || ' x'
  ELSE 'Micro_' || event_type || ' ' || {_DAY} || ' a b c d e ' || CAST(user_id * 13 AS VARCHAR(20)) || ' ' || CAST(user_id AS VARCHAR(20))
END AS value FROM {{events}}""")

FIXTURES["daily_log"] = _fx(f"""
SELECT 'app.log_' || {_DAY} AS log_name, CAST(user_id AS VARCHAR(20)) || ' ' || event_type AS value FROM {{events}}""")

# one label in four starts with a quote: delimited readers must not interpret it
_EL = "CASE WHEN user_id % 4 = 3 THEN '\"' ELSE '' END || 'el_' || CAST(user_id % 4 AS VARCHAR(10))"
FIXTURES["guide"] = _fx(f"""
SELECT {_DAY} AS date, event_type AS dim, {_EL} AS el, CAST(COUNT(*) AS BIGINT) AS num
FROM {{events}} GROUP BY {_DAY}, event_type, {_EL}""")

FIXTURES["orders_paid"] = _fx("""
SELECT o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS pay_date,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS c_date
FROM {orders}""")

FIXTURES["login_os_plat"] = _fx("""
SELECT o_custkey AS user_id, CASE WHEN o_custkey % 3 = 0 THEN 'ios' ELSE 'android' END AS os,
  CASE WHEN o_orderkey % 2 = 0 THEN 'app' ELSE 'wxmp' END AS platform
FROM {orders}""")

FIXTURES["new_user"] = _fx("""
SELECT o_custkey AS user_id, o_orderkey AS space_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS c_date FROM {orders}""")

FIXTURES["cells"] = _fx("""
SELECT CAST(p_partkey AS VARCHAR(20)) AS rowkey, 'cf' AS family, '210401' AS qualifier, CAST(p_size AS VARCHAR(10)) AS value FROM {part}
UNION ALL
SELECT CAST(p_partkey AS VARCHAR(20)) AS rowkey, 'cf' AS family, 'hist' AS qualifier, p_type AS value FROM {part}
UNION ALL
SELECT CAST(p_partkey AS VARCHAR(20)) AS rowkey, 'meta' AS family, 'brand' AS qualifier, p_brand AS value FROM {part}""")

FIXTURES["hash_entries"] = _fx("""
SELECT p_brand AS key, p_name AS field, CAST(p_retailprice AS VARCHAR(20)) AS value FROM {part}""")

FIXTURES["set_members"] = _fx("""
SELECT DISTINCT p_type AS key, p_brand AS member FROM {part}""")

FIXTURES["anni_photo"] = _fx("""
SELECT CASE WHEN c_nationkey < 12 THEN 'app_a' ELSE 'app_b' END AS app,
  c_custkey % 7 AS anni_create, CAST(FLOOR(c_acctbal) AS BIGINT) % 13 AS photo_create FROM {customer}""")

FIXTURES["event_route"] = _fx(f"""
SELECT event_id, CASE event_type WHEN 'click' THEN 'farm' WHEN 'view' THEN 'tree' WHEN 'purchase' THEN 'tree' ELSE 'house' END AS sv,
  CASE WHEN event_id % 2 = 0 THEN 'login' ELSE 'visit' END AS bn,
  CASE WHEN event_id % 3 = 0 THEN 'sunshine' WHEN event_id % 3 = 1 THEN 'water' ELSE 'other' END AS el,
  CAST(ts AS VARCHAR(30)) AS time, ts
FROM {{events}}""")

_INDEX = """
SELECT CASE WHEN user_id % 3 = 0 THEN 'mp_w' ELSE 'mp_q' END AS sv, ts,
  CASE WHEN event_id % 17 = 0 THEN 0 ELSE 700000 + user_id END AS space_id,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS user_id, event_type, {MS} AS ts_ms
FROM {events}"""
FIXTURES["search_index"] = _fx(_INDEX.replace("{MS}", _SPARK_MS), _INDEX.replace("{MS}", _DUCK_MS))


def _couple_enriched(t):
    from .couples import enrich_couples
    return enrich_couples(t["couple"], t["ip_ranges"])


# The couple rows with a region per partner: Spark uses the library's
# interval join; the oracle writes the same lookup as BETWEEN joins.
FIXTURES["couple_enriched"] = Fixture(sql="", duck="""
SELECT c.*, ra.country AS a_country, ra.province AS a_province, ra.city AS a_city,
  rb.country AS b_country, rb.province AS b_province, rb.city AS b_city
FROM {couple} c LEFT JOIN {ip_ranges} ra ON c.a_ip BETWEEN ra.lo AND ra.hi
LEFT JOIN {ip_ranges} rb ON c.b_ip BETWEEN rb.lo AND rb.hi""", deps=("couple", "ip_ranges"), builder=_couple_enriched)


def _topo(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in BASE_TABLES or n in seen:
            return
        for d in FIXTURES[n].deps:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


class Tables:
    """Lazily loaded base tables and fixtures for one ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES or name not in FIXTURES:
                self._cache[name] = table(self.spark, self.sf_dir, name)
            else:
                fx = FIXTURES[name]
                if fx.builder is not None:
                    self._cache[name] = fx.builder(self)
                    return self._cache[name]
                frames = {d: self[d] for d in fx.deps}
                self._cache[name] = self.spark.sql(fx.sql, **frames)
        return self._cache[name]


def duck_with(*names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause defining the named fixtures (and their dependencies)
    for DuckDB; ``extra`` adds more CTEs after them (name -> SQL)."""
    parts = []
    for n in _topo(names):
        text = FIXTURES[n].duck_sql()
        text = re.sub(r"\{(\w+)\}", r"\1", text)
        parts.append(f"{n} AS ({text.strip()})")
    for n, text in (extra or {}).items():
        parts.append(f"{n} AS ({text.strip()})")
    return ("WITH " + ",\n".join(parts) + "\n") if parts else ""
