"""Single-operator queries: projections, filters, aggregates, windows,
sorts, set operations, scalar functions and the studied UDFs as native
expressions (PRJ-*, FLT-*, AGG-*, WIN-*, SRT-*, SET-*, SCL-*, UDF-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..operators.stats import topk_per_group
from ..operators.windows import global_row_number
from ..plans import couples as CP
from ..plans import enrich
from .couples_q import AS_OF, PARTNERS, HOME, PEOPLE, _AGE
from .registry import query

# ---------------------------------------------------------------- projections


@query("prj_select_expr", sql=f"""
SELECT space_id, CAST(date_diff('day', anniversary_day, registe_space_dt) AS INT) AS love_days, total_cost, 5 AS num
FROM couple""", fixtures=("couple",))
def prj_select_expr(t):
    """PRJ-01: projection with SQL expression strings."""
    return t["couple"].selectExpr("space_id", "datediff(registe_space_dt, anniversary_day) AS love_days",
                                  "total_cost", "5 AS num")


@query("prj_todf_rename", sql="SELECT c_custkey AS user_id, c_name AS name, c_nationkey AS nation FROM customer")
def prj_todf_rename(t):
    """PRJ-02: positional rename of all columns."""
    return t["customer"].select("c_custkey", "c_name", "c_nationkey").toDF("user_id", "name", "nation")


@query("prj_constant", sql="SELECT user_id, '2024-01-01' AS c_date, 5 AS num FROM events")
def prj_constant(t):
    """PRJ-03: constant columns."""
    return t["events"].select("user_id", F.lit("2024-01-01").alias("c_date"), F.lit(5).alias("num"))


@query("prj_with_column", sql="""
SELECT event_id, user_id, CAST(ts AS DATE) AS day, value * 2 AS value FROM events""", rounded=("value",))
def prj_with_column(t):
    """PRJ-04: add a column and replace one in place."""
    return (t["events"].select("event_id", "user_id", "ts", "value")
            .withColumn("day", F.to_date("ts")).withColumn("value", F.col("value") * 2).drop("ts"))


@query("prj_drop_ambiguous", sql="""
WITH a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
b AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT a.o_custkey, b.n AS f_n FROM a LEFT JOIN b ON a.o_custkey = b.o_custkey""")
def prj_drop_ambiguous(t):
    """PRJ-05: drop by reference removes one of two same-named columns;
    drop by name removes both."""
    o = t["orders"]
    a = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).alias("a")
    b = (o.where(F.col("o_orderstatus") == "F").groupBy("o_custkey")
          .agg(F.count(F.lit(1)).alias("n")).alias("b"))
    j = a.join(b, F.col("a.o_custkey") == F.col("b.o_custkey"), "left").drop(F.col("b.o_custkey"))
    return j.withColumn("f_n", F.col("b.n")).drop("n")


# ---------------------------------------------------------------- filters

_ENR = """SELECT u.user_id, r.country, r.area, r.province, r.city FROM user_ip u LEFT JOIN ip_ranges r ON u.ip BETWEEN r.lo AND r.hi"""


@query("flt_not_sentinel", sql=f"SELECT * FROM ({_ENR}) WHERE province != '0'", fixtures=("user_ip", "ip_ranges"))
def flt_not_sentinel(t):
    """FLT-01: ``!= '0'`` on a region (null rows drop too)."""
    return enrich.enrich_users(t["user_ip"], t["ip_ranges"]).where(F.col("province") != K.UNKNOWN_REGION)


@query("flt_in_list", sql="SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def flt_in_list(t):
    """FLT-02: ``IN`` list."""
    return t["orders"].select("o_orderkey", "o_orderpriority").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))


@query("flt_valid_ids", sql="""
SELECT space_id, user_id FROM app_log WHERE space_id IS NOT NULL AND user_id IS NOT NULL AND space_id != 0 AND user_id != 0""",
       fixtures=("app_log",))
def flt_valid_ids(t):
    """FLT-03: ids neither null nor 0."""
    from ..plans.farm import valid_ids
    return valid_ids(t["app_log"]).select("space_id", "user_id")


_LO_MS, _HI_MS = 1704844800000, 1705708800000   # 2024-01-10 and 2024-01-20, UTC


@query("flt_epoch_range", sql=f"""
SELECT user_id, ts_ms, ts_ms <= {_HI_MS} AS before_hi FROM app_log WHERE ts_ms BETWEEN {_LO_MS} AND {_HI_MS}""",
       fixtures=("app_log",))
def flt_epoch_range(t):
    """FLT-04: inclusive epoch-millis range on a bigint."""
    a = t["app_log"]
    return (a.where(F.col("ts_ms").between(_LO_MS, _HI_MS))
             .select("user_id", "ts_ms", (F.col("ts_ms") <= _HI_MS).alias("before_hi")))


@query("flt_numeric_range", sql="""
SELECT space_id, ld FROM (SELECT space_id, CAST(date_diff('day', anniversary_day, registe_space_dt) AS INT) AS ld FROM couple)
WHERE ld >= 0 AND ld <= 1095 AND ld IS NOT NULL""", fixtures=("couple",))
def flt_numeric_range(t):
    """FLT-05: numeric range plus a null test."""
    ld = F.datediff("registe_space_dt", "anniversary_day")
    return (t["couple"].select("space_id", ld.alias("ld"))
            .where((F.col("ld") >= 0) & (F.col("ld") <= K.LOVE_DAYS_MAX) & F.col("ld").isNotNull()))


@query("flt_or_dates", sql=f"""
SELECT space_id FROM couple
WHERE date_diff('day', CAST(TRY_CAST(a_last_use_time AS TIMESTAMP) AS DATE), DATE '{AS_OF}') <= 365
   OR date_diff('day', CAST(TRY_CAST(b_last_use_time AS TIMESTAMP) AS DATE), DATE '{AS_OF}') <= 365""", fixtures=("couple",))
def flt_or_dates(t):
    """FLT-06: OR over two computed day differences."""
    return (t["couple"].where((C.days_since(AS_OF, "a_last_use_time") <= 365)
                              | (C.days_since(AS_OF, "b_last_use_time") <= 365)).select("space_id"))


@query("flt_like_prefix", sql="SELECT space_id, user_id FROM app_log WHERE CAST(space_id AS VARCHAR) LIKE '7%'",
       fixtures=("app_log",))
def flt_like_prefix(t):
    """FLT-07: prefix match on a number's text."""
    return t["app_log"].where(F.col("space_id").cast("string").startswith("7")).select("space_id", "user_id")


@query("flt_contains", sql="""
SELECT value FROM (SELECT value FROM mic_log UNION ALL SELECT value FROM micro_log)
WHERE contains(value, 'Micro') AND NOT contains(value, 'Microscopic_view')""", fixtures=("mic_log", "micro_log"))
def flt_contains(t):
    """FLT-08: substring contains / not contains on raw lines."""
    lines = t["mic_log"].unionByName(t["micro_log"])
    return lines.where(F.col("value").contains("Micro") & ~F.col("value").contains("Microscopic_view"))


@query("flt_equality", sql="SELECT space_id, user_id, ts_ms FROM app_log WHERE bn = 'login'", fixtures=("app_log",))
def flt_equality(t):
    """FLT-09: equality on a text field."""
    return t["app_log"].where(F.col("bn") == "login").select("space_id", "user_id", "ts_ms")


@query("agg_having_uv", sql="""
SELECT event_type, CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS uv FROM events GROUP BY ALL HAVING count(DISTINCT user_id) >= 50""")
def agg_having_uv(t):
    """FLT-10: post-aggregate filter on a distinct count."""
    return (t["events"].groupBy("event_type", F.to_date("ts").alias("day"))
            .agg(F.countDistinct("user_id").alias("uv")).where(F.col("uv") >= 50))


@query("flt_on_derived", sql="""
SELECT space_id, a_country, b_country FROM couple_enriched WHERE a_country IS NOT DISTINCT FROM b_country""",
       fixtures=("couple_enriched",))
def flt_on_derived(t):
    """FLT-12: filter on a derived label (a native expression, so it can push)."""
    ce = t["couple_enriched"]
    return (ce.select("space_id", "a_country", "b_country",
                      C.same_country_type("a_country", "b_country").alias("country_type"))
              .where(F.col("country_type") == K.SAME_COUNTRY).drop("country_type"))


@query("flt_user_type_valid", sql="""
SELECT space_id, side, user_type, age FROM feat WHERE age != -1 AND user_type != 'null' AND user_type != '0'""",
       fixtures=("couple_enriched",), extra=PEOPLE)
def flt_user_type_valid(t):
    """FLT-13: exclude age -1 and user types 'null' / '0'."""
    p = CP.person_features(CP.partner_rows(t["couple_enriched"]), AS_OF)
    return (p.where((F.col("age") != -1) & (F.col("user_type") != "null") & (F.col("user_type") != "0"))
             .select("space_id", "side", "user_type", "age"))


# ---------------------------------------------------------------- aggregates


@query("agg_count", sql="SELECT c_nationkey, count(c_mktsegment) AS n FROM customer GROUP BY c_nationkey")
def agg_count(t):
    """AGG-01: grouped count of a column (nulls skipped)."""
    return t["customer"].groupBy("c_nationkey").agg(F.count("c_mktsegment").alias("n"))


@query("agg_group_count", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS "count" FROM lineitem GROUP BY ALL""")
def agg_group_count(t):
    """AGG-02: row count by several keys."""
    return t["lineitem"].groupBy("l_returnflag", "l_linestatus").count()


@query("agg_sum", sql="SELECT l_returnflag, sum(l_quantity) AS sum_qty FROM lineitem GROUP BY ALL")
def agg_sum(t):
    """AGG-03: grouped sum."""
    return t["lineitem"].groupBy("l_returnflag").agg(F.sum("l_quantity").alias("sum_qty"))


@query("agg_avg", sql="SELECT l_returnflag, avg(l_quantity) AS avg_qty FROM lineitem GROUP BY ALL", rounded=("avg_qty",))
def agg_avg(t):
    """AGG-04: grouped average."""
    return t["lineitem"].groupBy("l_returnflag").agg(F.avg("l_quantity").alias("avg_qty"))


@query("agg_global_avg", sql="SELECT avg(anni_create) AS avg_anni, avg(photo_create) AS avg_photo FROM anni_photo",
       fixtures=("anni_photo",), rounded=("avg_anni", "avg_photo"))
def agg_global_avg(t):
    """AGG-05: global average of several columns."""
    return t["anni_photo"].selectExpr("avg(anni_create) AS avg_anni", "avg(photo_create) AS avg_photo")


@query("agg_count_distinct", sql="SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY ALL")
def agg_count_distinct(t):
    """AGG-06: exact distinct count."""
    return t["events"].groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))


@query("agg_distinct_rows", sql="SELECT DISTINCT * FROM login_os_plat", fixtures=("login_os_plat",))
def agg_distinct_rows(t):
    """AGG-07: whole-row de-duplication."""
    return t["login_os_plat"].dropDuplicates()


@query("agg_distinct_keys", sql="""
SELECT space_id, user_id FROM farm WHERE space_id IS NOT NULL AND space_id != 0 AND user_id != 0 AND user_id IS NOT NULL
GROUP BY space_id, user_id""", fixtures=("farm",))
def agg_distinct_keys(t):
    """AGG-08: distinct keys (GROUP BY without aggregates)."""
    from ..plans.farm import valid_ids
    return valid_ids(t["farm"]).select("space_id", "user_id").distinct()


@query("agg_min_max_time", sql="""
SELECT sv, strftime(epoch_ms(min(ts_ms // 1000) * 1000), '%Y-%m-%d %H:%M:%S') AS time_stamp,
  strftime(epoch_ms(max(ts_ms // 1000) * 1000), '%Y-%m-%d %H:%M:%S') AS final_time FROM error_log GROUP BY sv""",
       fixtures=("error_log",))
def agg_min_max_time(t):
    """AGG-09: first and last time per group, formatted."""
    secs = F.floor(F.col("ts_ms") / 1000)
    return (t["error_log"].groupBy("sv")
            .agg(C.epoch_seconds_to_text(F.min(secs)).alias("time_stamp"),
                 C.epoch_seconds_to_text(F.max(secs)).alias("final_time")))


# ---------------------------------------------------------------- windows

_USER_COUNTS = "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL"


def _user_counts(t) -> DataFrame:
    return t["events"].groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))


@query("win_rank", sql=f"""
SELECT event_type, user_id, n, CAST(rank() OVER (PARTITION BY event_type ORDER BY n DESC) AS INT) AS rk FROM ({_USER_COUNTS})""")
def win_rank(t):
    """WIN-01: rank per partition by descending count (ties share, gaps)."""
    from ..operators.stats import rank_within
    return rank_within(_user_counts(t), ["event_type"], "n")


@query("win_percent_of_total", sql=f"""
SELECT event_type, user_id, n, n / sum(n) OVER (PARTITION BY event_type) * 100 AS percent FROM ({_USER_COUNTS})""",
       rounded=("percent",))
def win_percent_of_total(t):
    """WIN-02: count as a percent of its partition's total."""
    from ..operators.stats import with_percent_of_total
    return with_percent_of_total(_user_counts(t), "n", ["event_type"])


@query("win_global_row_number", sql="""
SELECT user_id, space_id, c_date, row_number() OVER (ORDER BY space_id, user_id) AS row_number FROM new_user""",
       fixtures=("new_user",))
def win_global_row_number(t):
    """WIN-03: row number over a global order, range-partitioned (no single
    task holds all rows)."""
    return global_row_number(t["new_user"], ["space_id", "user_id"])


@query("win_topk_per_group", sql=f"""
SELECT event_type, user_id, n, rk FROM (SELECT *, CAST(rank() OVER (PARTITION BY event_type ORDER BY n DESC) AS INT) AS rk
FROM ({_USER_COUNTS})) WHERE rk <= 3""")
def win_topk_per_group(t):
    """WIN-04: top-k per group by rank (ties kept)."""
    return topk_per_group(_user_counts(t), ["event_type"], "n", 3, percent_col=None)


# ---------------------------------------------------------------- sort / limit


@query("srt_mixed", sql="SELECT date, dim, el, num FROM guide ORDER BY el ASC, dim ASC, date DESC", fixtures=("guide",))
def srt_mixed(t):
    """SRT-01: multi-key sort, mixed directions."""
    return t["guide"].orderBy(F.asc("el"), F.asc("dim"), F.desc("date"))


@query("srt_single", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice")
def srt_single(t):
    """SRT-02: single-key sort."""
    return t["orders"].select("o_orderkey", "o_totalprice").orderBy("o_totalprice")


@query("limit_preview", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def limit_preview(t):
    """SNK-12 / SRT-04: first n rows after a total order (a top-n, planned
    as TakeOrderedAndProject: each task keeps n rows)."""
    return t["orders"].select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


# ---------------------------------------------------------------- set operations


@query("set_union_all", sql="""
SELECT o_custkey AS id, o_orderkey AS ref FROM orders UNION ALL SELECT l_suppkey, l_orderkey FROM lineitem""")
def set_union_all(t):
    """SET-01: UNION ALL by position (names from the first input)."""
    a = t["orders"].select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("ref"))
    b = t["lineitem"].select("l_suppkey", "l_orderkey")
    return a.union(b)


# ---------------------------------------------------------------- scalar functions


@query("scl_split_get", sql="""
SELECT value, CASE WHEN len(string_split(rtrim(value, ' '), ' ')) >= 1 THEN string_split(rtrim(value, ' '), ' ')[1] END AS f0,
  string_split(rtrim(value, ' '), ' ')[4] AS f3, string_split(rtrim(value, ' '), ' ')[6] AS f5 FROM mic_log""",
       fixtures=("mic_log",))
def scl_split_get(t):
    """SCL-01: split by a literal and pick fields (null past the end)."""
    v = F.col("value")
    return t["mic_log"].select("value", C.split_get(v, " ", 0).alias("f0"), C.split_get(v, " ", 3).alias("f3"),
                               C.split_get(v, " ", 5).alias("f5"))


@query("scl_concat", sql="""
SELECT CAST(space_id AS VARCHAR) || ' ' || CAST(user_id AS VARCHAR) AS value, CAST(space_id AS VARCHAR) || '-' || CAST(user_id AS VARCHAR) AS key
FROM space_user_list""", fixtures=("space_user_list",))
def scl_concat(t):
    """SCL-02: concat with and without a separator."""
    s = t["space_user_list"]
    return s.select(F.concat_ws(" ", "space_id", "user_id").alias("value"),
                    F.concat(F.col("space_id").cast("string"), F.lit("-"), F.col("user_id").cast("string")).alias("key"))


@query("scl_trim_reverse_upper", sql="""
SELECT c_custkey, upper(reverse(regexp_replace(chr(9) || ' ' || c_name || ' ' || chr(10), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'))) AS s FROM customer""")
def scl_trim_reverse_upper(t):
    """SCL-03: JVM trim (tabs and newlines too), reverse, upper."""
    padded = F.concat(F.lit("\t "), F.col("c_name"), F.lit(" \n"))
    return t["customer"].select("c_custkey", C.trim_reverse_upper(padded).alias("s"))


@query("scl_is_digits", sql="""
SELECT c_custkey, regexp_matches(split_part(c_name, '#', 2), '^[0-9]+$') AS tail_digits, regexp_matches(c_name, '^[0-9]+$') AS all_digits
FROM customer""")
def scl_is_digits(t):
    """SCL-04: digits-only test."""
    c = t["customer"]
    return c.select("c_custkey", C.is_digits(F.split_part("c_name", F.lit("#"), F.lit(2))).alias("tail_digits"),
                    C.is_digits("c_name").alias("all_digits"))


@query("scl_datediff", sql=f"""
SELECT space_id, CAST(date_diff('day', TRY_CAST(a_regist_time AS DATE), DATE '{AS_OF}') AS INT) AS since_days FROM couple""",
       fixtures=("couple",))
def scl_datediff(t):
    """SCL-05: days from a text date to a fixed as-of date."""
    return t["couple"].select("space_id", C.days_since(AS_OF, "a_regist_time").alias("since_days"))


@query("scl_datediff_cols", sql="""
SELECT space_id, CAST(date_diff('day', anniversary_day, registe_space_dt) AS INT) AS love_days FROM couple""",
       fixtures=("couple",))
def scl_datediff_cols(t):
    """SCL-06: day difference of two columns."""
    return t["couple"].select("space_id", C.days_between("registe_space_dt", "anniversary_day").alias("love_days"))


@query("scl_to_date", sql="""
SELECT space_id, CAST(TRY_CAST(a_last_use_time AS TIMESTAMP) AS DATE) AS last_use_day FROM couple""", fixtures=("couple",))
def scl_to_date(t):
    """SCL-07: timestamp text -> date."""
    return t["couple"].select("space_id", C.safe_date("a_last_use_time").alias("last_use_day"))


@query("scl_epoch_millis", sql="""
SELECT space_id, epoch_ms(CAST(c_date AS TIMESTAMP)) AS time FROM new_user""", fixtures=("new_user",))
def scl_epoch_millis(t):
    """SCL-08: date text -> epoch millis."""
    return t["new_user"].select("space_id", C.date_text_to_epoch_millis("c_date").alias("time"))


@query("scl_from_unixtime", sql="""
SELECT event_id, strftime(epoch_ms((ts_ms // 1000) * 1000), '%Y-%m-%d %H:%M:%S') AS time_text FROM error_log""",
       fixtures=("error_log",))
def scl_from_unixtime(t):
    """SCL-09: epoch millis -> seconds -> formatted text."""
    return t["error_log"].select("event_id", C.epoch_millis_to_text("ts_ms").alias("time_text"))


@query("scl_ts_to_millis", sql="""
SELECT event_id, epoch_ms(CAST(substr(time, 1, 19) AS TIMESTAMP)) AS ms FROM event_route""", fixtures=("event_route",))
def scl_ts_to_millis(t):
    """SCL-10: timestamp text with a fraction -> whole-second epoch millis."""
    return t["event_route"].select("event_id", C.ts_text_to_millis("time").alias("ms"))


@query("scl_cast", sql="""
SELECT c_custkey, CAST(trunc(c_acctbal) AS INT) AS bal_int, TRY_CAST(c_mktsegment AS INT) AS seg_int,
  CAST(c_custkey AS VARCHAR) AS key_text FROM customer""")
def scl_cast(t):
    """SCL-11: truncating cast, safe cast of text, cast to text."""
    c = t["customer"]
    return c.select("c_custkey", F.col("c_acctbal").cast("int").alias("bal_int"),
                    F.col("c_mktsegment").try_cast("int").alias("seg_int"),
                    F.col("c_custkey").cast("string").alias("key_text"))


@query("scl_coalesce", sql="""
SELECT event_id, coalesce(err_code, 'unkonw') AS err_code, coalesce(err_msg, 'unkonw') AS err_msg FROM error_log""",
       fixtures=("error_log",))
def scl_coalesce(t):
    """SCL-12: null defaults."""
    e = t["error_log"]
    return e.select("event_id", C.nvl("err_code", K.MISSING_ERR).alias("err_code"),
                    C.nvl("err_msg", K.MISSING_ERR).alias("err_msg"))


@query("scl_array_size_element", sql="""
SELECT value, CAST(len(string_split(value, ' ')) AS INTEGER) AS n_fields, string_split(value, ' ')[2] AS second FROM mic_log""",
       fixtures=("mic_log",))
def scl_array_size_element(t):
    """SCL-13: array size and 1-based element access."""
    arr = F.split("value", " ")
    return t["mic_log"].select("value", F.size(arr).alias("n_fields"), C.element_1based(arr, F.lit(2)).alias("second"))


@query("scl_map_struct", sql="""
SELECT l_orderkey, l_linenumber AS item_id, CAST(l_quantity AS BIGINT) AS count, 2 AS n_keys FROM lineitem""")
def scl_map_struct(t):
    """SCL-14: map constructor, read back by key."""
    m = F.create_map(F.lit("item_id"), F.col("l_linenumber").cast("bigint"),
                     F.lit("count"), F.col("l_quantity").cast("bigint"))
    return t["lineitem"].select("l_orderkey", m.alias("m")).select(
        "l_orderkey", F.col("m")["item_id"].cast("int").alias("item_id"), F.col("m")["count"].alias("count"),
        F.size("m").alias("n_keys"))


@query("scl_from_json", sql="""
SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events""")
def scl_from_json(t):
    """SCL-15: typed field extraction from JSON text."""
    return t["events"].select("event_id", C.json_fields("props", "k INT").getField("k").alias("k"))


@query("scl_to_json", sql="""
SELECT event_id, '{"msgtype":"markdown","markdown":{"content":"' || event_type || '"}}' AS body FROM events""")
def scl_to_json(t):
    """SCL-16: nested JSON object built from columns."""
    body = F.to_json(F.struct(F.lit("markdown").alias("msgtype"),
                              F.struct(F.col("event_type").alias("content")).alias("markdown")))
    return t["events"].select("event_id", body.alias("body"))


@query("scl_ip_to_long", sql="""
SELECT user_id, ip_addr, CAST(split_part(ip_addr, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip_addr, '.', 2) AS BIGINT) * 65536
  + CAST(split_part(ip_addr, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip_addr, '.', 4) AS BIGINT) AS ip FROM user_ip_text""",
       fixtures=("user_ip_text",))
def scl_ip_to_long(t):
    """SCL-17 / UDF-07: dotted IPv4 -> long."""
    return t["user_ip_text"].select("user_id", "ip_addr", C.ip_to_long("ip_addr").alias("ip"))


_LABELS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.SERVICE_LABELS.items())


@query("scl_case_label", sql=f"SELECT event_id, sv, CASE sv {_LABELS} ELSE sv END AS service FROM event_route",
       fixtures=("event_route",))
def scl_case_label(t):
    """SCL-18: value -> label mapping, unmapped values pass through."""
    return t["event_route"].select("event_id", "sv", C.map_label("sv", K.SERVICE_LABELS).alias("service"))


@query("scl_percent", sql="""
SELECT o_orderstatus, count(*) AS n, count(*) / sum(count(*)) OVER () * 100 AS pct FROM orders GROUP BY ALL""",
       rounded=("pct",))
def scl_percent(t):
    """SCL-19: integer arithmetic to a percent of the grand total (a scalar
    subquery, not a window over one partition)."""
    o = t["orders"]
    g = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", C.percent("n", o.select(F.count(F.lit(1))).scalar()))


# ---------------------------------------------------------------- studied UDFs


@query("udf_bucket_floor", sql="""
SELECT space_id, ld, CAST(ld - (((ld % 5) + 5) % 5) AS INT) AS b5, CAST(ld - (((ld % 20) + 20) % 20) AS INT) AS b20, 0 AS b1
FROM (SELECT space_id, CAST(date_diff('day', anniversary_day, registe_space_dt) AS INT) AS ld FROM couple)""",
       fixtures=("couple",))
def udf_bucket_floor(t):
    """UDF-01: largest multiple of the step not above x (negatives too)."""
    ld = F.datediff("registe_space_dt", "anniversary_day")
    c = t["couple"].select("space_id", ld.alias("ld"))
    return c.select("space_id", "ld", C.bucket_floor("ld", 5).alias("b5"), C.bucket_floor("ld", 20).alias("b20"),
                    C.bucket_floor("ld", 1).alias("b1"))


@query("udf_user_type", sql="SELECT space_id, side, since_days, last_active_days, user_type FROM feat",
       fixtures=("couple_enriched",), extra=PEOPLE)
def udf_user_type(t):
    """UDF-02: new / old / '0' user type (365-day rules)."""
    p = CP.person_features(CP.partner_rows(t["couple_enriched"]), AS_OF)
    return p.select("space_id", "side", "since_days", "last_active_days", "user_type")


@query("udf_love_days_type", sql="SELECT space_id, side, love_days, love_days_type FROM feat",
       fixtures=("couple_enriched",), extra=PEOPLE)
def udf_love_days_type(t):
    """UDF-03: 30days- / 30days+."""
    p = CP.person_features(CP.partner_rows(t["couple_enriched"]), AS_OF)
    return p.select("space_id", "side", "love_days", "love_days_type")


_PAIRS = " ".join(f"WHEN (a_country = '{HOME}' AND b_country = '{p}') OR (a_country = '{p}' AND b_country = '{HOME}') THEN '{l}'"
                  for p, l in PARTNERS.items())


@query("udf_country_pair", sql=f"""
SELECT space_id, a_country, b_country, CASE {_PAIRS} ELSE 'other' END AS country_type FROM couple_enriched""",
       fixtures=("couple_enriched",))
def udf_country_pair(t):
    """UDF-04: unordered (home, partner) country pair label."""
    ce = t["couple_enriched"]
    return ce.select("space_id", "a_country", "b_country",
                     C.country_pair_type("a_country", "b_country", HOME, PARTNERS).alias("country_type"))


@query("udf_age", sql=f"SELECT space_id, birthday, {_AGE} AS age FROM (SELECT space_id, a_birthday AS birthday FROM couple)",
       fixtures=("couple",))
def udf_age(t):
    """UDF-05: full years at the as-of date, 'NULL' -> -1."""
    return t["couple"].select("space_id", F.col("a_birthday").alias("birthday"),
                              C.age_at(F.col("a_birthday"), AS_OF).alias("age"))


@query("udf_same_country", sql="""
SELECT space_id, CASE WHEN a_country IS NOT DISTINCT FROM b_country THEN '同国' ELSE '异国' END AS country_type
FROM couple_enriched""", fixtures=("couple_enriched",))
def udf_same_country(t):
    """UDF-06: same / different country (null-safe equality)."""
    return t["couple_enriched"].select("space_id", C.same_country_type("a_country", "b_country").alias("country_type"))


@query("sql_events_by_type", sql="""
SELECT *, epoch_us(ts) // 1000 AS "@timestamp-log" FROM events WHERE event_type = 'purchase' ORDER BY "@timestamp-log\"""")
def sql_events_by_type(t):
    """SRC-14 / PIPE-19 / PRJ-07 / SRT-03: ``select *`` of one event type in
    time order, as one ``spark.sql`` plan (no driver-side cursor)."""
    return t.spark.sql(
        "SELECT *, timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) AS `@timestamp-log` "
        "FROM {events} WHERE event_type = 'purchase' ORDER BY `@timestamp-log`", events=t["events"])
