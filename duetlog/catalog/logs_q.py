"""Log, export and app-statistics queries (PIPE-04, PIPE-14..17, PIPE-20..24,
SET-02, SRC-09/15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import constants as K
from ..plans import logs as L
from ..session import staging_path
from ..sinks.writers import append_table, write_text
from ..sources.readers import read_json, read_space_user_tsv, read_text_lines
from .registry import query

# fixture parameters (the studied jobs' own values are the library defaults)
UV_MIN = 40
UPPER_MS = 1705968000000                   # 2024-01-23 00:00:00 UTC
FARM_RANGE = (1704844800000, 1705708800000)  # 2024-01-10 .. 2024-01-20 UTC
SOURCE_NO = {"tree": 0, "farm": 1, "house": 2, "qqmp": 3, "wxmp": 4, "app": 5}
INDEX_TERM = "mp_w"
INDEX_LO, INDEX_HI = "2024-01-05 16:00:00", "2024-01-12 05:00:00"
NEW_USER_DAY = "1996-03-15"
PAID_SINCE = "1997-01-01"

_SPLIT = "string_split(rtrim(value, ' '), ' ')"


@query("pipe_log_ip_counts", sql=f"""
WITH p AS (SELECT CASE WHEN len({_SPLIT}) >= 6 THEN {_SPLIT}[1] ELSE '0' END AS date,
                  CASE WHEN len({_SPLIT}) >= 6 THEN {_SPLIT}[5] ELSE '0' END AS user_id,
                  CASE WHEN len({_SPLIT}) >= 6 THEN {_SPLIT}[4] ELSE '0' END AS ip
           FROM mic_log WHERE NOT contains(value, 'Microscopic_view'))
SELECT date, user_id, ip, count(*) AS ip_num_cnt FROM p WHERE user_id IS NOT NULL GROUP BY ALL""", fixtures=("mic_log",))
def pipe_log_ip_counts(t):
    """PIPE-14 / SRC-05 / AGG-02: request log -> rows per (date, user, ip)."""
    return L.log_ip_counts(t["mic_log"])


@query("pipe_log_uv", sql=f"""
WITH p AS (SELECT s[1] AS types, s[2] AS date, s[9] AS userId
           FROM (SELECT {_SPLIT} AS s FROM micro_log WHERE contains(value, 'Micro') AND contains(value, ' ')))
SELECT types, date, count(DISTINCT userId) AS uv FROM p GROUP BY ALL HAVING count(DISTINCT userId) >= {UV_MIN}""",
       fixtures=("micro_log",))
def pipe_log_uv(t):
    """PIPE-15 / FLT-10: distinct users per (type, date), kept above a floor."""
    return L.log_uv(t["micro_log"], threshold=UV_MIN)


def _daily_files(t):
    """Write the daily log as one folder per ``app.log_<date>`` name and
    read it back with each line's file path."""
    base = staging_path(t.spark, "daily_log")
    write_text(t["daily_log"], base, partition_by="log_name")
    return read_text_lines(t.spark, f"{base}/*/*", with_path=True)


_DAILY_SQL = "SELECT split_part(value, ' ', 1) AS user_id, substr(log_name, 9) AS c_date FROM daily_log"


@query("src_filename_date", sql=_DAILY_SQL, fixtures=("daily_log",))
def src_filename_date(t):
    """SRC-09: many files in one scan, the date taken from each file's name."""
    return L.users_by_file_date(_daily_files(t))


@query("pipe_import_days", sql=_DAILY_SQL, fixtures=("daily_log",))
def pipe_import_days(t):
    """PIPE-16 / SNK-05: daily log files -> ``(user_id, c_date)`` appended
    to a table (external, in the shared folder), read back."""
    rows = L.users_by_file_date(_daily_files(t))
    path = staging_path(t.spark, "mid_app_user")
    name = "mid_app_user_" + path.rsplit("-", 1)[-1]
    append_table(rows, name, path=path)
    return t.spark.table(name)


def _sources(t):
    a = t["app_log"]
    out = {}
    for name, no in SOURCE_NO.items():
        df = a.where(F.col("source_no") == no)
        if name == "wxmp":
            df = df.withColumnRenamed("user_id", "open_id")
        out[name] = df
    return out


def _active_sql(lines: bool) -> str:
    rules = {"tree": ("'click_trace'", "upper"), "farm": (None, "range"), "house": ("'login'", "upper"),
             "qqmp": ("'login'", "upper"), "wxmp": (None, "upper"), "app": (None, "upper")}
    parts = []
    for name, (bn, rule) in rules.items():
        cond = [f"source_no = {SOURCE_NO[name]}", "space_id IS NOT NULL", "space_id != 0",
                "user_id IS NOT NULL", "user_id != 0", "app_name = 'main'"]
        if bn:
            cond.append(f"bn = {bn}")
        cond.append(f"ts_ms BETWEEN {FARM_RANGE[0]} AND {FARM_RANGE[1]}" if rule == "range" else f"ts_ms <= {UPPER_MS}")
        parts.append("SELECT space_id, user_id FROM app_log WHERE " + " AND ".join(cond))
    pairs = " UNION ALL ".join(parts)
    if not lines:
        return pairs
    return (f"SELECT CAST(space_id AS VARCHAR) || ' ' || CAST(user_id AS VARCHAR) AS value FROM "
            f"(SELECT * FROM ({pairs}) WHERE CAST(space_id AS VARCHAR) LIKE '7%' "
            f"UNION ALL SELECT space_id, user_id FROM space_user_list)")


@query("set_union_chain", sql=_active_sql(False), fixtures=("app_log",))
def set_union_chain(t):
    """SET-02: UNION ALL of six filtered sources by position (the ``open_id``
    column lines up under ``user_id``... named after the first input)."""
    return L.active_pairs(_sources(t), UPPER_MS, FARM_RANGE)


@query("pipe_active_union", sql=_active_sql(True), fixtures=("app_log", "space_user_list"))
def pipe_active_union(t):
    """PIPE-17 / SNK-03: six JSON folders and a tab-separated list read,
    their active users (space id starting with 7) plus the list written as
    ``space user`` text lines, read back."""
    base, sources = staging_path(t.spark, "active_src"), {}
    for name, df in _sources(t).items():
        df = df.drop("source_no")
        df.write.json(f"{base}/{name}")
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        sources[name] = read_json(t.spark, f"{base}/{name}/*", schema)
    write_text(t["space_user_list"], f"{base}/list", sep="\t")
    lines = L.active_union_lines(sources, read_space_user_tsv(t.spark, f"{base}/list"), UPPER_MS, FARM_RANGE)
    out = staging_path(t.spark, "active_text")
    write_text(lines, out)
    return read_text_lines(t.spark, out)


_NTZ = "TIMESTAMP_NTZ '{}'"


@query("src_term_time_range", sql=f"""
SELECT * FROM search_index WHERE sv = '{INDEX_TERM}' AND ts BETWEEN TIMESTAMP '{INDEX_LO}' AND TIMESTAMP '{INDEX_HI}'""",
       fixtures=("search_index",))
def src_term_time_range(t):
    """SRC-15: term match AND inclusive time range (pushed to the scan)."""
    return L.term_time_range(t["search_index"], "sv", INDEX_TERM, "ts",
                             F.expr(_NTZ.format(INDEX_LO)), F.expr(_NTZ.format(INDEX_HI)))


@query("pipe_index_users", sql=f"""
SELECT CAST(space_id AS VARCHAR) || ' ' || CAST(user_id AS VARCHAR) AS value FROM search_index
WHERE sv = '{INDEX_TERM}' AND ts BETWEEN TIMESTAMP '{INDEX_LO}' AND TIMESTAMP '{INDEX_HI}'
  AND space_id IS NOT NULL AND space_id != 0 AND user_id IS NOT NULL AND user_id != 0""", fixtures=("search_index",))
def pipe_index_users(t):
    """PIPE-20: users of one service in a time range, as text lines."""
    return L.index_users(t["search_index"], INDEX_TERM, F.expr(_NTZ.format(INDEX_LO)), F.expr(_NTZ.format(INDEX_HI)))


@query("src_term_index", sql=f"""
SELECT * FROM search_index WHERE sv = '{INDEX_TERM}' AND ts_ms BETWEEN epoch_ms(TIMESTAMP '{INDEX_LO}') AND epoch_ms(TIMESTAMP '{INDEX_HI}')""",
       fixtures=("search_index",))
def src_term_index(t):
    """SRC-15: the same through an inverted index on files: term and time
    range go down to the source, which opens only blocks that hold the term
    inside the range."""
    from ..sources.term_index import build_index, read_index
    p = staging_path(t.spark, "term_index")
    build_index(t["search_index"], p, ["sv", "event_type"], "ts_ms")
    ms = lambda x: int(dt.datetime.fromisoformat(x).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return read_index(t.spark, p).where((F.col("sv") == INDEX_TERM) & F.col("ts_ms").between(ms(INDEX_LO), ms(INDEX_HI)))


@query("pipe_numbered_users", sql=f"""
SELECT user_id, space_id, epoch_ms(CAST(c_date AS TIMESTAMP)) AS time,
  row_number() OVER (ORDER BY space_id, user_id) AS row_number FROM new_user WHERE c_date = '{NEW_USER_DAY}'""",
       fixtures=("new_user",))
def pipe_numbered_users(t):
    """PIPE-21 / SCL-08 / WIN-03: numbered new users of one day partition."""
    return L.numbered_new_users(t["new_user"], NEW_USER_DAY)


@query("pipe_resort_report", sql="SELECT date, dim, el, CAST(num AS VARCHAR) AS num FROM guide", fixtures=("guide",))
def pipe_resort_report(t):
    """PIPE-22: re-sort a tab report (el, dim ascending; date descending)."""
    g = t["guide"]
    lines = g.select(F.concat_ws("\t", "date", "dim", "el", F.col("num").cast("string")).alias("value"))
    return L.resort_report(lines)


@query("pipe_revenue_platform", sql=f"""
WITH o AS (SELECT user_id, sum(price) AS price FROM orders_paid WHERE c_date >= '{PAID_SINCE}' AND pay_date IS NOT NULL GROUP BY user_id),
u AS (SELECT DISTINCT user_id, os, platform FROM login_os_plat)
SELECT platform, os, sum(o.price) AS price FROM u JOIN o ON u.user_id = o.user_id GROUP BY platform, os""",
       fixtures=("orders_paid", "login_os_plat"))
def pipe_revenue_platform(t):
    """PIPE-23 / JOIN-04 / AGG-07: paid revenue by platform and OS."""
    return L.revenue_by_platform(t["orders_paid"], t["login_os_plat"], PAID_SINCE)


@query("pipe_two_app_avgs", sql="""
SELECT app, avg(anni_create) AS avg_anni, avg(photo_create) AS avg_photo FROM anni_photo GROUP BY app""",
       fixtures=("anni_photo",), rounded=("avg_anni", "avg_photo"))
def pipe_two_app_avgs(t):
    """PIPE-04 / AGG-05: global averages of two counters for two apps."""
    a = t["anni_photo"]
    return L.two_app_avgs({app: a.where(F.col("app") == app) for app in ("app_a", "app_b")})


@query("pipe_json_to_table", sql="SELECT os, platform, user_id FROM login_os_plat", fixtures=("login_os_plat",))
def pipe_json_to_table(t):
    """PIPE-24 / SRC-07 / SNK-05: JSON files (schema inferred) appended to
    a table, read back."""
    src = staging_path(t.spark, "login_json")
    t["login_os_plat"].write.json(src)
    df = read_json(t.spark, src)
    path = staging_path(t.spark, "login_table")
    name = "login_os_plat_" + path.rsplit("-", 1)[-1]
    append_table(df, name, path=path)
    return t.spark.table(name)


_RANGES = (("first", None, "2024-01-07"), ("middle", "2024-01-05", "2024-01-20"), ("all", None, None))


def _bitmap_sql() -> str:
    day = lambda a, b: " AND ".join([f"d >= DATE '{a}'"] * (a is not None) + [f"d <= DATE '{b}'"] * (b is not None)) or "true"
    parts = [f"SELECT '{n}' AS days, event_type, count(DISTINCT user_id) AS uv FROM e WHERE {day(a, b)} GROUP BY event_type "
             f"HAVING count(DISTINCT user_id) >= {UV_MIN}" for n, a, b in _RANGES]
    return "WITH e AS (SELECT event_type, user_id, CAST(ts AS DATE) AS d FROM events) " + " UNION ALL ".join(parts)


@query("agg_bitmap_uv", sql=_bitmap_sql())
def agg_bitmap_uv(t):
    """AGG-06 / FLT-10 / PIPE-15: distinct users per type over ranges of days,
    from bitmaps kept by day.  The days are added in two parts; no range reads
    an event."""
    from functools import reduce

    from ..operators.bitmaps import DailyBitmaps
    e = t["events"].withColumn("d", F.to_date("ts"))
    kept = DailyBitmaps(t.spark, staging_path(t.spark, "bitmaps"), ["event_type"], ["STRING"])
    early = F.col("d") <= F.lit("2024-01-10").cast("date")
    kept.add(e.where(early), "d", "user_id")
    kept.add(e.where(~early), "d", "user_id")
    ranges = [kept.counts(a, b, UV_MIN).select(F.lit(n).alias("days"), "event_type", "uv") for n, a, b in _RANGES]
    return reduce(lambda x, y: x.unionByName(y), ranges)


@query("agg_bitmap_log_uv", sql=f"""
WITH p AS (SELECT s[1] AS types, s[2] AS date, s[9] AS userId
           FROM (SELECT {_SPLIT} AS s FROM micro_log WHERE contains(value, 'Micro') AND contains(value, ' ')))
SELECT types, count(DISTINCT userId) AS uv FROM p GROUP BY types""", fixtures=("micro_log",))
def agg_bitmap_log_uv(t):
    """AGG-06 / PIPE-15: distinct users of the log per type over all days;
    the text ids get dense numbers, two arrivals one after the other."""
    from ..operators.bitmaps import DailyBitmaps, IdDictionary
    rows = L.parse_space_log(t["micro_log"], {"types": 0, "date": 1, "spaceId": 7, "userId": 8}, min_fields=9,
                             keep_containing=(K.LOG_MARKER, " "))
    ids = IdDictionary(t.spark, staging_path(t.spark, "ids"))
    kept = DailyBitmaps(t.spark, staging_path(t.spark, "log_bitmaps"), ["types"], ["STRING"])
    early = F.col("date") <= "2024-01-10"
    for part in (rows.where(early), rows.where(~early)):
        ids.extend(part, "userId")
        kept.add(ids.numbered(part, "userId"), "date", "number")
    return kept.counts()


@query("pipe_revenue_bucketed", sql=f"""
WITH o AS (SELECT user_id, sum(price) AS price FROM orders_paid WHERE c_date >= '{PAID_SINCE}' AND pay_date IS NOT NULL GROUP BY user_id),
u AS (SELECT DISTINCT user_id, os, platform FROM login_os_plat)
SELECT platform, os, sum(o.price) AS price FROM u JOIN o ON u.user_id = o.user_id GROUP BY platform, os""",
       fixtures=("orders_paid", "login_os_plat"))
def pipe_revenue_bucketed(t):
    """PIPE-23 / JOIN-04: the revenue report over two tables kept in buckets
    of the user: neither the sum per user, nor the distinct users, nor the
    join needs an exchange."""
    from ..sinks.writers import write_bucketed
    paid = t["orders_paid"].groupBy("user_id", "c_date", F.col("pay_date").isNotNull().alias("is_paid")).agg(F.sum("price").alias("price"))
    orders = write_bucketed(paid.withColumn("pay_date", F.when(F.col("is_paid"), F.col("c_date"))), ["user_id"])
    logins = write_bucketed(t["login_os_plat"].distinct(), ["user_id"])
    return L.revenue_by_platform(orders, logins, PAID_SINCE)
