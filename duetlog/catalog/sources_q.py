"""Source and sink round trips (SRC-01..08, 11, 16..18; SNK-01..06).

Each query derives its input from the driver's tables, writes it in the
studied format to a fresh folder under the shared checkpoint folder, reads
it back with the library reader and returns the parsed rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..plans import logs as L
from ..session import staging_path
from ..sinks import writers as W
from ..sources import readers as R
from .registry import query

HASH_KEYS = ("Brand#4", "Brand#19")
SET_KEY = "PROMO"
PAID_PARTITION = "1998-01-01"


def _stage(t, name):
    return staging_path(t.spark, name)


@query("src_text_lines", sql="SELECT value FROM mic_log", fixtures=("mic_log",))
def src_text_lines(t):
    """SRC-01: text lines from a path (gzip-compressed on write, decoded by
    suffix on read)."""
    p = _stage(t, "text")
    t["mic_log"].write.option("compression", "gzip").text(p)
    return R.read_text_lines(t.spark, p)


@query("src_bz2_lines", sql="SELECT value FROM daily_log", fixtures=("daily_log",))
def src_bz2_lines(t):
    """SRC-10: bzip2 text, the studied codec: its blocks let one large file
    be read by many tasks."""
    p = _stage(t, "bz2")
    t["daily_log"].select("value").write.option("compression", "bzip2").text(p)
    return R.read_text_lines(t.spark, p)


@query("src_csv_user_ip", sql="""
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(split_part(ip_addr, '.', 1) AS BIGINT) * 16777216
  + CAST(split_part(ip_addr, '.', 2) AS BIGINT) * 65536 + CAST(split_part(ip_addr, '.', 3) AS BIGINT) * 256
  + CAST(split_part(ip_addr, '.', 4) AS BIGINT) AS ip_num FROM user_ip_text""", fixtures=("user_ip_text",))
def src_csv_user_ip(t):
    """SRC-02: comma rows ``user_id,ip`` -> id text and address as a long."""
    p = _stage(t, "user_ip_csv")
    W.write_csv(t["user_ip_text"], p, header=False)
    return R.read_user_ip_csv(t.spark, p)


_PROFILE_TEXT = ["space_id", "a_gender", "b_gender", "a_birthday", "b_birthday", "a_retention", "b_retention",
                 "a_last_use_time", "a_regist_time", "b_regist_time", "registe_space_dt", "anniversary_day",
                 "close_time", "total_cost", "a_ip_text", "b_ip"]


@query("src_tsv_profile", sql="""
SELECT CAST(space_id AS VARCHAR) AS space_id, a_gender, b_gender, a_birthday, b_birthday, a_retention, b_retention,
  a_last_use_time AS last_use_time, a_regist_time, b_regist_time, CAST(registe_space_dt AS VARCHAR) AS registe_space_dt,
  CAST(anniversary_day AS VARCHAR) AS anniversary_day, 'NULL' AS close_time, CAST(total_cost AS VARCHAR) AS total_cost,
  CASE WHEN space_id % 17 = 0 THEN 0 ELSE a_ip END AS a_ip, b_ip FROM couple""", fixtures=("couple",))
def src_tsv_profile(t):
    """SRC-03: 16 tab-separated fields with ``NULL`` text; typed on read
    (``NULL`` address -> 0)."""
    c = (t["couple"].withColumn("close_time", F.lit("NULL"))
         .withColumn("a_ip_text", F.when(F.col("space_id") % 17 == 0, F.lit("NULL"))
                     .otherwise(F.col("a_ip").cast("string"))))
    lines = c.select(F.concat_ws("\t", *[F.col(x).cast("string") for x in _PROFILE_TEXT]).alias("value"))
    p = _stage(t, "profile_tsv")
    lines.write.text(p)
    return R.read_profile_tsv(t.spark, p)


@query("src_tsv_guide", sql="SELECT date, dim, el, CAST(num AS VARCHAR) AS num FROM guide", fixtures=("guide",))
def src_tsv_guide(t):
    """SRC-04: ``date, dim, el, num`` tab rows."""
    p = _stage(t, "guide_tsv")
    W.write_text(t["guide"], p, sep="\t")
    return R.read_guide_tsv(t.spark, p)


@query("src_space_log", sql="""
SELECT s[1] AS date, s[4] AS ip, s[5] AS user_id, s[6] AS space_id
FROM (SELECT string_split(rtrim(value, ' '), ' ') AS s FROM mic_log)""", fixtures=("mic_log",))
def src_space_log(t):
    """SRC-05: space-delimited line -> fields by position (null when short)."""
    p = _stage(t, "space_log")
    t["mic_log"].write.text(p)
    return L.parse_space_log(R.read_text_lines(t.spark, p), {"date": 0, "ip": 3, "user_id": 4, "space_id": 5},
                             min_fields=6)


@query("src_ip_ranges", sql="SELECT lo, hi, country, area, province, city, isp FROM ip_ranges", fixtures=("ip_ranges",))
def src_ip_ranges(t):
    """SRC-06: pipe-delimited ranges with dotted ends."""
    r = t["ip_ranges"]
    lines = r.select(F.concat_ws("|", C.long_to_ip("lo"), C.long_to_ip("hi"), "country", "area", "province",
                                 "city", "isp").alias("value"))
    p = _stage(t, "ip_ranges")
    lines.write.text(p)
    return R.read_ip_ranges(t.spark, p)


@query("src_json_inferred", sql="SELECT ip_addr, user_id FROM user_ip_text", fixtures=("user_ip_text",))
def src_json_inferred(t):
    """SRC-07: JSON lines with an inferred schema (names sorted)."""
    p = _stage(t, "user_ip_json")
    t["user_ip_text"].write.json(p)
    return R.read_json(t.spark, p)


_GLOB_DAY = "2024-01-10"


@query("src_json_glob", sql=f"""
SELECT space_id, user_id, bn, app_name, ts_ms AS "@timestamp-log" FROM app_log
WHERE strftime(epoch_ms(ts_ms), '%Y-%m-%d') = '{_GLOB_DAY}'""", fixtures=("app_log",))
def src_json_glob(t):
    """SRC-08: one dated folder of JSON files read with a ``*`` glob."""
    a = t["app_log"].select("space_id", "user_id", "bn", "app_name", F.col("ts_ms").alias("@timestamp-log"),
                            C.epoch_millis_to_text("ts_ms", "yyyy-MM-dd").alias("day"))
    p = _stage(t, "app_log_json")
    a.write.partitionBy("day").json(p)
    schema = "space_id BIGINT, user_id BIGINT, bn STRING, app_name STRING, `@timestamp-log` BIGINT"
    return R.read_json(t.spark, f"{p}/day={_GLOB_DAY}/*", schema=schema)


@query("src_sql_table", sql=f"""
SELECT user_id, price, c_date FROM orders_paid WHERE substr(c_date, 1, 7) >= '{PAID_PARTITION[:7]}'
  AND c_date >= '{PAID_PARTITION}' AND pay_date IS NOT NULL""",
       fixtures=("orders_paid",))
def src_sql_table(t):
    """SRC-11: a month-partitioned table read with a partition filter
    (pruned at planning: only matching folders are listed and scanned)."""
    p = _stage(t, "orders_paid")
    W.write_partitioned(t["orders_paid"].withColumn("c_month", F.substring("c_date", 1, 7)), p, ["c_month"])
    df = R.read_partitioned(t.spark, p, schema="user_id BIGINT, price DECIMAL(18,2), pay_date DATE, c_date STRING, "
                            "c_month STRING", where=f"c_month >= '{PAID_PARTITION[:7]}' AND c_date >= "
                            f"'{PAID_PARTITION}' AND pay_date IS NOT NULL")
    return df.select("user_id", "price", "c_date")


@query("src_catalog_table", sql=f"""
SELECT user_id, price, c_date FROM orders_paid WHERE substr(c_date, 1, 7) = '{PAID_PARTITION[:7]}'""", fixtures=("orders_paid",))
def src_catalog_table(t):
    """SRC-11: a catalog table partitioned by month, read by name with a
    partition filter (only that month's folder is scanned)."""
    p = _stage(t, "paid_table")
    name = "orders_paid_" + p.rsplit("-", 1)[-1]
    W.append_table(t["orders_paid"].withColumn("c_month", F.substring("c_date", 1, 7)), name, path=p, partition_by=["c_month"])
    return R.read_table(t.spark, name, f"c_month = '{PAID_PARTITION[:7]}'", ["user_id", "price", "c_date"])


@query("src_cells_to_rows", sql="""
SELECT rowkey, max(CASE WHEN qualifier = '210401' THEN value END) AS "210401", max(CASE WHEN qualifier = 'hist' THEN value END) AS hist
FROM cells WHERE family = 'cf' GROUP BY rowkey""", fixtures=("cells",))
def src_cells_to_rows(t):
    """SRC-16: wide-column cells -> one row per row key."""
    return R.cells_to_rows(t["cells"], ["210401", "hist"], family="cf")


@query("src_hash_entries", sql=f"""
SELECT field, value FROM hash_entries WHERE key IN ({", ".join(f"'{k}'" for k in HASH_KEYS)})""",
       fixtures=("hash_entries",))
def src_hash_entries(t):
    """SRC-17: (field, value) pairs of hashes by key list."""
    return R.hash_entries(t["hash_entries"], HASH_KEYS)


@query("src_set_members", sql=f"SELECT member FROM set_members WHERE key = '{SET_KEY}'", fixtures=("set_members",))
def src_set_members(t):
    """SRC-18: members of one set."""
    return R.set_members(t["set_members"], SET_KEY)


# ------------------------------------------------------------------ sinks

_CITY = """SELECT user_id, country, province FROM (SELECT u.user_id, r.country, r.province FROM user_ip u
  LEFT JOIN ip_ranges r ON u.ip BETWEEN r.lo AND r.hi)"""


def _enriched(t):
    from ..plans.enrich import enrich_users
    return enrich_users(t["user_ip"], t["ip_ranges"]).select("user_id", "country", "province")


@query("snk_csv_header", sql=f"SELECT CAST(user_id AS VARCHAR) AS user_id, country, province FROM ({_CITY})",
       fixtures=("user_ip", "ip_ranges"))
def snk_csv_header(t):
    """SNK-01: CSV with a header (in every file), read back."""
    p = _stage(t, "csv_header")
    W.write_csv(_enriched(t), p, header=True)
    return t.spark.read.option("header", True).csv(p)


@query("snk_csv_plain", sql=f"SELECT CAST(user_id AS VARCHAR) AS _c0, country AS _c1, province AS _c2 FROM ({_CITY})",
       fixtures=("user_ip", "ip_ranges"))
def snk_csv_plain(t):
    """SNK-02: CSV without a header, read back (default names)."""
    p = _stage(t, "csv_plain")
    W.write_csv(_enriched(t), p, header=False)
    return t.spark.read.csv(p)


@query("snk_text_value", sql="""
SELECT CAST(space_id AS VARCHAR) || ' ' || CAST(user_id AS VARCHAR) AS value FROM space_user_list""",
       fixtures=("space_user_list",))
def snk_text_value(t):
    """SNK-03: one ``value`` text column ``"space user"``, read back."""
    p = _stage(t, "text_value")
    W.write_text(t["space_user_list"], p)
    return R.read_text_lines(t.spark, p)


@query("snk_table_append", sql="""
SELECT user_id, ip FROM user_ip UNION ALL SELECT user_id, ip FROM user_ip""", fixtures=("user_ip",))
def snk_table_append(t):
    """SNK-05: two appends to one table (rows accumulate)."""
    p = _stage(t, "append_table")
    name = "user_ip_" + p.rsplit("-", 1)[-1]
    W.append_table(t["user_ip"], name, path=p)
    W.append_table(t["user_ip"], name, path=p)
    return t.spark.table(name)


@query("snk_table_create", sql="SELECT user_id, ip FROM user_ip", fixtures=("user_ip",))
def snk_table_create(t):
    """SNK-06: create a table (error if it exists), read back."""
    p = _stage(t, "create_table")
    name = "user_ip_c_" + p.rsplit("-", 1)[-1]
    W.create_table(t["user_ip"], name, path=p)
    return t.spark.table(name)


@query("src_partitioned_log", sql="""
SELECT CAST(user_id % 4 AS INT) AS "partition",
  row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id % 2, event_id) - 1 AS "offset",
  CAST(event_id AS VARCHAR) || ' ' || event_type AS value FROM events""")
def src_partitioned_log(t):
    """SRC-19 / STR-11: events appended to a partitioned log in two parts (even
    ids, then odd) and read by a stream with a consumer group; the second run
    starts from the checkpoint, and offsets are committed after the output."""
    from ..sources.partitioned_log import append_log, stream_log
    e, value = t["events"], F.concat_ws(" ", F.col("event_id").cast("string"), "event_type")
    log, out, ckpt = _stage(t, "log"), _stage(t, "log_out"), _stage(t, "log_ckpt")
    for half in (0, 1):
        append_log(e.where(F.col("event_id") % 2 == half), log, F.col("user_id") % 4, ["event_id"], value)
        q = (stream_log(t.spark, log, "readers").writeStream
             .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"))
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    return t.spark.read.schema("partition INT, offset BIGINT, value STRING, batch INT").parquet(out).drop("batch")


SCAN = ("12", "30")


@query("src_region_scan", sql=f"""
SELECT rowkey, max(CASE WHEN qualifier = '210401' THEN value END) AS "210401", max(CASE WHEN qualifier = 'hist' THEN value END) AS hist
FROM cells WHERE family = 'cf' AND rowkey >= '{SCAN[0]}' AND rowkey < '{SCAN[1]}' GROUP BY rowkey""", fixtures=("cells",))
def src_region_scan(t):
    """SRC-16: the cells written as sorted region files and scanned from a
    start to a stop key; other regions are not opened."""
    from ..sources.row_store import scan, write_regions
    p = _stage(t, "regions")
    write_regions(t["cells"], p)
    return scan(t.spark, p, *SCAN, ["210401", "hist"])


@query("src_hashes_by_keys", sql="""
SELECT key, field, value FROM hash_entries WHERE key IN (SELECT p_brand FROM part WHERE p_partkey % 400 = 7)""", fixtures=("hash_entries",))
def src_hashes_by_keys(t):
    """SRC-17: the hashes whose keys a table lists."""
    return R.hashes_by_keys(t["hash_entries"], t["part"].where("p_partkey % 400 = 7").select(F.col("p_brand").alias("key")))


@query("src_members_of_sets", sql="""
SELECT DISTINCT key, member FROM set_members WHERE key IN (SELECT p_type FROM part WHERE p_partkey % 400 = 7)""", fixtures=("set_members",))
def src_members_of_sets(t):
    """SRC-18: the members of all sets whose keys a table lists."""
    return R.members_of_sets(t["set_members"], t["part"].where("p_partkey % 400 = 7").select(F.col("p_type").alias("key")))


@query("src_ingest_ledger", sql="SELECT split_part(value, ' ', 1) AS user_id, substr(log_name, 9) AS c_date FROM daily_log",
       fixtures=("daily_log",))
def src_ingest_ledger(t):
    """SRC-09 / PIPE-16: daily log files arriving in two halves and imported
    through a ledger after each; every run sees all files and takes the new
    ones."""
    from ..sources.ledger import Ledger
    folder, ledger = _stage(t, "arriving"), Ledger(t.spark, _stage(t, "imports"))
    log, even = t["daily_log"], F.substring("log_name", -2, 2).cast("int") % 2 == 0
    for half in (even, ~even):
        W.write_text(log.where(half), folder, mode="append", partition_by="log_name")
        ledger.import_new(f"{folder}/*/*", lambda files: R.read_text_lines(t.spark, files, with_path=True))
    ledger.import_new(f"{folder}/*/*", lambda files: R.read_text_lines(t.spark, files, with_path=True))      # nothing new
    return L.users_by_file_date(ledger.read("value STRING, file_path STRING"))
