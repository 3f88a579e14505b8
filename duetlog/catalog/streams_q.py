"""Streaming operators as batch twins over a replayed log (STR-02..09).

The streaming runs themselves (``foreachBatch`` state merge, update-mode
running counts) are exercised in ``tests/test_streaming.py`` and must equal
these twins.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import constants as K
from ..streaming import alarm as A
from ..streaming.parse import parse_error_log, route_events
from .registry import query

THRESHOLD = 5          # fitted to the fixture: a few errors per key and day
DAY = 86400

def _json_col():
    return F.to_json(F.struct("sv", "bn", "url", "err_code", "err_msg", F.col("ts_ms").alias("@timestamp-log"),
                              "ip_addr")).alias("value")
_KEY = "sv, bn, url, err_code, err_msg"
_PARSED = """SELECT sv, bn, url, coalesce(err_code, 'unkonw') AS err_code, coalesce(err_msg, 'unkonw') AS err_msg,
  ts_ms // 1000 AS time_stamp, ip_addr, ts_ms // 1000 // 86400 AS batch FROM error_log"""
_FMT = "'%Y-%m-%d %H:%M:%S'"


def _parsed(t):
    return parse_error_log(t["error_log"].select(_json_col()))


@query("str_parse_error_log", sql=f"SELECT {_KEY}, time_stamp, ip_addr FROM ({_PARSED})", fixtures=("error_log",))
def str_parse_error_log(t):
    """STR-02: JSON payload -> typed fields, defaults, millis -> seconds."""
    return _parsed(t)


_ROUTED = f"""
SELECT CASE WHEN sv = 'farm' AND bn = 'login' THEN '{K.ROUTE_LOGIN}' WHEN sv = 'tree' AND el = 'sunshine' THEN '{K.ROUTE_SUNSHINE}'
  WHEN sv = 'tree' AND el = 'water' THEN '{K.ROUTE_WATER}' END AS label, time FROM event_route
WHERE (sv = 'farm' AND bn = 'login') OR (sv = 'tree' AND el IN ('sunshine', 'water'))"""


@query("str_event_routing", sql=_ROUTED, fixtures=("event_route",))
def str_event_routing(t):
    """STR-03: route events to labels, drop the rest."""
    e = t["event_route"].select(F.to_json(F.struct("sv", "bn", "el", "time")).alias("value"))
    return route_events(e)


@query("pipe_event_routing", sql=_ROUTED, fixtures=("event_route",))
def pipe_event_routing(t):
    """PIPE-26: the routing job as a stream over staged JSON lines into a
    Parquet folder, read back."""
    from ..session import staging_path
    from ..sources.readers import read_stream
    from ..streaming.parse import run_route_stream
    src, out = staging_path(t.spark, "route_src"), staging_path(t.spark, "route_out")
    t["event_route"].select(F.to_json(F.struct("sv", "bn", "el", "time")).alias("value")).write.text(src)
    run_route_stream(read_stream(t.spark, "text", path=src), out, staging_path(t.spark, "route_ckpt"),
                     {"availableNow": True}).awaitTermination()
    return t.spark.read.schema("label STRING, time STRING").parquet(out)


@query("str_tumbling_error_agg", sql=f"""
SELECT time_stamp - time_stamp % 86400 AS window_start, {_KEY},
  strftime(epoch_ms(min(time_stamp) * 1000), {_FMT}) AS first_time, count(ip_addr) AS num,
  strftime(epoch_ms(max(time_stamp) * 1000), {_FMT}) AS final_time, count(DISTINCT ip_addr) AS ip_num
FROM ({_PARSED}) GROUP BY time_stamp - time_stamp % 86400, {_KEY}""", fixtures=("error_log",))
def str_tumbling_error_agg(t):
    """STR-04: per tumbling window (one day here, the trigger length in a
    stream) and key: first time, count, last time, distinct addresses."""
    p = _parsed(t).withColumn("w", F.window(F.timestamp_seconds("time_stamp"), "1 day"))
    agg = A.batch_aggregate(p, extra_keys=("w",))
    return agg.select(F.unix_seconds(F.col("w.start")).alias("window_start"), *A.GROUP_KEY,
                      F.col("time_stamp").alias("first_time"), "num", "final_time", "ip_num")


def _daily_agg(t):
    p = _parsed(t).withColumn("batch", F.floor(F.col("time_stamp") / DAY))
    return A.batch_aggregate(p, extra_keys=("batch",), distinct_ips=False)


_TWIN = f"""
WITH a AS (SELECT {_KEY}, batch, strftime(epoch_ms(min(time_stamp) * 1000), {_FMT}) AS t0, count(ip_addr) AS num,
             strftime(epoch_ms(max(time_stamp) * 1000), {_FMT}) AS final_time FROM ({_PARSED}) GROUP BY {_KEY}, batch),
x AS (SELECT *, num >= {THRESHOLD} AS hot, lag(batch) OVER w AS pb, lag(num >= {THRESHOLD}) OVER w AS ph, lead(batch) OVER w AS nb
      FROM a WINDOW w AS (PARTITION BY {_KEY} ORDER BY batch)),
z AS (SELECT *, CASE WHEN hot AND NOT coalesce(pb = batch - 1 AND ph, false) THEN 0 WHEN hot THEN 1
                     WHEN coalesce(pb = batch - 1 AND ph, false) THEN 2 END AS status FROM x),
r AS (SELECT *, sum(CASE WHEN status = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {_KEY} ORDER BY batch ROWS UNBOUNDED PRECEDING) AS run
      FROM z WHERE status IS NOT NULL),
tt AS (SELECT *, CAST(sum(num) OVER (PARTITION BY {_KEY}, run ORDER BY batch ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_num,
         first_value(t0) OVER (PARTITION BY {_KEY}, run ORDER BY batch ROWS UNBOUNDED PRECEDING) AS ts0 FROM r),
twin AS (
SELECT {_KEY}, batch, ts0 AS time_stamp, num, status, final_time, total_num FROM tt
UNION ALL
SELECT {_KEY}, batch + 1 AS batch, ts0 AS time_stamp, CAST(0 AS BIGINT) AS num, 2 AS status, final_time, total_num FROM tt
WHERE hot AND (nb IS NULL OR nb != batch + 1) AND batch + 1 <= (SELECT max(batch) FROM a))"""


def _twin(t):
    return A.alarm_status_batch(_daily_agg(t), THRESHOLD)


@query("str_alarm_status", sql=_TWIN + " SELECT * FROM twin", fixtures=("error_log",))
def str_alarm_status(t):
    """STR-05: alarm status per key and daily batch (closed form of the
    state machine when the presence key is the group key)."""
    return _twin(t)


@query("str_alarm_total", sql=_TWIN + f" SELECT {_KEY}, batch, total_num FROM twin WHERE status = 2",
       fixtures=("error_log",))
def str_alarm_total(t):
    """STR-06: total errors of each alarm run, reported on recovery."""
    return _twin(t).where(F.col("status") == 2).select(*A.GROUP_KEY, "batch", "total_num")


def _content_sql() -> str:
    labels = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.SERVICE_LABELS.items())
    fields = {"service": f"CASE sv {labels} ELSE sv END", "bn": "bn", "url": "url", "err_code": "err_code",
              "err_msg": "err_msg", "num": "CAST(num AS VARCHAR)", "time": "time_stamp",
              "total": "CAST(total_num AS VARCHAR)", "final_time": "final_time"}

    def fill(tpl):
        out, rest = [], tpl
        while "{" in rest:
            head, tail = rest.split("{", 1)
            name, rest = tail.split("}", 1)
            out += ["'" + head.replace("'", "''") + "'", f"coalesce({fields[name]}, 'null')"]
        out.append("'" + rest.replace("'", "''") + "'")
        return " || ".join(out)

    return (f"CASE status WHEN 0 THEN {fill(K.ALARM_TEMPLATE_NEW)} WHEN 1 THEN {fill(K.ALARM_TEMPLATE_ONGOING)} "
            f"WHEN 2 THEN {fill(K.ALARM_TEMPLATE_RECOVERED)} ELSE '{K.ALARM_UNKNOWN_STATE}' END")


@query("str_alarm_message", sql=_TWIN + f" SELECT {_KEY}, batch, status, {_content_sql()} AS content FROM twin",
       fixtures=("error_log",))
def str_alarm_message(t):
    """STR-08: the markdown alarm text per state row (service label, one
    template per status)."""
    tw = _twin(t)
    return tw.select(*A.GROUP_KEY, "batch", "status", A.alarm_content(tw).alias("content"))


@query("str_running_count", sql="""
WITH c AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(hour(ts) AS INT) AS hour, CAST(minute(ts) // 10 AS INT) AS batch,
             count(*) AS pv FROM events GROUP BY ALL)
SELECT date, hour, batch, pv, CAST(sum(pv) OVER (PARTITION BY date, hour ORDER BY batch) AS BIGINT) AS running FROM c""")
def str_running_count(t):
    """STR-09: running page views per (date, hour) key across micro-batches
    (10-minute arrival slots); the stream form is an update-mode count."""
    e = t["events"]
    c = (e.groupBy(F.to_date("ts").cast("string").alias("date"), F.hour("ts").alias("hour"),
                   F.floor(F.minute("ts") / 10).cast("int").alias("batch"))
         .agg(F.count(F.lit(1)).alias("pv")))
    w = Window.partitionBy("date", "hour").orderBy("batch")
    return c.withColumn("running", F.sum("pv").over(w))


# ------------------------------------------------------------------ state sinks

_DAY_AGG = f"""SELECT {_KEY}, batch, strftime(epoch_ms(min(time_stamp) * 1000), {_FMT}) AS time_stamp, count(ip_addr) AS num,
  strftime(epoch_ms(max(time_stamp) * 1000), {_FMT}) AS final_time FROM ({_PARSED}) GROUP BY {_KEY}, batch"""


@query("snk_upsert_accumulate", sql=f"""
WITH d AS ({_DAY_AGG}),
s AS (SELECT * REPLACE (batch + 1 AS batch) FROM d), b AS (SELECT * FROM d)
SELECT coalesce(b.batch, s.batch) AS batch, coalesce(b.sv, s.sv) AS sv, coalesce(b.bn, s.bn) AS bn, coalesce(b.url, s.url) AS url,
  coalesce(b.err_code, s.err_code) AS err_code, coalesce(b.err_msg, s.err_msg) AS err_msg,
  coalesce(s.time_stamp, b.time_stamp) AS time_stamp, coalesce(b.num, s.num) AS num,
  coalesce(b.final_time, s.final_time) AS final_time,
  CASE WHEN b.sv IS NOT NULL AND s.sv IS NOT NULL THEN s.num + b.num WHEN b.sv IS NOT NULL THEN b.num ELSE s.num END AS total_num
FROM s FULL OUTER JOIN b ON s.batch = b.batch AND s.sv = b.sv AND s.bn = b.bn AND s.url = b.url AND s.err_code = b.err_code
  AND s.err_msg = b.err_msg""",
       fixtures=("error_log",))
def snk_upsert_accumulate(t):
    """SNK-09: every day's key counts upserted into the state of the day
    before (empty before the first day, no counts after the last): ``num`` and
    ``final_time`` set, ``total_num`` accumulated, new keys inserted."""
    from ..sinks.writers import upsert_accumulate
    a = _daily_agg(t).select("batch", *A.GROUP_KEY, "time_stamp", "num", "final_time", F.col("num").alias("total_num"))
    state = a.withColumn("batch", F.col("batch") + 1)
    return upsert_accumulate(state, a, ["batch", *A.GROUP_KEY], ["num", "final_time"], {"total_num": "num"})


@query("snk_delete_by_status", sql=_TWIN + " SELECT * FROM twin WHERE status NOT IN (2, 3)", fixtures=("error_log",))
def snk_delete_by_status(t):
    """SNK-10: alarm rows without the recovered (2) and sub-threshold (3)
    statuses."""
    from ..sinks.writers import delete_by_status
    return delete_by_status(_twin(t), [2, 3])


_REPLAY = f"""
WITH a AS (SELECT {_KEY}, batch AS day, strftime(epoch_ms(min(time_stamp) * 1000), {_FMT}) AS t0, count(ip_addr) AS num,
             strftime(epoch_ms(max(time_stamp) * 1000), {_FMT}) AS t1 FROM ({_PARSED}) GROUP BY {_KEY}, batch),
days AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS batch FROM (SELECT DISTINCT day FROM a)),
keys AS (SELECT DISTINCT {_KEY} FROM a),
here AS (SELECT DISTINCT url, err_code, day FROM a),
grid AS (SELECT keys.*, days.*, a.t0, a.num, a.t1,
           CASE WHEN a.num >= {THRESHOLD} THEN 'hot' WHEN a.num IS NOT NULL THEN 'cold' WHEN here.day IS NOT NULL THEN 'near' ELSE 'gone' END AS kind
         FROM keys CROSS JOIN days LEFT JOIN a USING ({_KEY}, day) LEFT JOIN here USING (url, err_code, day)),
live AS (SELECT *, coalesce(last_value(CASE WHEN kind <> 'near' THEN kind END IGNORE NULLS) OVER (
           PARTITION BY {_KEY} ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 'hot', false) AS alive FROM grid),
runs AS (SELECT *, sum(CASE WHEN kind = 'hot' AND NOT alive THEN 1 ELSE 0 END) OVER (
           PARTITION BY {_KEY} ORDER BY batch ROWS UNBOUNDED PRECEDING) AS run FROM live WHERE alive OR kind = 'hot'),
told AS (SELECT *, last_value(CASE WHEN kind = 'hot' THEN alive::INT END IGNORE NULLS) OVER w AS hot_status,
           last_value(num IGNORE NULLS) OVER w AS last_num, last_value(t1 IGNORE NULLS) OVER w AS last_time,
           first_value(t0) OVER w AS first_time, sum(num) OVER w AS total FROM runs
         WINDOW w AS (PARTITION BY {_KEY}, run ORDER BY batch ROWS UNBOUNDED PRECEDING))
SELECT {_KEY}, batch, first_time AS time_stamp, CASE kind WHEN 'gone' THEN 0 ELSE last_num END AS num,
  CASE WHEN kind IN ('hot', 'near') THEN hot_status ELSE 2 END AS status, last_time AS final_time, CAST(total AS BIGINT) AS total_num FROM told"""


@query("pipe_alarm_replay", sql=_REPLAY, fixtures=("error_log",))
def pipe_alarm_replay(t):
    """PIPE-25: the error-log alarm as a stream (``run_alarm_stream``) over
    staged JSON files, one file per micro-batch in day order, with the real
    presence rule: a key recovers when its ``(url, err_code)`` is absent.
    Every state version is kept and the union of versions is returned."""
    from ..session import list_files, set_times, staging_path
    from ..sources.readers import read_stream
    raw = t["error_log"].select(_json_col(), F.floor(F.col("ts_ms") / 1000 / DAY).alias("day"))
    src = staging_path(t.spark, "alarm_src")
    raw.repartition("day").write.partitionBy("day").text(src)          # the arriving files, one a day
    for n, folder in enumerate(f for f in list_files(t.spark, src) if "/day=" in f):
        for part in list_files(t.spark, folder):                       # arrival order = day order
            set_times(t.spark, part, 1_600_000_000_000 + n * 60_000)
    source = read_stream(t.spark, "text", {"maxFilesPerTrigger": "1"}, path=f"{src}/day=*")
    handler = A.AlarmStateTable(staging_path(t.spark, "alarm_state"), THRESHOLD, keep_versions=None)
    A.run_alarm_stream(source, handler, staging_path(t.spark, "alarm_ckpt"), {"availableNow": True}).awaitTermination()
    states = t.spark.read.parquet(handler.base)
    return states.select(*A.GROUP_KEY, F.col("batch").cast("bigint").alias("batch"), "time_stamp", "num", "status",
                         "final_time", "total_num")


@query("str_watermark_window", sql="""
WITH e AS (SELECT epoch_us(ts) // 1000000 AS s, sv FROM error_log),
m AS (SELECT max(epoch_us(ts)) AS mx FROM error_log)
SELECT s - s % 86400 AS window_start, sv, count(*) AS n FROM e GROUP BY s - s % 86400, sv
HAVING (s - s % 86400 + 86400) * CAST(1000000 AS BIGINT) <= (SELECT mx FROM m) - CAST(3600000000 AS BIGINT)""", fixtures=("error_log",))
def str_watermark_window(t):
    """STR-12: a Structured Streaming run (file source, ``availableNow``)
    counting errors per service in 1-day event-time windows with a 1-hour
    watermark, append mode: a window is emitted once the watermark passes
    its end, so the last, still-open day is not in the output."""
    from ..session import staging_path
    from ..streaming.windows import windowed_counts
    spark = t.spark
    src, out = staging_path(spark, "wm_src"), staging_path(spark, "wm_out")
    t["error_log"].select("ts", "sv").write.parquet(src)
    stream = spark.readStream.schema("ts TIMESTAMP_NTZ, sv STRING").parquet(src)
    agg = windowed_counts(stream, "ts", "1 day", "1 hour", ["sv"])
    q = (agg.writeStream.outputMode("append")
         .foreachBatch(lambda df, bid: df.write.mode("overwrite").parquet(f"{out}/batch={bid}"))   # a replay rewrites its own folder
         .option("checkpointLocation", staging_path(spark, "wm_ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("window_start BIGINT, sv STRING, n BIGINT, batch BIGINT").parquet(out).drop("batch")


# ------------------------------------------------------------------ keyed state

_RUNNING = """
WITH c AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(hour(ts) AS INT) AS hour, CAST(minute(ts) // 10 AS INT) AS batch,
             count(*) AS pv FROM events GROUP BY ALL)
SELECT date, hour, batch, pv, CAST(sum(pv) OVER (PARTITION BY date, hour ORDER BY batch) AS BIGINT) AS running FROM c"""


@query("str_keyed_running_count", sql=_RUNNING)
def str_keyed_running_count(t):
    """STR-09 / STR-10: the running count as keyed state.  The events arrive
    in six ten-minute slots; after each the query is started again from its
    checkpoint and adds the slot's counts to the state it left behind."""
    from ..session import staging_path
    from ..streaming import keyed
    src, out, ckpt = (staging_path(t.spark, f"run_{n}") for n in ("src", "out", "ckpt"))
    e = t["events"].select(F.to_date("ts").cast("string").alias("date"), F.hour("ts").alias("hour"),
                           F.floor(F.minute("ts") / 10).cast("int").alias("slot"))
    write = lambda n: e.where(F.col("slot") == n).select("date", "hour").write.parquet(f"{src}/slot={n}")
    rows = lambda: keyed.running_counts(
        t.spark.readStream.schema("date STRING, hour INT").parquet(f"{src}/slot=*"), ["date", "hour"])
    keyed.replay([lambda n=n: write(n) for n in range(6)], rows, out, ckpt)
    return t.spark.read.schema("date STRING, hour INT, pv BIGINT, running BIGINT, batch INT").parquet(out)


def _staged_days(t):
    """The error log as arriving JSON files, one a day, in day order."""
    from ..session import list_files, set_times, staging_path
    raw = t["error_log"].select(_json_col(), F.floor(F.col("ts_ms") / 1000 / DAY).alias("day"))
    src = staging_path(t.spark, "alarm_src")
    raw.repartition("day").write.partitionBy("day").text(src)
    for n, folder in enumerate(f for f in list_files(t.spark, src) if "/day=" in f):
        for part in list_files(t.spark, folder):
            set_times(t.spark, part, 1_600_000_000_000 + n * 60_000)
    return src


@query("pipe_alarm_keyed", sql=_REPLAY, fixtures=("error_log",))
def pipe_alarm_keyed(t):
    """PIPE-25 / STR-05 / STR-07: the alarm stream of ``pipe_alarm_replay``
    with its state in the state store: a presence key owns its alarms, and a
    timer recovers them when a batch comes without it."""
    from ..session import staging_path
    from ..sources.readers import read_stream
    from ..streaming import keyed
    source = read_stream(t.spark, "text", {"maxFilesPerTrigger": "1"}, path=f"{_staged_days(t)}/day=*")
    out = staging_path(t.spark, "alarm_out")
    keyed.run_keyed(keyed.alarm_rows(parse_error_log(source), THRESHOLD), out, staging_path(t.spark, "alarm_ckpt"),
                    {"availableNow": True}, replay=True).awaitTermination()
    return t.spark.read.schema(A.STATE_SCHEMA + ", batch BIGINT").parquet(out)


@query("str_late_windows", sql="""
WITH e AS (SELECT ts_ms // 1000 AS s, sv FROM error_log),
d AS (SELECT *, s - s % 86400 AS w, s <= (SELECT (min(s) + max(s)) // 2 FROM e) AND s % 7 <> 0 AS early FROM e),
m AS (SELECT max(s) FILTER (WHERE early) - 3600 AS first_mark, max(s) - 3600 AS last_mark FROM d),
x AS (SELECT *, NOT early AND w + 86400 <= first_mark AS late FROM d, m)
SELECT w AS window_start, sv, late, CAST(count(*) AS BIGINT) AS n FROM x WHERE late OR w + 86400 <= last_mark GROUP BY w, sv, late""",
       fixtures=("error_log",))
def str_late_windows(t):
    """STR-10 / STR-12: daily counts per service over two runs of one query.
    The first half of the log arrives without every seventh second; the second
    run starts from the checkpoint and gets those seconds with the other half.
    Days that the watermark had closed return them as late."""
    from ..session import staging_path
    from ..streaming import keyed
    src, out, ckpt = (staging_path(t.spark, f"late_{n}") for n in ("src", "out", "ckpt"))
    e = t["error_log"].select(F.floor(F.col("ts_ms") / 1000).cast("long").alias("s"), "sv")
    half = e.agg(F.floor((F.min("s") + F.max("s")) / 2).alias("half"))
    early = (F.col("s") <= F.col("half")) & (F.col("s") % 7 != 0)
    cut = e.crossJoin(F.broadcast(half))                       # one row
    arrive = [lambda: cut.where(early).select("s", "sv").write.parquet(f"{src}/part=0"),
              lambda: cut.where(~early).select("s", "sv").write.parquet(f"{src}/part=1")]
    rows = lambda: keyed.windowed_counts_with_late(
        t.spark.readStream.schema("s BIGINT, sv STRING").parquet(f"{src}/part=*"), "s", DAY, "1 hour", ["sv"])
    keyed.replay(arrive, rows, out, ckpt, empty_batches=True)
    done = t.spark.read.schema("window_start BIGINT, window_end BIGINT, sv STRING, n BIGINT, late BOOLEAN").parquet(out)
    return done.groupBy("window_start", "sv", "late").agg(F.sum("n").alias("n"))


PARTS, HOT = 6, 20

_PARTED = f"""SELECT {_KEY}, part, strftime(epoch_ms(min(time_stamp) * 1000), {_FMT}) AS t0, count(ip_addr) AS num,
  strftime(epoch_ms(max(time_stamp) * 1000), {_FMT}) AS t1
  FROM (SELECT *, (batch - min(batch) OVER ()) * {PARTS} // (max(batch) OVER () - min(batch) OVER () + 1) AS part FROM ({_PARSED}))
  GROUP BY {_KEY}, part"""


@query("snk_log_table", sql=f"""
WITH a AS ({_PARTED}), c AS (SELECT *, max(part) FILTER (WHERE num < {HOT}) OVER (PARTITION BY {_KEY}) AS cold FROM a)
SELECT {_KEY}, arg_min(t0, part) AS time_stamp, arg_max(num, part) AS num, 0 AS status, arg_max(t1, part) AS final_time,
  CAST(sum(num) AS BIGINT) AS total_num FROM c WHERE part > coalesce(cold, -1) GROUP BY {_KEY}""", fixtures=("error_log",))
def snk_log_table(t):
    """SNK-09 / SNK-10: the error log in six parts, each upserted into a
    log-structured table (totals add up) and followed by the deletion of keys
    that are under the threshold; folded into its bases half way."""
    from ..session import staging_path
    from ..sinks.log_table import LogTable
    p = _parsed(t).withColumn("day", F.floor(F.col("time_stamp") / DAY))
    ends = F.broadcast(p.agg(F.min("day").alias("d0"), F.max("day").alias("d1")))          # one row
    parted = p.crossJoin(ends).withColumn("part", F.floor((F.col("day") - F.col("d0")) * PARTS / (F.col("d1") - F.col("d0") + 1)))
    path = staging_path(t.spark, "log_parts")
    A.batch_aggregate(parted, extra_keys=("part",), distinct_ips=False).write.parquet(path)
    agg = t.spark.read.parquet(path).withColumn("status", F.when(F.col("num") >= HOT, 0).otherwise(3))
    table = LogTable(t.spark, staging_path(t.spark, "log_table"), t.spark.createDataFrame([], A.STATE_SCHEMA).schema,
                     A.GROUP_KEY, ["num", "status", "final_time"], {"total_num": "num"})
    for n in range(PARTS):
        table.upsert(agg.where(F.col("part") == n), batch_id=n)
        table.delete("status", [3])
        if n == PARTS // 2:
            table.compact()
    return table.read()


@query("snk_outbox", sql=_TWIN + f""",
m AS (SELECT sha256(concat_ws('|', {_KEY}, batch, status)) AS key, length({_content_sql()}) % 5 AS luck FROM twin)
SELECT key, CASE luck WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS attempts, CASE luck WHEN 0 THEN 'dead' ELSE 'delivered' END AS state FROM m""",
       fixtures=("error_log",))
def snk_outbox(t):
    """SNK-11: every alarm message put into an outbox and delivered; the
    receiver refuses some messages always (dead after three attempts) and some
    the first time."""
    import json

    from ..session import staging_path
    from ..sinks.outbox import Outbox
    tw = _twin(t)
    path = staging_path(t.spark, "messages")
    key = F.sha2(F.concat_ws("|", *A.GROUP_KEY, F.col("batch").cast("string"), F.col("status").cast("string")), 256)
    tw.select(key.alias("key"), A.message_body(tw).alias("body")).write.parquet(path)
    box = Outbox(t.spark, staging_path(t.spark, "outbox"), max_attempts=3)
    messages = t.spark.read.parquet(path)
    box.enqueue(messages, 0, key=messages["key"])

    def send(key, body, attempt):
        luck = len(json.loads(body)["markdown"]["content"]) % 5
        if luck == 0 or (luck == 1 and attempt == 1):
            raise ConnectionError("refused")

    box.deliver_all(send)
    return box.status().select("key", "attempts", "state")
