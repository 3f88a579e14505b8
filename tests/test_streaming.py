"""Streaming runs equal their batch twins."""

import pytest
from pyspark.sql import functions as F

from duetlog.session import staging_path
from duetlog.streaming import alarm as A
from duetlog.streaming.parse import parse_error_log
from duetlog.streaming.windows import running_counts

T = 5


def _json(t):
    return t["error_log"].select(
        F.to_json(F.struct("sv", "bn", "url", "err_code", "err_msg", F.col("ts_ms").alias("@timestamp-log"),
                           "ip_addr")).alias("value"), (F.col("ts_ms") / 1000 / 86400).cast("long").alias("day"))


def _twin(t):
    p = parse_error_log(_json(t)).withColumn("batch", F.floor(F.col("time_stamp") / 86400))
    agg = A.batch_aggregate(p, extra_keys=("batch",)).drop("ip_num")
    tw = A.alarm_status_batch(agg, T, key=A.GROUP_KEY)
    first = agg.agg(F.min("batch")).first()[0]
    return tw.withColumn("batch", F.col("batch") - first)


def _state_rows(spark, base):
    df = spark.read.parquet(base)
    cols = [*A.GROUP_KEY, "batch", "time_stamp", "num", "status", "final_time", "total_num"]
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_alarm_closed_form_small(spark):
    """FIXTURES.md part C: counts 5,6,0 -> 0,1,2; 4 -> none; 5,4 -> 0,2;
    5,0,5 -> 0,2,0 with the total restarted.  Twin and stepwise merge agree."""
    series = {"k1": [5, 6, 0], "k2": [4, 0, 0], "k3": [5, 4, 0], "k4": [5, 0, 5]}
    rows = [(k, "b", "u", "e", "m", b, f"t{b}", n, f"f{b}") for k, ns in series.items()
            for b, n in enumerate(ns) if n]
    agg = spark.createDataFrame(rows, "sv string, bn string, url string, err_code string, err_msg string, "
                                      "batch long, time_stamp string, num long, final_time string")
    got = {(r["sv"], r["batch"]): (r["status"], r["num"], r["total_num"], r["time_stamp"])
           for r in A.alarm_status_batch(agg, 5).collect()}
    want = {("k1", 0): (0, 5, 5, "t0"), ("k1", 1): (1, 6, 11, "t0"), ("k1", 2): (2, 0, 11, "t0"),
            ("k3", 0): (0, 5, 5, "t0"), ("k3", 1): (2, 4, 9, "t0"),
            ("k4", 0): (0, 5, 5, "t0"), ("k4", 1): (2, 0, 5, "t0"), ("k4", 2): (0, 5, 5, "t2")}
    assert got == want
    state = A.empty_state(spark)
    stepped = {}
    for b in range(3):
        state = A.alarm_step(state, agg.where(F.col("batch") == b), 5, presence=A.GROUP_KEY)
        state = spark.createDataFrame(state.collect(), A.STATE_SCHEMA)      # tiny: keep plans flat
        for r in state.collect():
            stepped[(r["sv"], b)] = (r["status"], r["num"], r["total_num"], r["time_stamp"])
    assert stepped == want


def test_alarm_foreach_batch_equals_twin(spark, tables01):
    t = tables01
    twin = sorted(map(tuple, _twin(t).select(*A.GROUP_KEY, "batch", "time_stamp", "num", "status", "final_time",
                                              "total_num").collect()), key=repr)
    base = staging_path(spark, "alarm_state")
    handler = A.AlarmStateTable(base, T, presence=A.GROUP_KEY, keep_versions=None)
    src = _json(t)
    days = [r[0] for r in src.select("day").distinct().orderBy("day").collect()]
    for i, d in enumerate(days):
        handler(src.where(F.col("day") == d).select("value"), i)
    handler(src.where(F.col("day") == days[0]).select("value"), 0)      # replay of batch 0: no-op
    assert _state_rows(spark, base) == twin
    assert len(twin) == 1239


def test_alarm_stream_replay_equals_twin(spark, tables001):
    t = tables001
    twin = sorted(map(tuple, _twin(t).select(*A.GROUP_KEY, "batch", "time_stamp", "num", "status", "final_time",
                                              "total_num").collect()), key=repr)
    src = staging_path(spark, "alarm_src")
    js = _json(t)
    days = [r[0] for r in js.select("day").distinct().orderBy("day").collect()]
    for i, d in enumerate(days):         # one file per day, written in day order
        js.where(F.col("day") == d).select("value").coalesce(1).write.text(f"{src}/d{i:03d}")
    base = staging_path(spark, "alarm_stream_state")
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{src}/*")
    q = A.run_alarm_stream(stream, A.AlarmStateTable(base, T, presence=A.GROUP_KEY, keep_versions=None),
                           staging_path(spark, "alarm_ckpt"), trigger={"availableNow": True})
    q.awaitTermination(600)
    assert _state_rows(spark, base) == twin


def test_running_counts_update_mode(spark, tables001):
    ev = tables001["events"]
    src = staging_path(spark, "events_src")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    sink = staging_path(spark, "pv_sink")
    seen = {}

    def keep_last(batch_df, batch_id):
        for r in batch_df.collect():          # tiny test sink
            seen[(r["date"], r["hour"])] = r["pv"]

    q = (running_counts(stream).writeStream.outputMode("update").foreachBatch(keep_last)
         .option("checkpointLocation", sink).trigger(availableNow=True).start())
    q.awaitTermination(600)
    want = {(r["date"], r["hour"]): r["pv"] for r in running_counts(ev).collect()}
    assert seen == want


def test_event_routing_stream_equals_batch(spark, tables001):
    """STR-03 on a real stream of JSON text files equals the batch form."""
    from duetlog.streaming.parse import route_events
    js = tables001["event_route"].select(F.to_json(F.struct("sv", "bn", "el", "time")).alias("value"))
    src = staging_path(spark, "route_src")
    js.write.text(src)
    got = []
    q = (route_events(spark.readStream.format("text").load(src)).writeStream
         .foreachBatch(lambda df, _bid: got.extend(map(tuple, df.collect())))
         .option("checkpointLocation", staging_path(spark, "route_ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    want = sorted(map(tuple, route_events(js).collect()))
    assert sorted(got) == want and len(want) > 0


def test_alarm_message_body(spark):
    """STR-08 / SNK-11: the webhook body is ``{"msgtype":"markdown",
    "markdown":{"content":...}}`` with the status template filled in."""
    rows = [("farm", "api", "/p/1", "E1", "timeout", "t0", 7, 0, "f0", 7),
            ("pet", "api", "/p/2", "E2", "timeout", "t0", 0, 2, "f1", 12),
            ("x", "api", "/p/3", "E3", "m", "t0", 1, 9, "f2", 1)]
    st = spark.createDataFrame(rows, A.STATE_SCHEMA)
    msgs = {r["sv"]: r for r in A.alarm_messages(st).collect()}
    import json
    body = json.loads(msgs["farm"]["body"])
    assert body["msgtype"] == "markdown" and body["markdown"]["content"] == msgs["farm"]["content"]
    assert "农场" in body["markdown"]["content"] and ">当前报错次数：<font color=\"warning\">7</font>" in body["markdown"]["content"]
    assert "情侣宝宝" in msgs["pet"]["content"] and "总报错次数：<font color=\"info\">12</font>" in msgs["pet"]["content"]
    assert msgs["x"]["content"] == "未知状态"


def test_alarm_presence_key_differs_from_group_key(spark):
    """Rule 3 looks only at (url, err_code): another message for the same
    url and code keeps an alarm unchanged; absence recovers it; the next
    batch deletes the recovered row."""
    schema = ("sv string, bn string, url string, err_code string, err_msg string, time_stamp string, "
              "num long, final_time string")
    batches = [
        [("s", "b", "u1", "E1", "m1", "t0", 6, "f0")],
        [("s", "b", "u1", "E1", "m2", "t1", 2, "f1")],
        [("s", "b", "u2", "E2", "m1", "t2", 1, "f2")],
        [("s", "b", "u3", "E3", "m1", "t3", 1, "f3")],
    ]
    state = A.empty_state(spark)
    seen = []
    for rows in batches:
        state = A.alarm_step(state, spark.createDataFrame(rows, schema), 5)
        state = spark.createDataFrame(state.collect(), A.STATE_SCHEMA)
        seen.append(sorted((r["err_msg"], r["status"], r["num"], r["total_num"], r["final_time"])
                           for r in state.collect()))
    assert seen == [[("m1", 0, 6, 6, "f0")], [("m1", 0, 6, 6, "f0")], [("m1", 2, 0, 6, "f0")], []]


def _errors(spark, n, url="u1"):
    import json
    rows = [(json.dumps({"sv": "s", "bn": "b", "url": url, "err_code": "E", "err_msg": "m",
                         "@timestamp-log": 1000 * i, "ip_addr": "a"}),) for i in range(n)]
    return spark.createDataFrame(rows, "value string")


def test_alarm_crash_in_delivery_is_delivered_on_replay(spark):
    """A version committed before a failed delivery is delivered when the
    batch comes again, by another process too; the state does not change."""
    base, sent, fail = staging_path(spark, "alarm_crash"), [], [True]

    def on_state(state, batch_id):
        if fail[0]:
            raise RuntimeError("webhook down")
        sent.append((batch_id, [(r["status"], r["total_num"]) for r in state.collect()]))

    first = A.AlarmStateTable(base, 5, on_state=on_state)
    with pytest.raises(RuntimeError, match="webhook down"):
        first(_errors(spark, 6), 0)
    assert first.committed(spark, 0) and sent == []
    fail[0] = False
    again = A.AlarmStateTable(base, 5, on_state=on_state)
    again(_errors(spark, 6), 0)
    again(_errors(spark, 6), 0)                      # delivered already: nothing more
    again(_errors(spark, 7), 1)
    assert sent == [(0, [(0, 6)]), (1, [(1, 13)])]


def test_alarm_missing_version_raises(spark):
    handler = A.AlarmStateTable(staging_path(spark, "alarm_gap"), 5)
    handler(_errors(spark, 6), 0)
    handler(_errors(spark, 6), 1)
    with pytest.raises(RuntimeError, match="version 2 is missing"):
        handler(_errors(spark, 6), 3)


def test_alarm_old_versions_are_pruned(spark):
    handler = A.AlarmStateTable(staging_path(spark, "alarm_prune"), 5, keep_versions=2)
    for i in range(5):
        handler(_errors(spark, 6), i)
    assert [handler.committed(spark, i) for i in range(5)] == [False, False, False, True, True]
    assert handler.read(spark, 4).first()["total_num"] == 30


def test_alarm_messages_reach_a_sender(spark):
    """SNK-11: the state's messages go to the sender on the executors."""
    import glob
    out = staging_path(spark, "sent").removeprefix("file:")

    def send(rows):
        import os
        import uuid
        bodies = [r["body"] for r in rows]
        if bodies:
            os.makedirs(out, exist_ok=True)
            with open(f"{out}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(bodies))

    A.AlarmStateTable(staging_path(spark, "alarm_send"), 5, on_state=A.deliver_messages(send))(_errors(spark, 6), 0)
    bodies = [line for f in glob.glob(f"{out}/*") for line in open(f)]
    assert len(bodies) == 1 and '"msgtype":"markdown"' in bodies[0]
