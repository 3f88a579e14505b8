"""Keyed state: restarts, replays, expiry, late rows, and what a batch writes."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from duetlog.session import staging_path
from duetlog.streaming import alarm as A
from duetlog.streaming import keyed
from duetlog.streaming.parse import parse_error_log


def _arrivals(spark, batches, schema, files=3):
    """(functions that write each batch, the streaming frame over them)."""
    src = staging_path(spark, "keyed_src")

    def arrive(n, rows):
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(f"{src}/part={n}")

    return ([lambda n=n, rows=rows: arrive(n, rows) for n, rows in enumerate(batches)],
            lambda: spark.readStream.schema(schema).parquet(f"{src}/part=*"))


def _out(spark, path):
    rows = spark.read.parquet(path).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_running_counts_over_restarts_and_state_read_back(spark):
    batches = [["a"] * 5 + ["b", None], ["a", "c"], ["b"] * 3 + [None]]
    arrive, source = _arrivals(spark, [[(k,) for k in b] for b in batches], "k string")
    out, ckpt = staging_path(spark, "out"), staging_path(spark, "ckpt")
    keyed.replay(arrive, lambda: keyed.running_counts(source(), ["k"]), out, ckpt)
    want, total = [], Counter()
    for n, b in enumerate(batches):
        for k, pv in Counter(b).items():
            total[k] += pv
            want.append((k, pv, total[k], n))
    assert _out(spark, out) == sorted(want, key=repr)
    state = {r.key.k: r.value.n for r in keyed.state_rows(spark, ckpt, "count").collect()}
    assert state == dict(total)


def test_only_touched_keys_are_written(spark):
    """1,000 keys in the state, three in the second batch."""
    arrive, source = _arrivals(spark, [[(f"k{i}",) for i in range(1000)], [("k1",), ("k2",), ("new",)]], "k string")
    out, ckpt = staging_path(spark, "out"), staging_path(spark, "ckpt")
    updated = []
    for step in arrive:
        step()
        q = keyed.run_keyed(keyed.running_counts(source(), ["k"]), out, ckpt, {"availableNow": True}, replay=True)
        q.awaitTermination()
        op = q.lastProgress.stateOperators[0]
        updated.append((op.numRowsUpdated, op.numRowsTotal))
    assert updated == [(1000, 1000), (3, 1001)]


def test_idle_key_expires(spark):
    arrive, source = _arrivals(spark, [[("a",), ("a",)], [("a",)]], "k string", files=1)
    out, ckpt = staging_path(spark, "out"), staging_path(spark, "ckpt")
    keyed.replay(arrive, lambda: keyed.running_counts(source(), ["k"], ttl_ms=1), out, ckpt)
    assert _out(spark, out) == [("a", 1, 1, 1), ("a", 2, 2, 0)]


def test_hot_key_reaches_the_state_as_a_few_rows(spark):
    rows = [("hot",)] * 20_000 + [(f"k{i}",) for i in range(10)]
    parts = keyed.partial_counts(spark.createDataFrame(rows, "k string").repartition(3), ["k"]).where("k = 'hot'").collect()
    assert sum(r.pv for r in parts) == 20_000 and len(parts) <= 6


_SERIES = {"k1": [5, 6, 0, 0], "k2": [4, 0, 0, 0], "k3": [5, 4, 0, 5], "k4": [5, 0, 5, 0], "k5": [0, 9, 2, 9]}


def _errors(counts, msg="m", start=0):
    return [(json.dumps({"sv": "s", "bn": "b", "url": u, "err_code": "E", "err_msg": msg, "@timestamp-log": 1000 * (start + i),
                         "ip_addr": "a"}),) for u, n in counts for i in range(n)]


def _stepped(spark, batches, threshold):
    """The stepwise full merge over the same batches."""
    state, rows = A.empty_state(spark), []
    for n, b in enumerate(batches):
        agg = A.batch_aggregate(parse_error_log(spark.createDataFrame(b, "value string")), distinct_ips=False)
        state = spark.createDataFrame(A.alarm_step(state, agg, threshold).collect(), A.STATE_SCHEMA)
        rows += [(*r, n) for r in map(tuple, state.collect())]
    return sorted(rows, key=repr)


def test_alarm_equals_the_full_merge(spark):
    batches = [_errors([(u, s[i]) for u, s in _SERIES.items()], start=100 * i) + _errors([("filler", 1)]) for i in range(4)]
    batches[1] += _errors([("k4", 2)], "other message", 150)      # k4 is absent, its presence key is not
    arrive, source = _arrivals(spark, batches, "value string")
    out, ckpt = staging_path(spark, "out"), staging_path(spark, "ckpt")
    keyed.replay(arrive, lambda: keyed.alarm_rows(parse_error_log(source()), 5), out, ckpt)
    got = _out(spark, out)
    assert got == _stepped(spark, batches, 5)
    assert {r[7] for r in got} == {0, 1, 2}
    left = keyed.state_rows(spark, ckpt, "alarms").select("key.*", F.col("user_map_key"), F.col("user_map_value")).collect()
    assert sorted((r.url, r.user_map_value.status) for r in left) == [("k3", 0), ("k5", 0)]


def test_alarm_crash_after_output_changes_no_state(spark):
    """The second batch fails after its rows are written; the restarted query
    repeats it from the state of the first."""
    batches = [_errors([("u", 6)]), _errors([("u", 7)], start=50), _errors([("v", 1)])]
    arrive, source = _arrivals(spark, batches, "value string")
    out, ckpt, told = staging_path(spark, "out"), staging_path(spark, "ckpt"), []

    def run(fail):
        def on_rows(df, batch_id):
            told.append((batch_id, [(r.status, r.total_num) for r in df.collect()]))
            if fail:
                raise RuntimeError("webhook down")
        keyed.run_keyed(keyed.alarm_rows(parse_error_log(source()), 5), out, ckpt, {"availableNow": True}, on_rows,
                        replay=True).awaitTermination()

    arrive[0]()
    run(False)
    arrive[1]()
    with pytest.raises(Exception, match="webhook down"):
        run(True)
    arrive[2]()
    run(False)
    assert told == [(0, [(0, 6)]), (1, [(1, 13)]), (1, [(1, 13)]), (2, [(2, 13)])]


def test_null_parts_and_missing_times(spark):
    rows = [(json.dumps({"sv": None, "url": None, "err_code": "E", "ip_addr": "a"}),)] * 6 + [("not json",)]
    arrive, source = _arrivals(spark, [rows], "value string")
    out = staging_path(spark, "out")
    keyed.replay(arrive, lambda: keyed.alarm_rows(parse_error_log(source()), 5), out, staging_path(spark, "ckpt"))
    assert [(r[2], r[3], r[5], r[6], r[7]) for r in _out(spark, out)] == [(None, "E", None, 6, 0)]


def test_late_rows_are_listed_not_lost(spark):
    """Windows of 100 s, watermark 10 s; the second run brings rows of closed
    windows, of the open one and of later ones."""
    first = [(5, "a"), (50, "a"), (120, "a"), (120, "b"), (230, "a"), (None, "a")]
    second = [(60, "a"), (199, "b"), (205, "a"), (420, "b")]
    arrive, source = _arrivals(spark, [first, second], "s long, k string")
    out, ckpt = staging_path(spark, "out"), staging_path(spark, "ckpt")
    keyed.replay(arrive, lambda: keyed.windowed_counts_with_late(source(), "s", 100, "10 seconds", ["k"]), out, ckpt,
                 empty_batches=True)
    got = sorted((r.window_start, r.k, r.n, r.late) for r in spark.read.parquet(out).collect())
    assert got == [(0, "a", 1, True), (0, "a", 2, False), (100, "a", 1, False), (100, "b", 1, False), (100, "b", 1, True),
                   (200, "a", 2, False)]
    assert [r.key.window_start for r in keyed.state_rows(spark, ckpt, "count").collect()] == [400]
