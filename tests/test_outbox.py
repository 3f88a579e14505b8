"""Delivery: once by key, retries, dead letters, lost workers."""

import glob
import json
import os
import uuid

from duetlog.session import staging_path
from duetlog.sinks.outbox import Outbox


def _sender(folder, fails):
    """A receiver's mailbox: one file a call; ``fails(key, attempt)`` raises."""
    def send(key, body, attempt):
        if fails(key, attempt):
            raise ConnectionError(f"no answer to {key}")
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            json.dump([key, body, attempt], f)
    return send


def _mail(folder):
    return sorted(json.load(open(f)) for f in glob.glob(f"{folder}/*"))


def test_each_message_ends_delivered_once_or_dead(spark):
    box = Outbox(spark, staging_path(spark, "outbox"), max_attempts=3)
    rows = [(f"m{i}", f"text {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "id string, body string").repartition(3)
    box.enqueue(df, 0, key=df["id"])
    box.enqueue(df, 0, key=df["id"])                                   # the batch again
    box.enqueue(df.where("id = 'm1'"), 1, key=df["id"])                # a message again in a later batch
    folder = staging_path(spark, "mail").removeprefix("file:")
    end = box.deliver_all(_sender(folder, lambda k, n: k.endswith("3") or (k.endswith("7") and n < 3)))
    assert end == {"delivered": 36, "dead": 4}
    assert [m[0] for m in _mail(folder)] == sorted(k for k, _ in rows if not k.endswith("3"))
    assert {m[0]: m[2] for m in _mail(folder) if m[2] > 1} == {k: 3 for k in ("m7", "m17", "m27", "m37")}
    dead = {r.key: (r.attempts, r.error) for r in box.dead_letters().collect()}
    assert dead == {k: (3, f"ConnectionError: no answer to {k}") for k in ("m3", "m13", "m23", "m33")}
    assert box.deliver_all(_sender(folder, lambda k, n: False)) == end and len(_mail(folder)) == 36


def test_attempts_lost_with_their_writer_go_out_again_under_the_same_key(spark, monkeypatch):
    box = Outbox(spark, staging_path(spark, "outbox"))
    box.enqueue(spark.createDataFrame([("a",), ("b",), (None,)], "body string"), 0)
    folder = staging_path(spark, "mail").removeprefix("file:")
    send = _sender(folder, lambda k, n: False)
    for k, body in [(r.key, r.body) for r in box.messages().collect()]:
        send(k, body, 1)                                               # sent, but no attempt was written
    assert box.deliver_all(send) == {"delivered": 2}
    mail = _mail(folder)
    assert len(mail) == 4 and len({m[0] for m in mail}) == 2


def test_empty_outbox(spark):
    box = Outbox(spark, staging_path(spark, "outbox"))
    assert box.deliver_all(lambda *a: None) == {} and box.dead_letters().count() == 0
