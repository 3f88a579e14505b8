"""The keyed table against a dictionary, and which files a compaction leaves."""

import random

import pytest
from pyspark.sql import functions as F

from duetlog.session import list_files, staging_path
from duetlog.sinks.log_table import LogTable
from duetlog.sinks.writers import upsert_accumulate

SCHEMA = "a string, b int, first string, num long, status int, total long"


def _table(spark, buckets=8):
    schema = spark.createDataFrame([], SCHEMA).schema
    return LogTable(spark, staging_path(spark, "log_table"), schema, ["a", "b"], ["num", "status"], {"total": "num"}, buckets)


def _batch(spark, rows):
    return spark.createDataFrame(rows, "a string, b int, first string, num long, status int")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


class _Plain:
    def __init__(self):
        self.rows = {}

    def upsert(self, batch):
        for a, b, first, num, status in batch:
            old = self.rows.get((a, b))
            self.rows[a, b] = (first, num, status, num) if old is None else (old[0] if old[0] is not None else first, num, status, old[3] + num)

    def delete(self, values):
        self.rows = {k: v for k, v in self.rows.items() if v[2] not in values}

    def all(self):
        return sorted(((*k, *v) for k, v in self.rows.items()), key=repr)


def test_random_history_equals_a_dictionary(spark):
    rng, plain, t = random.Random(7), _Plain(), _table(spark)
    for step in range(12):
        kind = rng.choice(["upsert", "upsert", "delete", "compact"])
        if kind == "upsert":
            keys = rng.sample([(f"k{i}", i % 3) for i in range(40)], rng.randrange(0, 15))
            batch = [(a, b, rng.choice([None, f"s{step}"]), rng.randrange(9), rng.randrange(4)) for a, b in keys]
            t.upsert(_batch(spark, batch))
            plain.upsert(batch)
        elif kind == "delete":
            t.delete("status", [2, 3])
            plain.delete({2, 3})
        else:
            t.compact()
        if step % 3 == 2:
            assert _rows(t.read()) == plain.all()
    t.compact()
    assert _rows(t.read()) == plain.all() and t.state()["deltas"] == t.state()["tombstones"] == []


def test_equals_the_full_outer_join(spark):
    one = [(f"k{i}", 0, "x", i, 1) for i in range(50)] + [(None, 1, "n", 5, 1)]
    two = [(f"k{i}", 0, "y", 100, 0) for i in range(25, 75)] + [(None, 1, "n", 6, 1)]
    t = _table(spark)
    t.upsert(_batch(spark, one)), t.upsert(_batch(spark, two))
    state = _batch(spark, one).withColumn("total", F.col("num"))
    want = upsert_accumulate(state, _batch(spark, two), ["a", "b"], ["num", "status"], {"total": "num"})
    assert _rows(t.read()) == _rows(want)
    t.compact()
    assert _rows(t.read()) == _rows(want)          # rows with a null key stay apart


def _files(spark, t):
    """Base files by bucket."""
    return {int(b): [f for f in list_files(spark, f"{t.path}/base/{n:012d}/_bucket={b}") if not f.rsplit("/", 1)[1][0] in "._"]
            for b, n in t.state()["base"].items()}


def test_untouched_buckets_keep_their_files(spark):
    t = _table(spark, buckets=16)
    t.upsert(_batch(spark, [(f"k{i}", 0, "x", 1, 1) for i in range(300)]))
    assert len(t.compact()) == 16
    before = _files(spark, t)
    t.upsert(_batch(spark, [("k1", 0, "y", 5, 1), ("k2", 0, "y", 5, 1)]))
    touched = t.compact()
    after = _files(spark, t)
    assert 1 <= len(touched) <= 2
    assert {b for b in before if before[b] != after[b]} == set(touched)
    t.delete("status", [7])                        # nothing has it: no file changes
    assert t.compact() == [] and _files(spark, t) == after and t.read().count() == 300
    t.upsert(_batch(spark, [("k3", 0, "y", 5, 7)])), t.compact()
    middle = _files(spark, t)
    t.delete("status", [7])
    assert t.read().count() == 299
    assert len(t.compact()) == 1 and t.read().count() == 299
    assert sum(middle[b] != f for b, f in _files(spark, t).items()) <= 1


def test_an_upsert_reads_nothing_and_a_batch_counts_once(spark):
    t = _table(spark)
    t.upsert(_batch(spark, [("k", 0, "x", 4, 1)]), batch_id=0)
    t.upsert(_batch(spark, [("k", 0, "x", 5, 1)]), batch_id=1)
    t.upsert(_batch(spark, [("k", 0, "x", 5, 1)]), batch_id=1)       # the batch again
    t.upsert(_batch(spark, [("k", 0, "x", 4, 1)]), batch_id=0)
    assert _rows(t.read()) == [("k", 0, "x", 5, 1, 9)]
    assert t.version() == 2 and _rows(t.read(1)) == [("k", 0, "x", 4, 1, 4)]


def test_a_write_that_dies_before_its_version_does_not_count(spark, monkeypatch):
    t = _table(spark)
    t.upsert(_batch(spark, [("k", 0, "x", 4, 1)]))
    with monkeypatch.context() as m:
        m.setattr(t, "_commit", lambda state: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.upsert(_batch(spark, [("other", 0, "x", 4, 1)]))
        with pytest.raises(RuntimeError):
            t.compact()
    assert _rows(t.read()) == [("k", 0, "x", 4, 1, 4)]
    t.upsert(_batch(spark, [("k", 0, "x", 6, 1)]))
    assert _rows(t.read()) == [("k", 0, "x", 6, 1, 10)]


def test_two_writers_of_one_version(spark):
    t = _table(spark)
    t.upsert(_batch(spark, [("k", 0, "x", 4, 1)]))
    old = t.state()
    t.delete("status", [9])
    with pytest.raises(FileExistsError):
        t._commit(old)


def test_vacuum_keeps_what_the_last_versions_name(spark):
    t = _table(spark)
    for i in range(6):
        t.upsert(_batch(spark, [("k", 0, "x", i, 1)]))
        if i % 2:
            t.compact()
    want = _rows(t.read())
    t.vacuum(keep=2)
    assert _rows(t.read()) == want == [("k", 0, "x", 5, 1, 15)]
    assert len(list_files(spark, f"{t.path}/base")) + len(list_files(spark, f"{t.path}/delta")) <= 4


def test_empty_table(spark):
    t = _table(spark)
    assert t.read().count() == 0 and t.compact() == []
    t.upsert(_batch(spark, []))
    assert t.read().count() == 0
