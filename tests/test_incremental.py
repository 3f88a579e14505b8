"""Bitmaps by day, the ingest ledger and co-bucketed joins."""

import random

import pytest
from pyspark.sql import functions as F

from duetlog.catalog import registry
from duetlog.operators.bitmaps import DailyBitmaps, IdDictionary
from duetlog.operators.stats import sorted_list, upper_median
from duetlog.session import list_files, set_times, staging_path
from duetlog.sinks.writers import write_bucketed
from duetlog.sources.ledger import Ledger, arriving
from duetlog.sources.readers import read_text_lines


def _days(spark, n=4000):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), f"2024-01-{rng.randrange(1, 11):02d}", rng.choice([None, -5, 0, 32_767, 32_768, rng.randrange(100_000)]))
            for _ in range(n)]
    return spark.createDataFrame(rows, "k string, d string, u long"), rows


def _want(rows, first, last):
    out = {}
    for k, d, u in rows:
        if first <= d <= last and u is not None:
            out.setdefault(k, set()).add(u)
    return {k: len(v) for k, v in out.items()}


def test_range_counts_equal_count_distinct(spark):
    df, rows = _days(spark)
    kept = DailyBitmaps(spark, staging_path(spark, "bitmaps"), ["k"], ["string"])
    kept.add(df.where("d <= '2024-01-06'"), "d", "u")
    before = {f: list_files(spark, f) for f in list_files(spark, kept.path) if "/day=" in f}
    kept.add(df.where("d > '2024-01-06'"), "d", "u")
    kept.add(df.where("d > '2024-01-06'"), "d", "u")                     # the days again
    assert all(list_files(spark, f) == files for f, files in before.items()) and len(before) == 6
    for first, last in (("2024-01-01", "2024-01-10"), ("2024-01-04", "2024-01-08"), ("2024-01-09", "2024-01-09")):
        assert {r.k: r.uv for r in kept.counts(first, last).collect()} == _want(rows, first, last)
    most = max(_want(rows, "2024-01-01", "2024-01-10").values())
    assert kept.counts(floor=most + 1).count() == 0 and kept.counts(floor=most).count() >= 1
    plan = kept.counts("2024-01-04", "2024-01-08")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_dictionary_numbers_are_dense_and_stay(spark):
    ids = IdDictionary(spark, staging_path(spark, "ids"))
    one = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "u string")
    ids.extend(one, "u")
    first = {r.id: r.number for r in ids.read().collect()}
    ids.extend(spark.createDataFrame([("c",), ("a",), ("d",)], "u string"), "u")
    ids.extend(one, "u")
    now = {r.id: r.number for r in ids.read().collect()}
    assert {k: now[k] for k in first} == first and sorted(now.values()) == [0, 1, 2, 3]
    got = ids.numbered(spark.createDataFrame([("a",), (None,), ("z",)], "u string"), "u").collect()
    assert {r.u: r.number for r in got} == {"a": now["a"], None: None, "z": None}


def _import(spark, ledger, folder, seen):
    def read(files):
        seen.append(sorted(f.rsplit("/", 1)[1] for f in files))
        return read_text_lines(spark, files, with_path=True)
    return ledger.import_new(f"{folder}/*", read)


def _put(folder, name, text):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_every_file_is_imported_once(spark):
    folder, seen = staging_path(spark, "in").removeprefix("file:"), []
    ledger = Ledger(spark, staging_path(spark, "ledger"))
    values = lambda: sorted(r.value for r in ledger.read("value STRING, file_path STRING").collect())
    assert _import(spark, ledger, folder, seen) == [] and values() == []
    _put(folder, "a", "1\n2\n"), _put(folder, "b", "3\n"), _put(folder, "_hidden", "x\n")
    _import(spark, ledger, folder, seen)
    _import(spark, ledger, folder, seen)
    _put(folder, "c", "4\n")
    _import(spark, ledger, folder, seen)
    assert seen == [["a", "b"], ["c"]] and values() == ["1", "2", "3", "4"]
    _put(folder, "a", "1\n2\n5\n")                                       # replaced under its name
    set_times(spark, f"{folder}/a", 1_900_000_000_000)
    _import(spark, ledger, folder, seen)
    assert seen[2:] == [["a"]] and values() == ["1", "2", "3", "4", "5"]


def test_a_half_finished_import_is_done_again_without_doubles(spark, monkeypatch):
    folder, seen = staging_path(spark, "in").removeprefix("file:"), []
    ledger = Ledger(spark, staging_path(spark, "ledger"))
    _put(folder, "a", "1\n"), _put(folder, "b", "2\n")
    with monkeypatch.context() as m:
        m.setattr("duetlog.sources.ledger.write_once", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            _import(spark, ledger, folder, seen)
    assert ledger.read("value STRING, file_path STRING").count() == 0
    _import(spark, ledger, folder, seen)
    assert seen == [["a", "b"]] * 2 and ledger.read("value STRING, file_path STRING").count() == 2
    assert len(arriving(spark, f"{folder}/*")) == 2


@pytest.mark.parametrize("key, exchanges", [("join_left_bucketed", 0), ("pipe_revenue_bucketed", 1), ("join_left_star", 0)])
def test_bucketed_joins_have_no_exchange(spark, key, exchanges):
    """The report's last sum over platforms is the only exchange."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry.run(key, spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange ") == exchanges and "SortMergeJoin" in plan, plan


def test_bucketed_table_has_one_file_a_bucket(spark):
    path = staging_path(spark, "buckets")
    df = write_bucketed(spark.range(1000).withColumn("k", F.col("id") % 50).repartition(5), ["k"], 8, path)
    assert df.count() == 1000 and len([f for f in list_files(spark, path) if f.endswith(".parquet")]) <= 8


def test_median_ranks_a_bracket_in_several_tasks(spark):
    df = spark.range(200_000).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 200_003).alias("v"))
    med = upper_median(df, ["g"], "v")
    want = sorted(i * 7919 % 200_003 for i in range(200_000))[100_000]
    assert med.first().median == want
    plan = med._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    # values are summed inside a range partition; the other window has one row a partition
    assert sum("windowspecdefinition(_pid" in w for w in windows) == 1 and sum("sum(_n#" in w for w in windows) == len(windows) - 1


def test_sorted_list(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("a", None), ("b", None), (None, 5)], "g string, v int")
    assert {r.g: r["values"] for r in sorted_list(df, ["g"], "v").collect()} == {"a": [1, 2, 2], "b": [], None: [5]}
