"""The log source: numbering, ranges, commits after output, crashes."""

import pytest
from pyspark.sql import functions as F

from duetlog.session import staging_path
from duetlog.sources.partitioned_log import LogFolder, append_log, read_log, stream_log


def _append(spark, path, values, partitions=3, first=0):
    rows = [(first + i, v) for i, v in enumerate(values)]
    append_log(spark.createDataFrame(rows, "i long, v string"), path, F.col("i") % partitions, ["i"], F.col("v"))


def _run(stream, out, ckpt, fail_at=None, seen=None):
    def write(df, batch_id):
        rows = sorted(map(tuple, df.collect()))
        (seen if seen is not None else []).append((batch_id, rows))
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if batch_id == fail_at:
            raise RuntimeError("lost after output")
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def _want(values, partitions=3):
    return sorted((i % partitions, i // partitions, v) for i, v in enumerate(values))


def test_batch_read_numbers_each_partition_from_zero(spark):
    path, values = staging_path(spark, "log"), [f"v{i}" if i % 5 else None for i in range(1000)]
    _append(spark, path, values[:600])
    _append(spark, path, values[600:], first=600)
    assert sorted(map(tuple, read_log(spark, path).collect()), key=repr) == sorted(_want([*values]), key=repr)
    assert LogFolder(path).ends() == {0: 334, 1: 333, 2: 333}


def test_a_crash_between_output_and_commit_repeats_that_range(spark):
    path, out, ckpt, seen = (*(staging_path(spark, n) for n in ("log", "out", "ckpt")), [])
    values = [f"v{i}" for i in range(90)]
    _append(spark, path, values[:30])
    _run(stream_log(spark, path, "g"), out, ckpt, seen=seen)
    _append(spark, path, values[30:60], first=30)
    with pytest.raises(Exception, match="lost after output"):
        _run(stream_log(spark, path, "g"), out, ckpt, fail_at=1, seen=seen)
    assert LogFolder(path).stored("g") == {0: 10, 1: 10, 2: 10}       # the first batch only
    _append(spark, path, values[60:], first=60)
    _run(stream_log(spark, path, "g"), out, ckpt, seen=seen)          # the lost batch again, nothing else
    _run(stream_log(spark, path, "g"), out, ckpt, seen=seen)
    assert [b for b, _ in seen] == [0, 1, 1, 2]
    assert seen[1][1] == seen[2][1] == [x for x in _want(values[:60]) if x not in _want(values[:30])]
    assert sorted(r for b, rows in [seen[0], *seen[2:]] for r in rows) == _want(values)
    assert sorted(map(tuple, spark.read.parquet(out).drop("batch").collect())) == _want(values)


def test_a_new_query_goes_on_where_the_group_stopped(spark):
    path, seen = staging_path(spark, "log"), []
    values = [f"v{i}" for i in range(60)]
    _append(spark, path, values[:30])
    ckpt = staging_path(spark, "ckpt")
    _run(stream_log(spark, path, "g"), staging_path(spark, "out"), ckpt)
    _append(spark, path, values[30:], first=30)
    _run(stream_log(spark, path, "g"), staging_path(spark, "out"), ckpt)   # commits the first range, then dies
    _run(stream_log(spark, path, "g"), staging_path(spark, "out"), staging_path(spark, "other"), seen=seen)
    assert [r for _, rows in seen for r in rows] == [x for x in _want(values) if x not in _want(values[:30])]
    fresh = []
    _run(stream_log(spark, path, "h"), staging_path(spark, "out"), staging_path(spark, "third"), seen=fresh)
    assert [r for _, rows in fresh for r in rows] == _want(values)         # another group starts at the beginning


def test_bounded_batches_cover_everything_once(spark):
    path, out, seen = staging_path(spark, "log"), staging_path(spark, "out"), []
    values = [f"v{i}" for i in range(100)]
    _append(spark, path, values)
    ckpt = staging_path(spark, "ckpt")
    for _ in range(4):                                 # one bounded batch a run
        _run(stream_log(spark, path, "g", maxOffsetsPerPartition=10), out, ckpt, seen=seen)
    assert [len(rows) for _, rows in seen] == [30, 30, 30, 10]
    assert sorted(r for _, rows in seen for r in rows) == _want(values)


def test_an_unfinished_append_is_not_read_past_its_gap(spark):
    path = staging_path(spark, "log")
    _append(spark, path, [f"v{i}" for i in range(10)], partitions=1)
    gap = spark.createDataFrame([(0, 20, "too early")], "partition int, offset long, value string")
    gap.write.mode("append").partitionBy("partition").parquet(f"{path}/records")
    assert LogFolder(path).ends() == {0: 10}
    assert read_log(spark, path).count() == 10


def test_a_range_reads_only_its_blocks(spark):
    from duetlog.sources import partitioned_log as P
    path = staging_path(spark, "log")
    for k in range(4):
        _append(spark, path, [f"v{i}" for i in range(20)], partitions=1, first=20 * k)
    parts = P._ranges(LogFolder(path), {0: 25}, {0: 45})
    assert [(p.low, p.high) for p in parts] == [(25, 40), (40, 45)]


def test_empty_log(spark):
    path = staging_path(spark, "log")
    assert read_log(spark, path).count() == 0 and LogFolder(path).stored("g") is None
