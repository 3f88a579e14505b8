"""Break tests: where the studied jobs fail or misbehave, our documented
behaviour (SURVEY §2.13, B5-B9)."""

from pyspark.sql import functions as F

from duetlog.plans import logs as L
from duetlog.session import staging_path
from duetlog.sinks.writers import write_text
from duetlog.sources.readers import read_text_lines


def test_b5_wide_source_projected_before_union(spark, tables001):
    """The farm source kept all its columns and could not be unioned with
    two-column inputs; every source is projected to two columns first."""
    a = tables001["app_log"]
    srcs = {n: a.where(F.col("source_no") == i) for i, n in enumerate(("tree", "farm", "house", "qqmp", "wxmp", "app"))}
    srcs["wxmp"] = srcs["wxmp"].withColumnRenamed("user_id", "open_id")
    out = L.active_pairs(srcs, 1_800_000_000_000, (0, 1_800_000_000_000))
    assert out.columns == ["space_id", "user_id"] and out.count() > 0


def test_b6_text_sink_joins_columns(spark, tables001):
    """A text write of two columns failed; ours joins them into one line."""
    p = staging_path(spark, "b6")
    write_text(tables001["space_user_list"], p)
    rows = read_text_lines(spark, p).collect()
    assert rows and all(len(r.value.split(" ")) == 2 for r in rows)


def test_b7_count_column_is_named(spark, tables001):
    """``count().alias(...)`` named the frame; our count column is ``ip_num_cnt``."""
    assert "ip_num_cnt" in L.log_ip_counts(tables001["mic_log"]).columns


def test_b9_each_file_read_once(spark, tables001):
    """The file lister took one row per input split, so a file could be
    imported several times; one scan reads every line exactly once."""
    p = staging_path(spark, "b9")
    write_text(tables001["daily_log"], p, partition_by="log_name")
    lines = read_text_lines(spark, f"{p}/*/*", with_path=True)
    got = L.users_by_file_date(lines)
    assert got.count() == tables001["daily_log"].count()
    assert got.where(F.col("c_date") == "").count() == 0


def test_space_user_tsv_round_trip(spark, tables001):
    """SRC-04, second layout: ``space_id<TAB>user_id`` lines read as longs;
    a junk field becomes null instead of failing the task."""
    from duetlog.sources.readers import read_space_user_tsv
    src = tables001["space_user_list"]
    p = staging_path(spark, "space_user_tsv")
    lines = src.select(F.concat_ws("\t", "space_id", "user_id").alias("value"))
    lines.union(spark.createDataFrame([("x\t1",)], "value string")).write.text(p)
    got = read_space_user_tsv(spark, p)
    assert sorted(map(tuple, got.where(F.col("space_id").isNotNull()).collect())) == sorted(map(tuple, src.collect()))
    assert got.where(F.col("space_id").isNull()).count() == 1
