"""Sorted results arrive sorted (the oracle compares rows without order)."""

import pytest

from duetlog.catalog import registry
from duetlog.sources.readers import read_guide_tsv, read_user_ip_csv
from duetlog.session import staging_path

SF = "/root/testdata/sf0.01"


def _descending(v):
    """A text as a key that sorts the other way round."""
    return tuple(-ord(c) for c in v) + (1,)


KEYS = {
    "srt_mixed": lambda r: (r["el"], r["dim"], _descending(r["date"])),
    "srt_single": lambda r: r["o_totalprice"],
    "limit_preview": lambda r: (-r["o_totalprice"], r["o_orderkey"]),
    "pipe_resort_report": lambda r: (r["el"], r["dim"], _descending(r["date"])),
    "pipe_city_active_new": lambda r: (-r["act_number"], -r["new_number"], r["city"]),
    "pipe_cohort_stats": lambda r: r["love_days"],
}


@pytest.mark.parametrize("key", sorted(KEYS))
def test_rows_arrive_in_order(spark, key):
    registry.load_all()
    got = [KEYS[key](r) for r in registry.run(key, spark, SF).collect()]
    assert len(got) > 5 and got == sorted(got)


def test_event_list_in_time_order(spark):
    """SRT-03 / PIPE-19: the list of one type is sorted by its quoted column."""
    registry.load_all()
    df = registry.run("sql_events_by_type", spark, SF)
    times = [c for c in df.columns if dict(df.dtypes)[c].startswith("timestamp")][0]
    got = [r[times] for r in df.collect()]
    assert len(got) > 10 and got == sorted(got)


def test_quotes_are_characters(spark):
    """SRC-02/04: a quote does not join fields or swallow separators."""
    p = staging_path(spark, "quotes")
    spark.createDataFrame([('2021-01-01\t"open\tel1\t3',), ('2021-01-02\ta"b"\t"\t4',)], "value string").write.text(p)
    got = sorted(map(tuple, read_guide_tsv(spark, p).collect()))
    assert got == [("2021-01-01", '"open', "el1", "3"), ("2021-01-02", 'a"b"', '"', "4")]
    p = staging_path(spark, "quotes_csv")
    spark.createDataFrame([('"u,1.2.3.4.',), ("v,0.0.1.0",)], "value string").write.text(p)
    assert sorted(map(tuple, read_user_ip_csv(spark, p).collect())) == [('"u', 0x01020304), ("v", 256)]


def test_machine_local_folder_only_on_a_local_master(spark, monkeypatch):
    from duetlog import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
