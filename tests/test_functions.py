"""Boundary tables for the column functions (FIXTURES.md part C)."""

from pyspark.sql import functions as F

from duetlog.functions import columns as C
from duetlog.operators.joins import ip_range_join
from duetlog.operators.stats import upper_median


def _one(spark, expr_fn, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr_fn(df)).collect()]


def test_bucket_floor(spark):
    rows = [(0, 5), (4, 5), (5, 5), (1095, 20), (-3, 5), (7, 1), (None, 5)]
    got = _one(spark, lambda d: C.bucket_floor("x", F.col("s")), rows, "x int, s int")
    assert got == [0, 0, 5, 1080, -5, 0, None]


def test_user_type(spark):
    rows = [(365, 9), (366, 365), (366, 366), (None, 1)]
    got = _one(spark, lambda d: C.user_type("d", "a"), rows, "d int, a int")
    assert got == ["new", "old", "0", None]


def test_love_days_type(spark):
    got = _one(spark, lambda d: C.love_days_type("d"), [(30,), (31,), (None,)], "d int")
    assert got == ["30days-", "30days+", None]


def test_age_at(spark):
    rows = [("1990-04-15",), ("1990-04-16",), ("1990-04-14",), ("1990-05-01",), ("NULL",), ("junk",)]
    got = _one(spark, lambda d: C.age_at(F.col("b"), "2021-04-15"), rows, "b string")
    assert got == [31, 30, 31, 30, -1, None]


def test_country_pair(spark):
    rows = [("中国", "美国"), ("美国", "中国"), ("中国", "中国"), ("英国", "中国"), (None, "中国")]
    got = _one(spark, lambda d: C.country_pair_type("a", "b"), rows, "a string, b string")
    assert got == ["中美", "中美", "other", "中英", "other"]


def test_same_country(spark):
    rows = [("x", "x"), ("x", "y"), (None, None), ("x", None)]
    got = _one(spark, lambda d: C.same_country_type("a", "b"), rows, "a string, b string")
    assert got == ["同国", "异国", "同国", "异国"]


def test_ip_to_long_and_back(spark):
    rows = [("0.0.0.0",), ("220.248.12.158",), ("255.255.255.255",), ("1.2.x.4",)]
    got = _one(spark, lambda d: C.ip_to_long("ip"), rows, "ip string")
    assert got == [0, 3707243678, 4294967295, None]
    assert _one(spark, lambda d: C.ip_to_long("ip"), [("1.2.3",), ("1.2.3.4.5",)], "ip string") == [66051, 4328719365]
    back = _one(spark, lambda d: C.long_to_ip(C.ip_to_long("ip")), rows[:3], "ip string")
    assert back == [r[0] for r in rows[:3]]


def test_split_get_java_trailing(spark):
    rows = [("a b c  ",), ("a",), ("",)]
    got = _one(spark, lambda d: C.field_count("v", " "), rows, "v string")
    assert got == [3, 1, 1]
    assert _one(spark, lambda d: C.split_get("v", " ", 2), rows, "v string") == ["c", None, None]


def test_java_trim(spark):
    got = _one(spark, lambda d: C.trim_reverse_upper("v"), [("\t ab c\n ",)], "v string")
    assert got == ["C BA"]


def test_ts_text_to_millis_ignores_fraction(spark):
    rows = [("1970-01-01 00:00:01.659",), ("2021-04-15 10:00:00",)]
    got = _one(spark, lambda d: C.ts_text_to_millis("t"), rows, "t string")
    assert got == [1000, 1618480800000]
    got = _one(spark, lambda d: C.ts_text_to_millis("t", keep_fraction=True), rows[:1], "t string")
    assert got == [1659]


def test_epoch_seconds_to_text(spark):
    got = _one(spark, lambda d: C.epoch_seconds_to_text("s"), [(0,), (1618480800,)], "s bigint")
    assert got == ["1970-01-01 00:00:00", "2021-04-15 10:00:00"]


def test_upper_median(spark):
    groups = {1: [1], 2: [1, 2], 3: [1, 2, 3], 4: [1, 2, 3, 4], 5: [8, 9, 10, 11], 6: [5, 5, 5, 1]}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [(7, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: r["median"] for r in upper_median(df, ["g"], "v").collect()}
    assert got == {1: 1.0, 2: 2.0, 3: 2.0, 4: 3.0, 5: 10.0, 6: 5.0}


def test_interval_lookup_edges(spark):
    dim = spark.createDataFrame([(10, 20, "A"), (30, 40, "B"), (41, 1_000_000, "C")], "lo long, hi long, r string")
    pts = spark.createDataFrame([(1, 10), (2, 20), (3, 21), (4, 5), (5, 40), (6, 999_999), (7, None)],
                                "id int, ip long")
    for kw in ({}, {"max_broadcast_bytes": 0}, {"max_broadcast_bytes": 0, "salt": 1}, {"bits": 4}):
        got = {r["id"]: r["r"] for r in ip_range_join(pts, dim, "ip", **kw).collect()}
        assert got == {1: "A", 2: "A", 3: None, 4: None, 5: "B", 6: "C", 7: None}, kw


def test_sql_functions_equal_column_functions(spark):
    from duetlog.functions.sql_functions import register
    register(spark)
    rows = [(-3, 5, 366, 365, "1990-04-16", "中国", "美国", "220.248.12.158"),
            (None, 5, 365, 9, "NULL", "美国", "美国", "1.2.x.4"), (7, 1, 366, 366, "1990-04-14", None, None, "0.0.0.0")]
    df = spark.createDataFrame(rows, "x int, s int, d int, a int, b string, c1 string, c2 string, ip string")
    df.createOrReplaceTempView("fn_rows")
    got = spark.sql("""SELECT bucket_floor(x, s), user_type(d, a), love_days_type(d), age_at(b),
                              country_pair_type(c1, c2), same_country_type(c1, c2), ip_to_long(ip) FROM fn_rows""").collect()
    want = df.select(C.bucket_floor("x", F.col("s")), C.user_type("d", "a"), C.love_days_type("d"),
                     C.age_at(F.col("b")), C.country_pair_type("c1", "c2"), C.same_country_type("c1", "c2"),
                     C.ip_to_long("ip")).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_upper_median_two_level_random(spark, monkeypatch):
    """Coarse buckets + one ranked bucket equals the sorted-list element,
    including a hot group, repeated values, decimals and few buckets."""
    import random
    from duetlog.operators import stats
    rnd = random.Random(7)
    rows = [(0, float(rnd.randint(0, 50))) for _ in range(3000)]           # hot group, many ties
    rows += [(g, float(rnd.gauss(0, 10 ** g))) for g in range(1, 6) for _ in range(rnd.randint(1, 40))]
    rows += [(9, 5.0)] * 4
    df = spark.createDataFrame(rows, "g int, v double")
    want = {}
    for g in {r[0] for r in rows}:
        vals = sorted(v for gg, v in rows if gg == g)
        want[g] = vals[len(vals) // 2]
    rows += [(10, -3.0), (10, -0.5), (10, 0.0), (10, 0.25), (10, 7.0)]
    df = spark.createDataFrame(rows, "g int, v double")
    want[10] = 0.0
    for accuracy in (20, 100, 5000):       # coarse quantiles: a wider bracket, the same median
        monkeypatch.setattr(stats, "ACCURACY", accuracy)
        monkeypatch.setattr(stats, "BRACKET", 4 / accuracy)
        got = {r["g"]: r["median"] for r in upper_median(df, ["g"], "v").collect()}
        assert got == want, accuracy
    dec = df.withColumn("v", F.col("v").cast("decimal(12,2)"))
    dec_rows = [(r["g"], r["v"]) for r in dec.collect()]
    want_dec = {}
    for g in {r[0] for r in dec_rows}:
        vals = sorted(v for gg, v in dec_rows if gg == g)
        want_dec[g] = vals[len(vals) // 2]
    got = {r["g"]: r["median"] for r in upper_median(dec, ["g"], "v").collect()}
    assert got == want_dec


def test_upper_median_text_and_dates(spark):
    import datetime as dt
    words = ["pear", "apple", "fig", "apricot", "banana", "plum", "kiwi", "apple", "date", "apex"]
    rows = [(1, w) for w in words] + [(2, "z")] + [(3, w) for w in ["b", "a"]]
    df = spark.createDataFrame(rows, "g int, v string")
    got = {r["g"]: r["median"] for r in upper_median(df, ["g"], "v").collect()}
    assert got == {1: sorted(words)[5], 2: "z", 3: "b"}
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=7 * i) for i in range(11)]
    ddf = spark.createDataFrame([(0, d) for d in reversed(days)], "g int, v date")
    assert upper_median(ddf, ["g"], "v").collect()[0]["median"] == days[5]


def test_upper_median_nan_infinity_and_null_group(spark):
    """NaN sorts last, infinity before it; a null group is a group."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, v) for v in (5.0, 6.0, nan)] + [(2, v) for v in (inf, -inf, 1.0)] + [(3, v) for v in (nan, nan, inf)]
    rows += [(None, 3.0), (None, 4.0), (4, nan)]
    got = {r["g"]: r["median"] for r in upper_median(spark.createDataFrame(rows, "g int, v double"), ["g"], "v").collect()}
    assert got[1] == 6.0 and got[2] == 1.0 and got[None] == 4.0 and got[3] != got[3] and got[4] != got[4]


def test_upper_median_narrow_ranges_are_spread(spark):
    """Epoch millis, dates and ids that share a prefix fall into many
    buckets, and no bucket keeps more than a sliver of a hot group."""
    from duetlog.operators import stats
    n = 20000
    base = spark.range(n).select(F.lit(1).alias("g"), F.col("id"),
                                 (F.lit(1_600_000_000_000) + F.col("id") * 1000).alias("ms"),
                                 F.concat(F.lit("2021-user-"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("text"),
                                 F.timestamp_seconds(F.col("id") + 1_600_000_000).alias("ts"))
    for c in ("ms", "text", "ts"):
        got = upper_median(base, ["g"], c).first()["median"]
        assert got == base.where(F.col("id") == n // 2).first()[c], c
        assert stats._bracketed(base, ["g"], F.col(c)).count() <= 3 * n * stats.BRACKET, c


def test_rank_and_percent_equal_windows(spark):
    from pyspark.sql import Window
    from duetlog.operators.stats import rank_within, topk_per_group, with_percent_of_total
    df = spark.createDataFrame([(g, i % 7) for g in (1, 2, None) for i in range(40 if g == 1 else 9)], "g int, n int")
    w = Window.partitionBy("g")
    want = df.withColumn("rk", F.rank().over(w.orderBy(F.desc("n")))).withColumn("percent", F.col("n") / F.sum("n").over(w) * 100)
    rows = lambda d: sorted(map(tuple, d.collect()), key=repr)
    assert rows(rank_within(df, ["g"], "n")) == rows(want.select("g", "n", "rk"))
    assert rows(with_percent_of_total(df, "n", ["g"])) == rows(want.select("g", "n", "percent"))
    assert rows(topk_per_group(df, ["g"], "n", 3)) == rows(want.where("rk <= 3").select("g", "n", "percent", "rk"))
