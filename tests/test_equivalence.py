"""Equivalence tests: each rewritten operator equals the studied form."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from duetlog.functions import columns as C
from duetlog.operators.windows import global_row_number
from duetlog.plans import couples, enrich, farm


def _rows(df, digits=6):
    out = []
    for r in df.collect():
        out.append(tuple(round(float(v), digits) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
                         for v in r))
    return sorted(out, key=repr)


def test_interval_join_strategies_agree(tables01):
    u, r = tables01["user_ip"], tables01["ip_ranges"]
    base = _rows(u.join(r, F.col("ip").between(F.col("lo"), F.col("hi")), "left")
                 .select("user_id", *enrich.REGION_ATTRS))
    assert sum(1 for x in base if x[1] is None) == 285          # gaps stay unmatched
    assert base == _rows(enrich.enrich_users(u, r))
    assert base == _rows(enrich.enrich_users(u, r, max_broadcast_bytes=0, salt=4))


def _cohort_selfjoin(profile, step):
    """The studied form: a paid aggregate left-joined to an all-rows one,
    the median taken from a collected, sorted list."""
    base = profile.dropDuplicates()
    sel = (base.select("space_id", "a_retention", "b_retention", "total_cost", "anniversary_day",
                       F.datediff("registe_space_dt", "anniversary_day").alias("love_days"))
           .where("love_days is not null and love_days >= 0 and love_days <= 1095 and anniversary_day is not null")
           .withColumn("love_days", C.bucket_floor("love_days", step)))
    re1 = (sel.where(F.col("total_cost") != 0).groupBy("love_days")
           .agg(F.count("space_id").alias("space_cnt"), F.sum("total_cost").alias("cost"),
                F.sort_array(F.collect_list("total_cost")).alias("lst"), F.stddev("total_cost").alias("std"))
           .select("love_days", "space_cnt", (F.col("cost") / (F.col("space_cnt") * 2)).alias("cost_avg"),
                   F.element_at("lst", (F.size("lst") / 2 + 1).cast("int")).alias("median"), "std"))
    re2 = (sel.groupBy("love_days")
           .agg(F.count("space_id").alias("space_cnt"), F.sum("total_cost").alias("cost"),
                (F.sum("a_retention") + F.sum("b_retention")).alias("retention"))
           .select("love_days", (F.col("retention") / (F.col("space_cnt") * 2) * 100).alias("retention_rate"),
                   (F.col("cost") / (F.col("space_cnt") * 2)).alias("cost_avg"), "space_cnt"))
    return (re2.join(re1, re1["love_days"] == re2["love_days"], "left")
            .select(re2["love_days"], re2["retention_rate"], (re1["space_cnt"] / re2["space_cnt"]).alias("pay_rate"),
                    re2["cost_avg"].alias("arpu"), re1["median"], re1["cost_avg"].alias("arppu"), re1["std"],
                    re2["space_cnt"]))


def test_cohort_one_pass_equals_self_join(tables01):
    c = tables01["couple"]
    for step in (5, 20):
        assert _rows(couples.cohort_stats(c, step), 4) == _rows(_cohort_selfjoin(c, step), 4)


def test_cohort_bucket_without_payers(spark):
    rows = [(1, 1, 0, "2020-01-10", "2020-01-01", 0.0), (2, 0, 1, "2020-01-10", "2020-01-01", 0.0),
            (3, 1, 1, "2020-03-01", "2020-01-01", 10.0), (4, 1, 1, "2020-03-01", "2020-01-01", 20.0)]
    df = (spark.createDataFrame(rows, "space_id long, a_retention int, b_retention int, registe_space_dt string, "
                                "anniversary_day string, total_cost double")
          .withColumn("registe_space_dt", F.to_date("registe_space_dt"))
          .withColumn("anniversary_day", F.to_date("anniversary_day")))
    got = {r["love_days"]: r for r in couples.cohort_stats(df, 5).collect()}
    assert got[5]["pay_rate"] is None and got[5]["median_paid_cost"] is None and got[5]["arppu"] is None
    assert got[60]["median_paid_cost"] == 20.0 and got[60]["pay_rate"] == 1.0 and got[60]["arppu"] == 7.5


def test_farm_one_pass_equals_star(tables01):
    f = tables01["farm"]
    one = farm.farm_activity(f)
    star = farm.farm_activity_star(f)
    cols = ["space_id", "user_id", "coin_op", *farm.KINDS]
    assert one.count() == 9772
    assert sorted(map(tuple, one.select(*cols).collect()), key=repr) == \
        sorted(map(tuple, star.select(*cols).collect()), key=repr)


def test_global_row_number_scalable_equals_window(tables01):
    nu = tables01["new_user"]
    a = _rows(global_row_number(nu, ["space_id", "user_id"], partitions=7))
    b = _rows(nu.withColumn("row_number", F.row_number().over(Window.orderBy("space_id", "user_id"))))
    assert a == b and len(a) == 15000


def test_enrich_duplicate_rows_not_squared(spark, tables01):
    u = spark.createDataFrame([(1, 10000001), (1, 10000001), (1, 10000001)], "user_id long, ip long")
    assert enrich.enrich_users(u, tables01["ip_ranges"]).count() == 3     # the studied self-join gave 9


def test_row_number_within_groups_hot_key(spark):
    """Per-group numbering equals the window form, with one hot group that
    spans several range partitions, ties and a null group."""
    from pyspark.sql import Window
    from duetlog.operators.windows import _laid, row_number_within
    hot = spark.range(8000).select(F.lit(1).alias("g"), F.lit(7).alias("v"))      # 8000 equal rows
    parts = _laid(hot, ["g"], ["v"], 8).groupBy("_pid").count().collect()
    assert len(parts) >= 6 and max(p["count"] for p in parts) <= 4000
    assert sorted(r["pos"] for r in row_number_within(hot, ["g"], ["v"], "pos", 8).collect()) == list(range(1, 8001))
    rows = [(0, i % 50) for i in range(3000)] + [(g, g * 3 % 7) for g in range(1, 40) for _ in range(g)]
    rows += [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "g int, v int")
    got = sorted(map(tuple, row_number_within(df, ["g"], ["v"], out="pos", partitions=6)
                     .select("g", "v", "pos").collect()), key=repr)
    want = sorted(map(tuple, df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("v")))
                      .select("g", "v", "pos").collect()), key=repr)
    assert got == want


def test_top_provinces_both_equals_two_reports(tables01):
    from duetlog.catalog.couples_q import AS_OF
    ce = tables01["couple_enriched"]
    both = couples.top_provinces_both(ce, as_of=AS_OF)
    for by in ("user_type", "love_days_type"):
        one = couples.top_provinces(ce, by, as_of=AS_OF)
        a = _rows(both.where(F.col("report") == by).select(F.col("type"), "province", "nums", "percent", "rk"))
        b = _rows(one.select(F.col(by).alias("type"), "province", "nums", "percent", "rk"))
        assert a == b and len(a) > 0
