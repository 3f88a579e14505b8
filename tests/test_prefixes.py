"""Longest-prefix lookup against brute force, both address sizes, and the
check that the interval join refuses overlaps."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from duetlog.operators.joins import ip_range_join, refuse_overlaps
from duetlog.operators.prefixes import address, bits_of_long, bits_of_text, pieces, prefix_join


def test_pieces_fill_a_range_without_overlap():
    rng = random.Random(1)
    for bits in (8, 32, 128):
        for _ in range(200):
            lo, hi = sorted(rng.randrange(1 << bits) for _ in range(2))
            blocks = [(int(p, 2) << (bits - len(p)) if p else 0, 1 << (bits - len(p))) for p in pieces(lo, hi, bits)]
            assert len(blocks) <= 2 * bits
            at = lo
            for start, size in blocks:
                assert start == at and start % size == 0
                at += size
            assert at == hi + 1
    assert list(pieces(0, (1 << 32) - 1, 32)) == [""]


def test_text_keys_equal_the_standard_library(spark):
    rng = random.Random(2)
    good = ["0.0.0.0", "255.255.255.255", "::", "::1", "1::", "2001:db8::1", "fe80::1:2:3:4", "1:2:3:4:5:6:7:8", "::ffff:1.2.3.4",
            "1:2:3:4:5:6:1.2.3.4", "ABCD::EF01"]
    good += [str(ipaddress.ip_address(rng.randrange(1 << b))) for b in (32, 128) for _ in range(100)]
    good += [ipaddress.ip_address(rng.randrange(1 << 128)).exploded for _ in range(20)]
    bad = [None, "", "1.2.3", "1.2.3.256", "1.2.3.4.5", "x", ":", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "12345::", "g::",
           "1.2.3.4::", "1:2:3:4:5:6:7::8:9", "1:2:3:4:5:6:7:"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "i int, t string")
    got = [r.k for r in rows.select("i", bits_of_text(F.col("t")).alias("k")).orderBy("i").collect()]
    for t, k in zip(good + bad, got):
        want = address(t) if t is not None else None
        assert k == (want and want[0] + format(want[1], "b").zfill(32 if want[0] == "4" else 128)), t


def _winner(ranges, x):
    """Longest piece, then narrower, lower, lesser label."""
    best = None
    for lo, hi, label in ranges:
        a, b = address(lo), address(hi)
        if a and b and a[0] == b[0] == x[0] and a[1] <= x[1] <= b[1]:
            bits = 32 if x[0] == "4" else 128
            length = next(len(p) for p in pieces(a[1], b[1], bits) if format(x[1], "b").zfill(bits).startswith(p))
            cand = (-length, b[1] - a[1], a[1], label)
            best = cand if best is None else min(best, cand)
    return best and best[3]


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_nested_and_overlapping_ranges(spark, limit):
    rng = random.Random(3)
    ranges = [("10.0.0.0", "10.255.255.255", "ten"), ("10.0.0.0", "10.255.255.255", "ten again"), ("0.0.0.0", "255.255.255.255", "all"),
              ("2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff", "doc"), ("2001:db8::5", "2001:db8::9", "few"),
              ("9.9.9.9", "1.1.1.1", "upside down"), ("1.2.3.4", "::1", "mixed"), (None, "1.1.1.1", "open"), ("x", "y", "junk")]
    for i in range(60):
        lo = (10 << 24) + rng.randrange(1 << 12)
        ranges.append((str(ipaddress.ip_address(lo)), str(ipaddress.ip_address(lo + rng.randrange(300))), f"r{i:02d}"))
    points = [str(ipaddress.ip_address((10 << 24) + rng.randrange(1 << 12))) for _ in range(300)]
    points += ["9.8.7.6", "255.255.255.255", "2001:db8::5", "2001:db8::a", "::", "bad", None] + ["10.0.0.1"] * 50
    fact = spark.createDataFrame([(i, p, "x") for i, p in enumerate(points)], "i int, ip string, _prefix string")
    dim = spark.createDataFrame(ranges, "lo string, hi string, place string")
    got = {r.i: r.place for r in prefix_join(fact, dim, bits_of_text(F.col("ip")), max_broadcast_bytes=limit).collect()}
    assert got == {i: address(p) and _winner(ranges, address(p)) for i, p in enumerate(points)}


def test_longs_and_empty_ranges(spark):
    fact = spark.createDataFrame([(5,), (None,), (-1,), (1 << 32,)], "ip long")
    dim = spark.createDataFrame([(0, 9, "a"), (5, 5, "b")], "lo long, hi long, place string")
    rows = prefix_join(fact, dim, bits_of_long(F.col("ip"))).collect()
    assert sorted(((r.ip, r.place) for r in rows), key=repr) == sorted([(5, "b"), (None, None), (-1, None), (1 << 32, None)], key=repr)
    assert [r.place for r in prefix_join(fact, dim.limit(0), bits_of_long(F.col("ip"))).collect()] == [None] * 4


def test_no_nested_loop_in_the_plan(spark, tables01):
    df = prefix_join(tables01["user_ip"], tables01["ip_nested"], bits_of_long(F.col("ip")), max_broadcast_bytes=0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_the_shuffled_form_broadcasts_neither_side(spark):
    """Estimates take the addresses, exploded to one row a length, or the
    pieces, exploded to one row a salt, for small enough to broadcast."""
    points = spark.range(2_000).select((F.col("id") * 7).alias("ip"))
    dim = spark.range(40).select((F.col("id") * 300).alias("lo"), (F.col("id") * 300 + 250).alias("hi"), F.col("id").alias("place"))
    big = dim.crossJoin(spark.range(500)).select("lo", "hi", "place").distinct()
    want = {(i * 7, i * 7 // 300 if i * 7 % 300 <= 250 and i * 7 < 12_000 else None) for i in range(2_000)}
    for ranges in (dim, big):       # estimated below and above the addresses
        df = prefix_join(points, ranges, bits_of_long(F.col("ip")), max_broadcast_bytes=0)
        assert {tuple(r) for r in df.collect()} == want
        plan = df._jdf.queryExecution().executedPlan().toString()      # first and final plan
        joins = [line for line in plan.splitlines() if "Join [" in line and "_salt" in line]
        assert joins and all("SortMergeJoin" in line for line in joins)


def test_the_interval_join_refuses_overlaps(spark):
    fine = spark.createDataFrame([(0, 10), (11, 200_000), (200_001, 200_001)], "lo long, hi long")
    assert refuse_overlaps(fine).count() == 3
    fact = spark.createDataFrame([(5,)], "ip long")
    for bad in ([(0, 10), (10, 20)], [(0, 500_000), (70_000, 70_001)], [(1, 2), (1, 2)]):
        with pytest.raises(ValueError, match="overlaps another"):
            ip_range_join(fact, spark.createDataFrame(bad, "lo long, hi long"), "ip", check=True)
