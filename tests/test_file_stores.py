"""Index and row-key sources: results, and the blocks they open."""

import random

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan, LessThanOrEqual, StringStartsWith

from duetlog.session import staging_path
from duetlog.sources import row_store, term_index
from duetlog.sources.blocks import blocks, file_system


@pytest.fixture(scope="module")
def index(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", "b", "b", "rare" if i % 40 == 0 else "c", None]), rng.choice(["x", "y"]),
             None if i % 97 == 0 else i * 10, i) for i in range(5000)]
    schema = "sv string, kind string, t long, n int"
    path = staging_path(spark, "index")
    term_index.build_index(spark.createDataFrame(rows, schema), path, ["sv", "kind"], "t", block_rows=100, posting_rows=8)
    return path, rows


CASES = [
    (lambda d: d.where("sv = 'b' AND t BETWEEN 12000 AND 20000"), lambda r: r[0] == "b" and r[2] is not None and 12000 <= r[2] <= 20000),
    (lambda d: d.where("sv IN ('a', 'rare') AND kind = 'x' AND t > 300 AND n % 2 = 0"),
     lambda r: r[0] in ("a", "rare") and r[1] == "x" and (r[2] or 0) > 300 and r[3] % 2 == 0),
    (lambda d: d.where("t < 5000"), lambda r: r[2] is not None and r[2] < 5000),
    (lambda d: d.where("sv = 'none'"), lambda r: False),
    (lambda d: d.where("sv = 'a' AND sv = 'b'"), lambda r: False),
    (lambda d: d.where("t = 30"), lambda r: r[2] == 30),
    (lambda d: d.where("sv IS NULL"), lambda r: r[0] is None),
    (lambda d: d.where("kind = 'y' OR sv = 'a'"), lambda r: r[1] == "y" or r[0] == "a"),
    (lambda d: d, lambda r: True),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_index_filters(spark, index, case):
    path, rows = index
    ask, keep = CASES[case]
    got = ask(term_index.read_index(spark, path)).collect()
    if case == 1:              # rows without a time have no posting and match no bound
        keep = lambda r, k=keep: k(r) and r[2] is not None
    assert sorted(map(tuple, got), key=repr) == sorted(filter(keep, rows), key=repr)


def _reader(path, *filters):
    about = term_index.TermIndex({"path": path})
    r = term_index.TermReader(path, about._about())
    assert list(r.pushFilters(list(filters))) == []
    return r


def test_index_opens_only_blocks_of_the_term_and_range(spark, index):
    path, _ = index
    total = len(blocks(f"{path}/rows", ["t"]))
    assert total >= 50
    r = _reader(path, EqualTo(("sv",), "rare"), GreaterThanOrEqual(("t",), 10_000), LessThanOrEqual(("t",), 30_000))
    pieces = r.partitions()
    assert len(pieces) < len(blocks(f"{path}/postings", ["term"])) / 4
    opened = [p for piece in pieces for p in r.postings(piece)]
    assert 1 <= len(opened) <= 10
    bounds = {(b.file, b.group): b.bounds["t"] for b in blocks(f"{path}/rows", ["t"])}
    root = file_system(path)[1]
    for p in opened:
        low, high = bounds[f"{root}/rows/{p['file']}", p["block"]]
        assert p["term"] == "rare" and low <= 30_000 and high >= 10_000
    r = _reader(path, LessThan(("t",), 5000))
    assert len(r.partitions()) < total / 5


def test_index_filters_leave_the_plan(spark, index):
    plan = term_index.read_index(spark, index[0]).where("sv = 'b' AND t >= 100")._jdf.queryExecution().executedPlan().toString()
    assert "= b" not in plan and ">= 100" not in plan, plan


def _cells(n):
    rows = [(f"k{i:05d}", "cf", q, f"{q}{i}") for i in range(n) for q in ("a", "b")]
    return rows + [(f"k{i:05d}", "meta", "z", "m") for i in range(0, n, 3)] + [(None, "cf", "a", "lost")] + [
        ("k00007", "cf", f"q{j}", "wide") for j in range(3000)]


@pytest.fixture(scope="module")
def regions(spark):
    path = staging_path(spark, "regions")
    row_store.write_regions(spark.createDataFrame(_cells(4000), row_store.SCHEMA), path, regions=8, block_cells=1000)
    return path


def test_scan_equals_the_pivot_of_the_range(spark, regions):
    got = row_store.scan(spark, regions, "k01000", "k01010", ["a", "b"]).collect()
    assert sorted(map(tuple, got)) == [(f"k{i:05d}", f"a{i}", f"b{i}") for i in range(1000, 1010)]
    assert row_store.scan(spark, regions, None, None, ["a"]).count() == 4000
    assert row_store.scan(spark, regions, "z", None, ["a"]).count() == 0
    wide = row_store.read_regions(spark, regions).where("rowkey = 'k00007'")
    assert wide.count() == 3002
    some = row_store.read_regions(spark, regions).where("rowkey LIKE 'k0001%' AND family = 'meta' AND qualifier = 'z'")
    assert sorted(r.rowkey for r in some.collect()) == ["k00012", "k00015", "k00018"]
    assert row_store.read_regions(spark, regions).where("rowkey IN ('k00001', 'k03999') AND value <> 'a1'").count() == 4      # b1, and a, b, z of the other


def test_a_narrow_scan_opens_one_region(spark, regions):
    found = blocks(regions, ["rowkey"])
    assert len({b.file for b in found}) == 8 and len(found) >= 12

    def opened(*filters):
        r = row_store.RegionReader(regions)
        assert list(r.pushFilters(list(filters))) == []
        return r.partitions()

    low, high = sorted(b.bounds["rowkey"] for b in found)[-1]
    inside = f"k{(int(low[1:]) + int(high[1:])) // 2:05d}"
    assert len(opened(GreaterThanOrEqual(("rowkey",), inside), LessThan(("rowkey",), inside + "0"))) == 1
    assert len(opened(EqualTo(("rowkey",), inside))) == 1
    assert len(opened(In(("rowkey",), (inside, "nothing like it")))) == 1
    assert opened(StringStartsWith(("rowkey",), "x")) == []
    assert len(opened()) == len(found)


def test_filters_that_the_source_cannot_take_stay(spark, regions):
    plan = row_store.read_regions(spark, regions).where("rowkey >= 'k1' AND length(value) > 3")._jdf.queryExecution().executedPlan().toString()
    assert "length(value" in plan
