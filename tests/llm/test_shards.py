import zlib
from collections import Counter, defaultdict

import pytest

from duetlog.llm import queries, shards
from duetlog.llm.common import read
from .conftest import SF01


@pytest.fixture(scope="module")
def placed(spark):
    return queries.QUERIES["op4_kd_tree_sharding"](spark, SF01).collect()


def test_contract(spark, placed):
    docs = {r.doc_id: r.text or "" for r in read(spark, SF01, "documents").collect()}
    assert sorted(r.doc_id for r in placed) == sorted(docs)
    load, slots, groups = Counter(), defaultdict(list), defaultdict(set)
    for r in placed:
        raw = docs[r.doc_id].encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw) and r.law == "bytes" and r.grown_shard is None
        load[r.shard] += r.size
        slots[r.shard].append((r.slot, r.doc_id))
        groups[docs[r.doc_id]].add(r.shard)
    assert set(load) == set(range(40))
    mean, largest = sum(load.values()) / 40, max(r.size for r in placed)
    assert max(load.values()) - mean <= largest and mean - min(load.values()) <= largest
    for s in slots.values():
        assert [n for n, _ in sorted(s)] == list(range(len(s))) and [d for _, d in sorted(s)] == sorted(d for _, d in s)
    assert sum(len(v) > 1 for v in groups.values()) <= 39         # a cut tears one group at most


def brute(rows, leaves, dims):
    """The same tree in one process, without snapping."""
    ties = ("size", "text_crc32", "doc_id")
    rank = {}
    for d, name in enumerate(dims):
        def key(r, name=name):
            return [(r[c] is not None, r[c] if r[c] is not None else 0) for c in (name, *[t for t in ties if t != name])]
        for i, r in enumerate(sorted(rows, key=key)):
            rank[d, r["doc_id"]] = i
    out = []

    def split(part, m):
        if m == 1:
            out.append(part)
            return
        if not part:
            split([], m // 2)
            split([], m - m // 2)
            return
        width = []
        for d, name in enumerate(dims):
            ranks = [rank[d, r["doc_id"]] for r in part]
            width.append(0 if len({r[name] for r in part}) == 1 and part[0][name] is not None else max(ranks) - min(ranks) + 1)
        d = width.index(max(width))
        part = sorted(part, key=lambda r: rank[d, r["doc_id"]])
        goal, at = sum(r["size"] for r in part) * (m // 2) / m, 0
        for i, r in enumerate(part):
            if at + r["size"] >= goal:
                cut = i if goal - at < at + r["size"] - goal else i + 1
                break
            at += r["size"]
        split(part[:cut], m // 2)
        split(part[cut:], m - m // 2)
    split(rows, leaves)
    return {r["doc_id"]: i for i, part in enumerate(out) for r in part}


def test_tree_equals_brute_force(spark):
    meta = shards.metadata(read(spark, "/root/testdata/sf0.001", "documents"))
    rows = [r.asDict() for r in meta.collect()]
    got = {r.doc_id: r.shard for r in shards.kd_tree(meta, shards.DIMENSIONS, 7, snap=0).collect()}
    assert got == brute(rows, 7, shards.DIMENSIONS)


def test_odd_rows_and_a_hot_group(spark, odd_docs, no_docs):
    got = shards.sharded(odd_docs, 40).collect()
    assert len(got) == odd_docs.count() and {r.shard for r in got} <= set(range(40))
    assert sorted(r.size for r in got if r.doc_id in (3, 4)) == [16, 16]
    assert shards.sharded(no_docs).count() == 0
    rows = [(i, "copy of one text " * 5 if i % 2 else f"text number {i} " * (i % 9), "en") for i in range(600)]
    hot = shards.sharded(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 8).collect()
    load = Counter()
    for r in hot:
        load[r.shard] += r.size
    assert max(load.values()) - min(load.values()) <= 2 * max(r.size for r in hot)
    nulls = spark.createDataFrame([(None, "a", None), (None, "a", None), (1, None, None)], "doc_id long, text string, lang string")
    assert shards.sharded(nulls, 2).count() == 3
    assert shards.shard_count(nulls, 17) == 3
