import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from duetlog.llm import ann, queries
from duetlog.llm.common import read
from .conftest import SF01
from .oracle_check import compare


def _brute(rows, asked, k=20):
    out = []
    for q_id, q in asked:
        got = sorted((-float(sum(np.float64(a) * np.float64(b) for a, b in zip(q, v))), i is None, i or 0, i)
                     for i, v in rows if i != q_id)
        out += [(q_id, n, g[3], -g[0]) for n, g in enumerate(got[:k], 1)]
    return sorted(out, key=repr)


def test_whole_table_equals_duckdb(spark):
    assert compare("op12_nearest_vectors", spark, SF01) == 500


def test_recall_on_the_larger_table(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op12_nearest_vectors"](spark, sf).collect()
    rows = read(spark, sf, "embeddings").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], np.float64)
    s = x[::20] @ x.T
    s[np.arange(len(s)), np.arange(0, len(x), 20)] = -np.inf
    want = {(20 * i, int(j)) for i, row in enumerate(np.argsort(-s, axis=1)[:, :20]) for j in row}
    assert len(got) == len(want)
    assert len(want & {(r.query_id, r.vec_id) for r in got}) / len(want) >= 0.99


@pytest.mark.parametrize("block, query_block", [(1 << 17, 1 << 14), (50, 7)])
def test_clustered_scaled_and_repeated_vectors(spark, monkeypatch, block, query_block):
    """Lengths from 0.01 to 100, tight groups, a third of all rows equal."""
    rng = np.random.default_rng(1)
    hubs = rng.standard_normal((5, 24)) * 3
    x = hubs[rng.integers(0, 5, 600)] + rng.standard_normal((600, 24)) * rng.choice([0.01, 1, 3], 600)[:, None]
    x *= rng.choice([0.01, 1, 100], 600)[:, None]
    x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    monkeypatch.setattr(ann, "QUERY_BLOCK", query_block)
    monkeypatch.setattr(ann, "TILE", (16, 64))
    got = ann.search(ann.build(df, block=block), df.where("vec_id % 20 = 0")).collect()
    want = _brute(rows, [r for r in rows if r[0] % 20 == 0])
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_bounds_hold_and_rule_out_most():
    """The miss exceeds its bound rarely, and few vectors are reranked."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((8000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    turn = ann.rotation(64, 256)
    assert np.allclose(turn @ turn.T, np.eye(64))
    code, r, a = ann.encode(x, turn)
    q = x[:40]
    sign = np.unpackbits(code, axis=1).astype(float) * 2 - 1
    miss = (q @ turn) @ sign.T / 16 / a * r - q @ x.T
    bound = r * np.sqrt(1 - a ** 2) / a * ann.ERROR / math.sqrt(255)
    assert (np.abs(miss) > bound).mean() < 0.003
    assert abs(miss.mean()) < 0.002                                      # without bias
    row, col, score, reranked = ann.visit(np.arange(40), q, np.full(40, -np.inf), np.arange(8000), x, code, r, a,
                                          np.zeros(64), turn, 20)
    assert len(row) == 800 and reranked < 0.15 * 40 * 8000
    full = q @ x.T
    full[np.arange(40), np.arange(40)] = -np.inf
    best = {(i, j) for i, s in enumerate(np.argsort(-full, axis=1)[:, :20]) for j in s}
    assert len(best & set(zip(row, col))) >= 0.99 * len(best)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [2.0, 5.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]),
            (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [0.5, 0.5]), (8, [-1.0, 3.0]),
            (20, [3.0, -1.0]), (40, None), (-20, [1e-3, 0.0]), (9, []), (60, [1.0])]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<double>, cell string, score double")
    got = ann.search(ann.build(df), df.where("vec_id % 20 = 0")).collect()
    part = [r for r in rows if r[0] in (0, 1, None, 8, 20, -20) and r[1]]
    want = _brute(part, [(0, [1.0, 0.0]), (20, [3.0, -1.0]), (-20, [1e-3, 0.0])])
    assert sorted((tuple(r) for r in got), key=repr) == want
    none = df.limit(0)
    assert ann.search(ann.build(none), none).count() == 0
    assert ann.search(ann.build(df), none).count() == 0
    one = df.where("vec_id = 20")
    assert ann.search(ann.build(one), one).count() == 0


def test_no_cross_join(spark):
    plan = queries.QUERIES["op12_nearest_vectors"](spark, SF01)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
