"""Nearest vectors by inner product over randomly rotated one-bit codes.

Index.  Vectors are dealt to cells by their nearest centre (centres: a few
rounds of k-means over a bounded sample).  What is left of a vector after its
centre is taken away, o - c = r * u, is padded with zeros to ``bits``
dimensions and turned by one random rotation P; its code x is the signs of
P u, packed, with two correction scalars, r and a = <x / sqrt(bits), P u>.

Estimate.  <q, o> = <q, c> + r * <q, u>, and <q, u> is estimated without bias
by <P q, x / sqrt(bits)> / a.  The miss stays under

    |q| * sqrt((1 - a^2) / a^2) * ERROR / sqrt(bits - 1)

but for a chance that falls exponentially with ERROR squared.  So every
estimate has an upper bound: of a block a few times ``k`` vectors of the largest
estimates, and then all whose upper bound reaches the ``k``-th best value known,
are reranked by the inner product of the original vectors, in double
precision, summed from the first component to the last.

Search.  Every query first visits the ``FIRST`` cells whose centres have the
largest inner product; the k-th best it finds there is its threshold.  It then
visits every other cell that its threshold does not rule out (<q, c> + |q| *
the cell's radius is a certain bound).  A visit is a task over a block of a
cell (at most about ``BLOCK`` vectors, so a hot cell is many blocks) and a
block of queries; a task keeps at most ``k`` rows a query, and a window over
those gives the answer.

Defined results: vectors that are null, zero, or hold a null, NaN or infinite
component take no part, nor do those of another length than the commonest
(ties: the longer); a query's own row is every row with its vec_id; of a query
id with several vectors the least vector counts; repeated candidates count
each; a null vec_id is a candidate, last among ties; fewer than ``k``
candidates are all returned; an empty table gives an empty result; extra
columns are passed by.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, saved, task

TOP = 20
#: The registered query searches for rows whose vec_id this divides.
QUERY_STEP = 20
ERROR = 3.0
#: Vectors a centre is fitted on, at most; centres, at most.
SAMPLE_PER_CENTRE = 64
MAX_CENTRES = 1024
#: Vectors in a block of a cell and queries in a block, about.
BLOCK = 1 << 17
QUERY_BLOCK = 1 << 14
#: Cells that give a query its threshold.
FIRST = 2
#: Queries and vectors estimated at once in a task.
TILE = 256, 8192
#: Times ``k`` guesses that are reranked first, for a threshold.
FIRST_GUESSES = 4
_NULL_ID = np.iinfo(np.int64).max


@dataclass
class Index:
    """``rows``: (cell, part, vec_id, vector, code, r, a) of every vector;
    ``cells``: per cell its centre, radius and number of parts."""

    rows: DataFrame
    centres: np.ndarray
    radius: np.ndarray
    parts: np.ndarray
    rotation: np.ndarray


def usable(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that take part, as doubles."""
    rows = df.select(column(df, key).cast("long").alias("vec_id"), column(df, vector).cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.where(F.col("v").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0))


def _matrix(col, dim: int) -> np.ndarray:
    """A column of equally long lists as (rows, dim)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)


def rotation(dim: int, bits: int, seed: int = 7) -> np.ndarray:
    """(dim, bits): the rows of a random rotation that meet the dimensions
    not padded."""
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dim)))
    return q.T.copy()


def centres(sample: np.ndarray, k: int, rounds: int = 6, seed: int = 11) -> np.ndarray:
    """k-means over the sample; a centre without vectors stays."""
    c = sample[np.random.default_rng(seed).permutation(len(sample))[:k]]
    for _ in range(rounds):
        near = nearest(sample, c)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The place of each vector's nearest centre."""
    out = np.empty(len(x), np.int64)
    for a in range(0, len(x), 8192):
        out[a: a + 8192] = np.argmin((c ** 2).sum(1) - 2 * x[a: a + 8192] @ c.T, axis=1)
    return out


def encode(left: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed codes, r, a) of vectors without their centre."""
    bits = turn.shape[1]
    r = np.sqrt((left ** 2).sum(1))
    turned = (left / np.where(r > 0, r, 1)[:, None]) @ turn
    a = np.abs(turned).sum(1) / np.sqrt(bits)
    return np.packbits(turned > 0, axis=1), r, np.where(r > 0, a, 1.0)


def build(df: DataFrame, key: str = "vec_id", vector: str = "embedding", bits: int | None = None,
          max_centres: int = MAX_CENTRES, block: int = BLOCK) -> Index:
    """The index over every vector of ``df``."""
    rows = usable(df, key, vector)
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    dim, count = (sizes[0].dim, sizes[0]["count"]) if sizes else (1, 0)
    bits = bits or max(256, -(-4 * dim // 64) * 64)
    k = int(min(max_centres, max(1, round(np.sqrt(count) / 4))))
    rows = rows.where(F.size("v") == dim)
    want = SAMPLE_PER_CENTRE * k
    part = rows.select("v").sample(min(1.0, 2 * want / max(count, 1)), seed=7).limit(want).collect()
    c = centres(np.array([r.v for r in part], np.float64).reshape(-1, dim), k)
    turn = rotation(dim, bits)
    shared = df.sparkSession.sparkContext.broadcast((c, turn))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, turn = shared.value
        for b in batches:
            x = _matrix(b.column(1), dim)
            if not len(x):
                continue
            cell = nearest(x, c) if len(c) else np.zeros(len(x), np.int64)
            left = x - c[cell] if len(c) else x
            code, r, a = encode(left, turn)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), b.column(0), b.column(1), pa.array([v.tobytes() for v in code], pa.binary()),
                 pa.array(r), pa.array(a)], names=["cell", "vec_id", "v", "code", "r", "a"])

    kind = "cell int, vec_id long, v array<double>, code binary, r double, a double"
    coded = saved(rows.mapInArrow(task(run), kind), "ann-codes")
    c = c if len(c) else np.zeros((1, dim))
    radius, parts = np.zeros(len(c)), np.ones(len(c), np.int64)
    for x in coded.groupBy("cell").agg(F.max("r").alias("radius"), F.count("*").alias("n")).collect():
        radius[x.cell], parts[x.cell] = x.radius, -(-x.n // block)
    # rows of a cell are dealt over its parts by their place in the written table
    deal = F.element_at(F.lit([int(p) for p in parts]), F.col("cell") + 1)
    coded = coded.withColumn("part", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), deal).cast("int"))
    return Index(coded, c, radius, parts, turn)


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of pairs, summed from the first component on."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * x[:, d]
    return out


def visit(q_id: np.ndarray, q: np.ndarray, least: np.ndarray, v_id: np.ndarray, x: np.ndarray, code: np.ndarray,
          r: np.ndarray, a: np.ndarray, centre: np.ndarray, turn: np.ndarray, k: int, error: float = ERROR):
    """(query place, vector place, score) of each query's best ``k`` in a
    block among those that reach ``least``; and the number reranked."""
    bits = turn.shape[1]
    scale = (r / (a * np.sqrt(bits))).astype(np.float32)
    spread = r * np.sqrt(np.maximum(1 - a ** 2, 0)) / a * error / np.sqrt(bits - 1)
    best: list[tuple[np.ndarray, ...]] = []
    reranked = 0
    for i in range(0, len(q), TILE[0]):
        part = q[i: i + TILE[0]]
        turned, base = (part @ turn).astype(np.float32), part @ centre
        norm = np.sqrt((part ** 2).sum(1))
        floor = least[i: i + TILE[0]].copy()
        have = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for j in range(0, len(x), TILE[1]):
            sign = np.unpackbits(code[j: j + TILE[1]], axis=1, count=bits).astype(np.float32) * 2 - 1
            guess = base[:, None] + (turned @ sign.T) * scale[j: j + TILE[1]]
            # the slack covers the rounding of the estimate itself
            upper = guess + norm[:, None] * spread[j: j + TILE[1]] + 1e-5 * (1 + np.abs(guess))
            own = q_id[i: i + TILE[0], None] == v_id[None, j: j + TILE[1]]
            guess[own] = upper[own] = -np.inf
            few = min(FIRST_GUESSES * k, guess.shape[1])
            if few >= k:                     # the k-th best of the best guesses, reranked, is a threshold
                top = np.argpartition(guess, guess.shape[1] - few, axis=1)[:, -few:]
                at = np.repeat(np.arange(len(part)), few)
                known = np.where(own[at, top.ravel()], -np.inf, exact(part[at], x[j + top.ravel()])).reshape(-1, few)
                floor = np.maximum(floor, np.partition(known, few - k, axis=1)[:, few - k])
            row, col = np.nonzero((upper >= floor[:, None]) & ~own)
            reranked += len(row)
            score = exact(part[row], x[j + col])
            keep = score >= floor[row]
            have = tuple(np.concatenate(p) for p in zip(have, (row[keep], col[keep] + j, score[keep])))
            order = np.lexsort((v_id[have[1]], -have[2], have[0]))
            have = tuple(p[order] for p in have)
            place = np.arange(len(order)) - np.searchsorted(have[0], have[0])
            have = tuple(p[place < k] for p in have)
            full = have[0][k - 1 == np.arange(len(have[0])) - np.searchsorted(have[0], have[0])]
            at = np.searchsorted(have[0], full) + k - 1
            floor[full] = np.maximum(floor[full], have[2][at])
        best.append((have[0] + i, have[1], have[2]))
    return (*(np.concatenate(p) for p in zip(*best)), reranked)


def _visits(index: Index, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): each visit's best.  ``asked``: (query_id, q,
    cell, least), one row a visit."""
    spark = asked.sparkSession
    dim = index.centres.shape[1]
    shared = spark.sparkContext.broadcast((index.centres, index.rotation, index.parts))
    parts = F.element_at(F.lit([int(p) for p in index.parts]), F.col("cell") + 1)
    # queries of a cell are blocks as well; a block of vectors meets each of them
    load = asked.groupBy("cell").count().collect()
    blocks = np.zeros(len(index.parts), np.int64)
    for x in load:
        blocks[x.cell] = -(-x["count"] // QUERY_BLOCK)
    deal = F.element_at(F.lit([int(b) for b in blocks]), F.col("cell") + 1)
    left = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), deal).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    right = index.rows.withColumn("block", F.explode(F.when(deal > 0, F.sequence(F.lit(0), (deal - 1).cast("int")))))

    def run(key, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        c, turn, _ = shared.value
        if not queries.num_rows or not vectors.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        number = lambda t, n: t.column(n).combine_chunks().to_numpy(zero_copy_only=False)
        ids = vectors.column("vec_id").combine_chunks()
        v_id = ids.fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
        code = np.frombuffer(b"".join(vectors.column("code").to_pylist()), np.uint8).reshape(-1, turn.shape[1] // 8)
        q, x = _matrix(queries.column("q"), dim), _matrix(vectors.column("v"), dim)
        q_id = number(queries, "query_id")
        row, col, score, _ = visit(q_id, q, number(queries, "least"), v_id, x, code, number(vectors, "r"),
                                   number(vectors, "a"), c[key[0].as_py()], turn, k)
        return pa.table({"query_id": q_id[row], "vec_id": ids.take(pa.array(col)), "score": score})

    keys = ["cell", "part", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")


def search(index: Index, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of every query."""
    dim = index.centres.shape[1]
    q = usable(queries, key, vector).where((F.size("v") == dim) & F.col("vec_id").isNotNull())
    q = q.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    shared = queries.sparkSession.sparkContext.broadcast((index.centres, index.radius))

    def cells(first: bool):
        """Rows (query_id, q, cell, least) of the visits of each query."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c, radius = shared.value
            for whole in batches:
                for b in (whole.slice(a, 1024) for a in range(0, whole.num_rows, 1024)):
                    x = _matrix(b.column(1), dim)
                    near = x @ c.T
                    at = np.argsort(-near, axis=1, kind="stable")[:, :FIRST]
                    chosen = np.zeros(near.shape, bool)
                    np.put_along_axis(chosen, at, True, axis=1)
                    least = np.full(len(x), -np.inf)
                    if not first:
                        least = b.column(2).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                        reach = near + np.sqrt((x ** 2).sum(1))[:, None] * radius
                        chosen = ~chosen & (reach + 1e-9 * (1 + np.abs(reach)) >= least[:, None])
                    row, cell = np.nonzero(chosen)
                    rows = pa.array(row)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(cell, pa.int32()),
                                                      pa.array(least[row])], names=["query_id", "q", "cell", "least"])
        return task(run)

    kind = "query_id long, q array<double>, cell int, least double"
    asked = saved(q.mapInArrow(cells(True), kind), "ann-first-visits")
    found = saved(_visits(index, asked, k), "ann-first")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    least = ranked(found).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    rest = saved(q.join(least, "query_id", "left").select("query_id", "q", "least").mapInArrow(cells(False), kind),
                 "ann-other-visits")
    both = found.unionByName(_visits(index, rest, k))
    return ranked(both).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def oracle_sql() -> str:
    """Brute force in DuckDB."""
    ok = ("embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 "
          "AND len(list_filter(embedding, lambda x: x <> 0)) > 0")
    return f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE {ok}),
p AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e) AS score FROM v q JOIN v ON q.vec_id <> v.vec_id
      WHERE q.vec_id % {QUERY_STEP} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {TOP}"""
