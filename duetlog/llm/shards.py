"""K-d tree sharding: recursive weighted medians over document metadata.

Every document has a unique rank along each metadata dimension (range
partitioned sort, ties broken by size, checksum and id).  A node of the tree
that must become m shards is cut along its widest dimension - the one whose
values in the node span the largest share of all ranks - at the rank that
leaves floor(m / 2) / m of its bytes on the left.  The cut is found by
histograms: each round sums bytes in ``BINS`` rank bins per node on the
executors and narrows to one bin, until the bin is a single rank; the driver
sees ``BINS`` numbers a node.  Leaves therefore hold the target bytes within
about one document, whatever the skew of a value or of a group of copies.

Copies (equal size and checksum) lie next to each other along every
dimension; a cut that falls inside such a group moves to its edge when that
costs at most ``SNAP`` of a shard's bytes.

Defined results: a null text has size 16 (no bytes) and checksum 0; null
metadata sorts first; repeated rows are separate rows, placed next to each
other; with fewer documents than shards some shards stay empty; an empty
table gives an empty result.  Extra columns are passed by.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, saved

SHARDS = 40
OVERHEAD = 16
BINS = 256
SNAP = 0.01
#: Metadata dimensions; copies of a text agree on all of them.
DIMENSIONS = ("size", "lang", "text_crc32")
_TIES = ("size", "text_crc32", "doc_id")


class Cut(NamedTuple):
    node: int
    dim: int
    cut: int
    left: int
    right: int


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with a gapless global row number from 0 along ``order``.  The
    range-partitioned layout is written first, so that the number stays the
    same in every later read; no partition depends on another one's rows."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*order, "_tie"]                  # equal rows too can be cut over several partitions
    laid = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(
        *order).drop("_tie").select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place"))
    laid = saved(laid, "ranked")
    counts = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", "_first", before.alias("_before"))     # one row a partition
    return laid.join(F.broadcast(offsets), "_part").withColumn(
        name, F.col("_before") + F.col("_place") - F.col("_first")).drop("_part", "_place", "_first", "_before")


def metadata(df: DataFrame) -> DataFrame:
    text = F.coalesce(column(df, "text").cast("string"), F.lit(""))
    return df.select(column(df, "doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                     F.crc32(text.cast("binary")).alias("text_crc32"), column(df, "lang").cast("string").alias("lang"))


def _rank(dim: Column, n: int) -> Column:
    out = F.col("_r0")
    for d in range(1, n):
        out = F.when(dim == d, F.col(f"_r{d}")).otherwise(out)
    return out


def _assigned(meta: DataFrame, levels: list[list[Cut]], n_dims: int) -> DataFrame:
    """``meta`` with the node each row has reached (at most SHARDS cuts a
    level are broadcast)."""
    spark, out = meta.sparkSession, meta.withColumn("_node", F.lit(1).cast("long"))
    for cuts in levels:
        small = _table(spark, cuts, "_at long, _dim int, _cut long, _left long, _right long")
        out = out.join(F.broadcast(small), out["_node"] == small["_at"], "left").withColumn(
            "_node", F.when(F.col("_at").isNull(), F.col("_node")).when(
                _rank(F.col("_dim"), n_dims) < F.col("_cut"), F.col("_left")).otherwise(F.col("_right"))).drop(
            "_at", "_dim", "_cut", "_left", "_right")
    return out


def _table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def _find_cuts(now: DataFrame, nodes: dict[int, dict], n_dims: int) -> dict[int, int]:
    """The rank of each node's weighted median, by narrowing histograms."""
    spark = now.sparkSession
    open_ = {k: dict(v, before=0) for k, v in nodes.items()}
    found = {}
    while open_:
        small = _table(spark, [(k, v["dim"], v["lo"], max(1, -(-(v["hi"] - v["lo"]) // BINS)), v["hi"]) for k, v in open_.items()],
                       "_at long, _dim int, _lo long, _step long, _hi long")
        r = _rank(F.col("_dim"), n_dims)
        bins = now.join(F.broadcast(small), now["_node"] == small["_at"]).where((r >= F.col("_lo")) & (r < F.col("_hi"))).groupBy(
            "_at", F.floor((r - F.col("_lo")) / F.col("_step")).alias("bin")).agg(F.sum("size").alias("w")).collect()
        steps = {x["_at"]: x["_step"] for x in small.collect()}
        for k, v in list(open_.items()):
            mine = sorted((x["bin"], x["w"]) for x in bins if x["_at"] == k)
            at = v["before"]
            for b, w in mine:
                if at + w >= v["goal"]:
                    break
                at += w
            lo, step = v["lo"] + b * steps[k], steps[k]
            if step == 1:                  # the bin is one row: cut before or after it, whichever is nearer
                found[k] = lo if v["goal"] - at < at + w - v["goal"] else lo + 1
                del open_[k]
            else:
                open_[k] = dict(v, lo=lo, hi=min(lo + step, v["hi"]), before=at)
    return found


def _snapped(now: DataFrame, nodes: dict[int, dict], cuts: dict[int, int], n_dims: int, room: float) -> dict[int, int]:
    """Cuts moved to the edge of the group of copies they fall into."""
    spark = now.sparkSession
    small = _table(spark, [(k, nodes[k]["dim"], c) for k, c in cuts.items()], "_at long, _dim int, _cut long")
    r = _rank(F.col("_dim"), n_dims)
    here = now.join(F.broadcast(small), now["_node"] == small["_at"]).withColumn("_r", r)
    edge = here.groupBy("_at").agg(F.max(F.when(F.col("_r") < F.col("_cut"), F.struct("_r", "size", "text_crc32"))).alias("a"),
                                   F.min(F.when(F.col("_r") >= F.col("_cut"), F.struct("_r", "size", "text_crc32"))).alias("b"))
    torn = [(x["_at"], nodes[x["_at"]]["dim"], cuts[x["_at"]], x["a"]["size"], x["a"]["text_crc32"]) for x in edge.collect()
            if x["a"] and x["b"] and tuple(x["a"])[1:] == tuple(x["b"])[1:]]
    if not torn:
        return cuts
    small = _table(spark, torn, "_at long, _dim int, _cut long, _size long, _crc long")
    group = now.join(F.broadcast(small), (now["_node"] == small["_at"]) & (now["size"] == small["_size"])
                     & (now["text_crc32"] == small["_crc"])).withColumn("_r", r)
    out = dict(cuts)
    for x in group.groupBy("_at").agg(F.min("_r").alias("lo"), F.max("_r").alias("hi"), F.sum("size").alias("w"),
                                      F.coalesce(F.sum(F.when(F.col("_r") < F.col("_cut"), F.col("size"))), F.lit(0)).alias("left")).collect():
        to_left, to_right = x["w"] - x["left"], x["left"]
        if min(to_left, to_right) <= room:
            out[x["_at"]] = x["hi"] + 1 if to_left < to_right else x["lo"]
    return out


def kd_tree(meta: DataFrame, dimensions: tuple[str, ...], leaves: int, snap: float = SNAP) -> DataFrame:
    """``meta`` (with ``size`` and the dimensions) plus ``shard``, the number
    of the leaf from 0, in depth-first order of the tree."""
    n_dims = len(dimensions)
    for d, name in enumerate(dimensions):
        meta = ranked(meta, [name, *[t for t in _TIES if t != name]], f"_r{d}")
    meta = saved(meta, "kd-ranks")
    todo, levels = {1: leaves}, []         # node -> shards it must become; node numbers as in a binary heap
    total, shard_of = None, {}
    while todo:
        now = _assigned(meta, levels, n_dims)
        stats = now.where(F.col("_node").isin(list(todo))).groupBy("_node").agg(
            F.sum("size").alias("w"), *[f(f"_r{d}").alias(f"{n}{d}") for d in range(n_dims) for n, f in (("lo", F.min), ("hi", F.max))],
            *[(F.min(name).eqNullSafe(F.max(name)) & (F.count(name) == F.count(F.lit(1)))).alias(f"one{d}")
              for d, name in enumerate(dimensions)]).collect()
        if total is None:
            total = stats[0]["w"] if stats else 0
        nodes = {}
        for x in stats:
            k = x["_node"]
            if todo[k] > 1:
                width = [0 if x[f"one{d}"] else x[f"hi{d}"] - x[f"lo{d}"] + 1 for d in range(n_dims)]
                d = width.index(max(width))
                nodes[k] = {"dim": d, "lo": x[f"lo{d}"], "hi": x[f"hi{d}"] + 1, "goal": x["w"] * (todo[k] // 2) / todo[k]}
        cuts = _snapped(now, nodes, _find_cuts(now, nodes, n_dims), n_dims, snap * total / leaves) if nodes else {}
        after = {}
        for k, m in todo.items():
            if m == 1:
                shard_of[k] = None
            else:                          # an empty node still splits, so that shard numbers stay the tree's
                after[2 * k], after[2 * k + 1] = m // 2, m - m // 2
        levels.append([Cut(k, nodes[k]["dim"], c, 2 * k, 2 * k + 1) for k, c in cuts.items()])
        todo = after
    depth = max(k.bit_length() for k in shard_of)
    order = sorted(shard_of, key=lambda k: (k << (depth - k.bit_length()), k))
    names = _table(meta.sparkSession, [(k, i) for i, k in enumerate(order)], "_leaf long, shard int")
    out = _assigned(meta, [c for c in levels if c], n_dims)
    return out.join(F.broadcast(names), out["_node"] == names["_leaf"]).drop("_node", "_leaf", *[f"_r{d}" for d in range(n_dims)])


def sharded(df: DataFrame, leaves: int = SHARDS, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): one row per
    row of ``df``; slots follow doc_id inside a shard."""
    placed = kd_tree(metadata(df), dimensions, leaves)
    placed = ranked(placed.select("doc_id", "size", "text_crc32", "shard"), ["shard", "doc_id", "text_crc32"], "_row")
    first = placed.groupBy("shard").agg(F.min("_row").alias("_first"))       # one row a shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_row") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def shard_count(df: DataFrame, target_bytes: int) -> int:
    """How many shards leave about ``target_bytes`` in each."""
    total = metadata(df).agg(F.sum("size")).first()[0] or 0
    return max(1, -(-total // target_bytes))
