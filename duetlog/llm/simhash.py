"""SimHash near-duplicates with pivot distance tables.

Fingerprint: lower-case A-Z, words, word shingles (repeats count), XXH64 of
each; a bit is set when more than half of the hashes have it.  Two
fingerprints link when they differ in at most ``max_bits`` bits.

Search.  ``PIVOTS`` are reference fingerprints.  The table of a fingerprint
holds its Hamming distance to every pivot, kept per bit group: the distance
on one of ``max_bits + 2`` groups of bits is a coordinate of its own, and the
whole distance is the sum over the groups.  A coordinate of two fingerprints
differs by no more than their bits do, so

* a linked pair has equal coordinates on the two or more groups without a
  differing bit: rows meet on the coordinates of two groups (an equi-join
  key), never by comparing all pairs;
* of the pairs that meet, those whose largest difference over the whole
  distances exceeds ``max_bits`` are discarded;
* the survivors are verified by counting differing bits.

Equal fingerprints are one class before the search, so copies never make
pairs.  A key shared by up to ``DENSE`` classes is worked in one block of a
task, which emits a spanning star of its links; a key shared by more goes to
the hub form (``_hub_links``), a grouped minimum whose size is linear in the
classes.  No link is lost either way.

Defined results: a null or empty text (no word) has fingerprint 0 and links
like any other; fewer words than a shingle make one shingle of them all;
repeated rows share a class; a component's id is its least non-null doc_id
(null when it has none); extra columns are passed by; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, saved, slices, string_buffers, task
from .components import roots

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Classes under one key that are compared within a task.
DENSE = 4096
#: Runs up to this size are compared pair by pair over the whole batch.
SMALL = 32
#: Reference fingerprints, by a rule: 32 draws of a seeded generator.
PIVOTS = np.random.default_rng(64).integers(0, 1 << 64, size=32, dtype=np.uint64, endpoint=False)
#: Pivots whose group distances make a key (four bits each, two groups in 64 bits).
KEY_PIVOTS = 8
DISTANCE_ROWS = 128


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of one UTF-8 text."""
    w = text.lower().split()         # bytes: only A-Z change, only ASCII white space splits
    if not w:
        return 0
    if len(w) < words:
        shingles, n = [b" ".join(w)], 1
    else:
        shingles, n = map(b" ".join, zip(*[w[i:] for i in range(words)])), len(w) - words + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=n)
    bits = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = h[at: at + (1 << 15)]
        bits += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = SHINGLE_WORDS,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, columns ``keep``): the fingerprint of every whole text as
    a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            off, data = string_buffers(b.column(1))
            raw = data.tobytes()
            fp = np.fromiter((fingerprint(raw[off[i]: off[i + 1]], words) for i in range(b.num_rows)),
                             dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]],
                                             names=["doc_id", "fp", *keep])

    sent = df.select(column(df, key).cast("long").alias("doc_id"), column(df, text).cast("string").alias("t"),
                     *[column(df, c) for c in keep])
    return sent.mapInArrow(task(run), "doc_id long, fp long" + "".join(
        f", `{c}` {df.schema[c].dataType.simpleString()}" for c in keep))


def group_masks(max_bits: int) -> np.ndarray:
    """``max_bits + 2`` disjoint groups that cover the 64 bits: a linked pair
    leaves at least two of them untouched."""
    edges = np.linspace(0, 64, max_bits + 3).astype(int)
    return np.array([((1 << int(b - a)) - 1) << int(a) for a, b in zip(edges, edges[1:])], dtype=np.uint64)


def pivot_table(fp: np.ndarray, mask: int = (1 << 64) - 1, pivots: np.ndarray = PIVOTS) -> np.ndarray:
    """Distances (n, pivots) on the bits of ``mask``."""
    return np.bitwise_count((fp[:, None] ^ pivots[None, :]) & np.uint64(mask)).astype(np.int8)


def _keys(classes: DataFrame, max_bits: int) -> DataFrame:
    """(pair, key, fp): for every two groups, their coordinates as one key."""
    masks = group_masks(max_bits)
    shift = (np.arange(KEY_PIVOTS, dtype=np.uint64) * np.uint64(4))[None, :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            part = []
            for m in masks:
                near = np.minimum(pivot_table(fp, int(m), PIVOTS[:KEY_PIVOTS]), 15).astype(np.uint64)
                part.append((near << shift).sum(axis=1, dtype=np.uint64))
            for p, (i, j) in enumerate(combinations(range(len(masks)), 2)):
                key = (part[i] << np.uint64(32)) | part[j]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), p, np.int32)), pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))],
                    names=["pair", "key", "fp"])

    return classes.select("fp").mapInArrow(task(run), "pair int, key long, fp long")


def _close(fp: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of the pairs (a, b) survive the pivot table and the bit count."""
    ok = np.abs(table[a] - table[b]).max(axis=1) <= max_bits
    ok[ok] = np.bitwise_count(fp[a[ok]] ^ fp[b[ok]]) <= max_bits
    return ok


def _small_links(fp: np.ndarray, run_id: np.ndarray, max_bits: int):
    """Links among rows of equal ``run_id`` (short, adjacent runs)."""
    table, left, right = pivot_table(fp), [], []
    rows = np.arange(len(fp))
    step = 1
    while True:
        a = rows[:-step][run_id[:-step] == run_id[step:]] if step < len(fp) else rows[:0]
        if len(a) == 0:
            break
        a = a[_close(fp, table, a, a + step, max_bits)]
        left.append(a)
        right.append(a + step)
        step += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (rows[:0], rows[:0])


def _dense_links(fp: np.ndarray, max_bits: int):
    """Star links (least member to the rest) of the components inside one
    key of many classes."""
    n, table = len(fp), pivot_table(fp)
    near = np.zeros((n, n), dtype=bool)
    for at in range(0, n, DISTANCE_ROWS):
        cut = slice(at, min(at + DISTANCE_ROWS, n))
        ok = np.ones((cut.stop - at, n), dtype=bool)
        for p in range(table.shape[1]):              # discard by the largest coordinate difference
            ok &= np.abs(table[cut, p][:, None] - table[None, :, p]) <= max_bits
        near[cut] = ok & (np.bitwise_count(fp[cut][:, None] ^ fp[None, :]) <= max_bits)
    seen, left, right = np.zeros(n, dtype=bool), [], []
    for i in range(n):
        if seen[i]:
            continue
        member, front = np.zeros(n, dtype=bool), np.array([i])
        member[i] = True
        while len(front):
            new = near[front].any(axis=0) & ~member
            member |= new
            front = np.flatnonzero(new)
        seen |= member
        other = np.flatnonzero(member)[1:]
        left.append(np.full(len(other), i))
        right.append(other)
    return np.concatenate(left), np.concatenate(right)


def _meet(keys: DataFrame, max_bits: int, dense: int) -> DataFrame:
    """Links of the classes that share a key: ``(pair, a, b)``; the rows of a
    key that more than ``dense`` classes share come back as ``(pair, a, null)``.
    Rows arrive sorted by key; at most ``dense`` rows of a key are held."""
    schema = pa.schema([("pair", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])

    def out(pair, a, b=None):
        a = np.asarray(a, dtype=np.uint64).view(np.int64)
        b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(np.asarray(b, dtype=np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(pair, dtype=np.int32)), pa.array(a), b], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = np.zeros(0, np.int32)
        key, fp, hot = np.zeros(0, np.int64), np.zeros(0, np.uint64), None

        def work(pair, key, fp):
            new = np.ones(len(fp), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])
            run_id = np.cumsum(new)
            size = np.bincount(run_id)[run_id]
            few = (size > 1) & (size <= SMALL)
            if few.any():
                f, p = fp[few], pair[few]
                a, b = _small_links(f, run_id[few], max_bits)
                yield out(p[a], f[a], f[b])
            for r in np.unique(run_id[size > SMALL]):
                at = slice(int(np.searchsorted(run_id, r)), int(np.searchsorted(run_id, r, side="right")))
                if at.stop - at.start > dense:
                    yield out(pair[at], fp[at])
                else:
                    a, b = _dense_links(fp[at], max_bits)
                    yield out(pair[at][a], fp[at][a], fp[at][b])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            p, k = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            f = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            if hot is not None:                       # the rest of a key that is already known to be large
                n = int(((p == hot[0]) & (k == hot[1])).sum())
                if n:
                    yield out(p[:n], f[:n])
                if n == len(f):
                    continue
                p, k, f, hot = p[n:], k[n:], f[n:], None
            pair, key, fp = np.concatenate([pair, p]), np.concatenate([key, k]), np.concatenate([fp, f])
            last = int(np.flatnonzero((key != key[-1]) | (pair != pair[-1]))[-1]) + 1 \
                if ((key != key[-1]) | (pair != pair[-1])).any() else 0
            yield from work(pair[:last], key[:last], fp[:last])
            pair, key, fp = pair[last:], key[last:], fp[last:]
            if len(fp) > dense:
                hot = (pair[0], key[0])
                yield out(pair, fp)
                pair, key, fp = pair[:0], key[:0], fp[:0]
        yield from work(pair, key, fp)

    laid = keys.repartition("pair", "key").sortWithinPartitions("pair", "key", "fp")
    return laid.mapInArrow(task(run), "pair int, a long, b long")


def _hub_links(rows: DataFrame, max_bits: int) -> DataFrame:
    """Links under a crowded key, in size linear in its classes.

    The two groups of the key agree, so linked rows differ in the other bits
    only.  Every row visits the values within ``max_bits // 2 + 1`` flips of
    itself; of two linked rows one is within ``max_bits // 2`` flips of a
    value that the other one visits.  At a value, every visitor links to the
    least of the nearer visitors, from which it differs in at most
    ``max_bits`` bits.  (Rows whose coordinates agree on a group although
    their bits differ meet under another pair of groups.)"""
    masks = group_masks(max_bits)
    free = [[b for b in range(64) if not (int(masks[i]) | int(masks[j])) >> b & 1]
            for i, j in combinations(range(len(masks)), 2)]
    near, far = max_bits // 2, max_bits - max_bits // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for p in np.unique(pairs):
                flips = [(n, sum(1 << b for b in c)) for n in range(far + 1) for c in combinations(free[p], n)]
                flip = np.array([f for _, f in flips], dtype=np.uint64)
                is_near = np.array([n <= near for n, _ in flips])
                mine = fps[pairs == p]
                for at in range(0, len(mine), 256):
                    f = mine[at: at + 256]
                    hub = (f[:, None] ^ flip[None, :]).ravel().view(np.int64)
                    who = np.repeat(f, len(flip)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(hub), p, np.int32)), pa.array(hub), pa.array(who),
                         pa.array(np.tile(is_near, len(f)))], names=["pair", "hub", "fp", "near"])

    visits = rows.select("pair", "a").mapInArrow(task(run), "pair int, hub long, fp long, near boolean")
    least = visits.where("near").groupBy("pair", "hub").agg(F.min("fp").alias("b"))
    return visits.join(least, ["pair", "hub"]).where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def links(classes: DataFrame, max_bits: int = MAX_BITS, dense: int = DENSE) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) whose
    closure is that of all links of at most ``max_bits`` bits."""
    met = saved(_meet(_keys(classes, max_bits), max_bits, dense), "links")
    crowded = met.where("b is null")
    plain = met.where("b is not null").select("a", "b").distinct()
    if crowded.take(1):
        plain = plain.union(_hub_links(crowded, max_bits))
    return plain


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``df``."""
    fps = saved(fingerprints(df, text, key, words), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    root = saved(roots(links(classes, max_bits)), "roots")
    tied = classes.join(root, classes["fp"] == root["node"]).groupBy("root").agg(F.min("least").alias("component"))
    tied = root.join(tied, "root").select(F.col("node").alias("fp"), "component")
    named = classes.join(tied, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id"))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def representatives(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose document stands for its group (least doc_id),
    one row each; rows without a doc_id cannot be named and go."""
    kept = near_duplicates(df, text, key).where("doc_id = component_id").select("doc_id").distinct()
    return df.join(kept.withColumnRenamed("doc_id", key), key, "left_semi").dropDuplicates([key])


def deduplicated(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = SHINGLE_WORDS,
                 max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``df`` for every component of near-equal texts: the least by
    doc_id (null last), then by a hash of the text, then by one of the whole
    row, so a rerun keeps the same.  Rows without a doc_id and rows that share
    one are told apart by their texts."""
    pick, tie = (next(n for n in (name + "_" * i for i in range(len(df.columns) + 1)) if n not in df.columns)
                 for name in ("_pick", "_tie"))
    id_, body = column(df, key), column(df, text).cast("string")
    plain = [column(df, f.name) for f in df.schema.fields
             if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    # the pick names (doc_id, text), nulls included; the tie only orders rows that agree in both
    named = df.withColumns({
        pick: F.sha2(F.concat(F.coalesce(id_.cast("string"), F.lit("-")), F.when(id_.isNull(), "n").otherwise("i"),
                              F.when(body.isNull(), "n").otherwise("t"), F.coalesce(body, F.lit(""))), 256),
        tie: F.xxhash64(*plain)})
    rows = saved(fingerprints(named, text, key, words, (pick, tie)), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", pick, tie)).alias("least"))
    root = saved(roots(links(classes, max_bits)), "roots")
    kept = classes.join(root, classes["fp"] == root["node"], "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(
        F.min("least").alias("least")).select(f"least.{pick}", f"least.{tie}")
    return named.join(kept, [pick, tie], "left_semi").dropDuplicates([pick, tie]).select(*[column(named, c) for c in df.columns])
