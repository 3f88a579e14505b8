"""Substring de-duplication by de Bruijn compaction of repeated word k-mers.

Edges are windows of ``WINDOW`` consecutive words; an edge is repeated when
its words start anywhere else too.  Listing every edge would move many times
the corpus, so edges travel compacted:

1. *Paths.*  Each edge has an anchor, its least ``ANCHOR``-word k-mer; equal
   edges have equal anchors.  Consecutive edges with the same anchor
   occurrence form a path (an unbranched piece of the graph, up to 13 edges).
   A path's content hash stands for all its edges.  Inside a task's slice of
   the corpus equal paths are merged first, so a passage that a third of all
   documents share sends one row per slice, not one per document.
2. *Repeats.*  Rows meet on the anchor.  Every occurrence of a path but the
   first is repeated as a whole.  Where an anchor has several paths (a repeat
   begins or ends there) the first occurrence of each is expanded into single
   edges, which meet on a 128-bit digest of their words.
3. *Sources.*  The words at the coordinates of every first occurrence are read
   back from its text and digested (128-bit BLAKE2).
4. *Compaction.*  Repeated pieces are the nodes' links: a piece and the one
   that follows it in a document form a link, links give in- and out-degrees,
   and a join finds the links between two pieces that have no other
   continuation on either side.  Pieces along such links, with sources that
   follow one another too, are compacted into one span.
5. *Verification.*  A span carries the digests of its source's words, one a
   piece; a piece counts only if the document's own words there have the same
   digest.  Words covered by verified pieces go.

Defined results: a null text has no words; texts shorter than a window keep
everything; rows that repeat a doc_id with the same text are both the first
occurrence and treated alike; a null doc_id compares as larger than any other
(ids are below 2**62), among themselves by a hash of the text; order among
equal starts is by doc_id.  Where different words collide on all 64 bits of
their hashes (which crafted words can do) a later piece is compared with the
first one's words, found different, and kept, also where a third one has its words.  Extra columns are passed by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, mixed, saved, slices, string_buffers, task, window_hashes, word_hashes, word_spans

WINDOW = 20
ANCHOR = 8
_RADIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
_PLACE_BITS = 26
_NO_ID = 1 << 62                 # from here on: stand-ins for null doc_ids, one a text
_U = np.uint64


class Paths(NamedTuple):
    """Runs of edges with one anchor occurrence, of a slice of texts."""
    text: np.ndarray             # number of the text
    start: np.ndarray            # first edge, as a word place in its text
    size: np.ndarray             # edges
    anchor: np.ndarray
    path: np.ndarray             # hash of the whole run
    edges: np.ndarray            # hash of every edge of the slice; only those inside a text are used
    bounds: np.ndarray           # first word of every text


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def paths(words: np.ndarray, bounds: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> Paths:
    """The paths of texts whose word hashes are ``words[bounds[i]:bounds[i + 1]]``."""
    none = np.zeros(0, np.int64)
    edges = window_hashes(words, window, _RADIX[0])
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = text[: len(edges)] == text[window - 1:] if len(edges) else np.zeros(0, bool)
    if not inside.any():
        return Paths(none, none, none, none.astype(np.uint64), none.astype(np.uint64), edges, bounds)
    grams = window_hashes(words, anchor, _RADIX[2])
    low = _U((1 << _PLACE_BITS) - 1)
    place = np.arange(len(grams), dtype=np.uint64)
    least = _sliding_min((grams & ~low) | (place & low), window - anchor + 1) & low      # leftmost of equal ones
    at = np.flatnonzero(inside)
    new = np.ones(len(at), bool)
    new[1:] = (least[at][1:] != least[at][:-1]) | (np.diff(at) > 1)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at)))
    step = np.arange(len(at)) - np.repeat(first, size)
    path = np.add.reduceat(mixed(edges[at] + step.astype(np.uint64) * _U(_RADIX[1])), first) + size.astype(np.uint64)
    begin = at[first]
    # the place of the anchor in full: it lies in the window, whatever the stored bits
    offset = (least[begin].astype(np.int64) - begin) & int(low)
    return Paths(text[begin], begin - bounds[text[begin]], size, grams[begin + offset], mixed(path), edges, bounds)


def _words(col) -> tuple[np.ndarray, np.ndarray]:
    off, data = string_buffers(col)
    starts, ends, bounds = word_spans(off, data)
    return word_hashes(data, starts, ends), bounds


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, dtype=np.uint64).view(np.int64))


def _texts(df: DataFrame) -> DataFrame:
    text = column(df, "text").cast("string")
    stand_in = F.lit(_NO_ID) + F.xxhash64(text).bitwiseAND(F.lit((1 << 61) - 1))
    return df.select(F.coalesce(column(df, "doc_id").cast("long"), stand_in).alias("doc"), text.alias("t"))


# ---------------------------------------------------------------- 1 and 2: repeated pieces

_PLACE = pa.struct([("doc", pa.int64()), ("start", pa.int32())])


def path_rows(df: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, path, size, doc, start, later): the first occurrence of every
    path of a slice, and the slice's later ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t", 8 << 20):
            p = paths(*_words(b.column(1)), window, anchor)
            doc = b.column(0).to_numpy(zero_copy_only=False)[p.text] if len(p.text) else np.zeros(0, np.int64)
            order = np.lexsort((p.start, doc, p.path, p.anchor))
            a, h = p.anchor[order], p.path[order]
            new = np.ones(len(order), bool)
            new[1:] = (a[1:] != a[:-1]) | (h[1:] != h[:-1])
            lead, rest = order[new], order[~new]
            group = np.cumsum(new)[~new] - 1
            bounds = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=len(lead)))]).astype(np.int32)
            later = pa.StructArray.from_arrays([pa.array(doc[rest]), pa.array(p.start[rest].astype(np.int32))],
                                               fields=list(_PLACE))
            yield pa.RecordBatch.from_arrays(
                [_signed(p.anchor[lead]), _signed(p.path[lead]), pa.array(p.size[lead].astype(np.int32)), pa.array(doc[lead]),
                 pa.array(p.start[lead].astype(np.int32)), pa.ListArray.from_arrays(pa.array(bounds), later)],
                names=["anchor", "path", "size", "doc", "start", "later"])

    return _texts(df).mapInArrow(
        task(run), "anchor long, path long, size int, doc long, start int, later array<struct<doc: long, start: int>>")


def pieces(rows: DataFrame) -> DataFrame:
    """(doc, start, size, check, src_doc, src_start): repeated occurrences of
    paths; with a null source, first occurrences to be expanded into edges."""
    same = Window.partitionBy("anchor", "path").orderBy("doc", "start")
    of_anchor = Window.partitionBy("anchor")
    seen = rows.select(
        "*", F.first("doc").over(same).alias("src_doc"), F.first("start").over(same).alias("src_start"),
        (F.min("path").over(of_anchor) != F.max("path").over(of_anchor)).alias("branches"))
    # (a repeated row with the same doc_id is as early as the first occurrence)
    lead = (F.col("doc") == F.col("src_doc")) & (F.col("start") == F.col("src_start"))

    def place(doc, start, expand):
        return F.struct(doc.alias("doc"), start.alias("start"), F.lit(expand).alias("expand"))

    none = F.expr("CAST(array() AS array<struct<doc: long, start: int, expand: boolean>>)")
    own = F.when(~lead, F.array(place(F.col("doc"), F.col("start"), False))).when(
        F.col("branches"), F.array(place(F.col("doc"), F.col("start"), True))).otherwise(none)
    later = F.transform(F.filter("later", lambda o: (o["doc"] != F.col("src_doc")) | (o["start"] != F.col("src_start"))),
                        lambda o: place(o["doc"], o["start"], False))
    each = seen.select("size", "path", "src_doc", "src_start", F.explode(F.concat(own, later)).alias("at"))
    return each.select(F.col("at.doc").alias("doc"), F.col("at.start").alias("start"), "size", F.col("path").alias("check"),
                       F.when(~F.col("at.expand"), F.col("src_doc")).alias("src_doc"),
                       F.when(~F.col("at.expand"), F.col("src_start")).alias("src_start"))


# ---------------------------------------------------------------- 3: the sources' words

def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _lists(col) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """(row of each entry, fields) of a list<struct> column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten()
    row = np.repeat(np.arange(len(col)), col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    return row, tuple(flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields))


def _holds(p: Paths, text, start, size, check) -> np.ndarray:
    """Which paths lie at their place (rows that share a doc_id may differ)."""
    if not len(p.text):
        return np.zeros(len(text), bool)
    mine, at = p.bounds[p.text] + p.start, p.bounds[text] + start
    i = np.minimum(np.searchsorted(mine, at), len(mine) - 1)
    return (mine[i] == at) & (p.text[i] == text) & (p.size[i] == size) & (p.path[i] == check.view(np.uint64))


def digests(df: DataFrame, found: DataFrame, window: int, anchor: int) -> DataFrame:
    """(edge, doc, start, node, digest): the words of every source of
    ``found`` (one row a path) and of every edge of its paths to be expanded,
    read at their coordinates.  ``node`` names the piece's words."""
    at_source = found.where("src_doc is not null").select(
        F.col("src_doc").alias("doc"), F.col("src_start").alias("start"), "size", "check", F.lit(False).alias("edge"))
    to_expand = found.where("src_doc is null").select("doc", "start", "size", "check", F.lit(True).alias("edge"))
    asked = at_source.unionByName(to_expand).groupBy("doc").agg(
        F.collect_set(F.struct("start", "size", "check", "edge")).alias("asked"))      # at most the paths of a text
    texts = _texts(df).join(asked, "doc").select("doc", "t", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            off, data = string_buffers(b.column(1))
            raw = data.tobytes()
            starts, ends, bounds = word_spans(off, data)
            p = paths(word_hashes(data, starts, ends), bounds, window, anchor)
            text, (start, size, check, edge) = _lists(b.column(2))
            start, size, check, edge = start.astype(np.int64), size.astype(np.int64), check.astype(np.int64), edge.astype(bool)
            ok = np.flatnonzero(_holds(p, text, start, size, check))
            ok = ok[np.argsort(text[ok], kind="stable")]
            doc = b.column(0).to_numpy(zero_copy_only=False)
            out: tuple[list, ...] = ([], [], [], [], [])
            now, words = -1, []
            for t, s, n, c, e in zip(text[ok].tolist(), start[ok].tolist(), size[ok].tolist(), check[ok].tolist(), edge[ok].tolist()):
                if t != now:
                    now, words = t, raw[off[t]: off[t + 1]].split()
                for first, k in ((x, 1) for x in range(s, s + n)) if e else ((s, n),):
                    for column_, value in zip(out, (e, int(doc[t]), first, c, _digest(words[first: first + k + window - 1]))):
                        column_.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.bool_()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()),
                 pa.array(out[3], pa.int64()), pa.array(out[4], pa.binary())], names=["edge", "doc", "start", "check", "digest"])

    rows = texts.mapInArrow(task(run), "edge boolean, doc long, start int, check long, digest binary")
    return rows.select("edge", "doc", "start", F.when(F.col("edge"), F.xxhash64("digest")).otherwise(
        F.xxhash64("doc", "start", "check")).alias("node"), "digest")


def repeated_edges(edges: DataFrame) -> DataFrame:
    """(doc, start, size, node, src_doc, src_start): edges whose words start
    earlier too; the source is the first of them."""
    first = edges.groupBy("digest").agg(F.min(F.struct("doc", "start")).alias("src"), F.count(F.lit(1)).alias("n"))
    found = edges.join(first.where("n > 1").drop("n"), "digest")
    return found.where((F.col("src.doc") != F.col("doc")) | (F.col("src.start") != F.col("start"))).select(
        "doc", "start", F.lit(1).alias("size"), "node", F.col("src.doc").alias("src_doc"), F.col("src.start").alias("src_start"))


# ---------------------------------------------------------------- 4: compaction

def links(parts: DataFrame) -> DataFrame:
    """(doc, start, size, node, next, onward): every piece with the node that
    follows it in its document; ``onward`` if its source goes on there too."""
    parts = parts.distinct()             # a repeated row lists its pieces again
    w = Window.partitionBy("doc").orderBy("start", "node")
    after = F.lead(F.struct("start", "node", "src_doc", "src_start")).over(w)
    out = parts.withColumn("after", after)
    follows = F.col("after.start") == F.col("start") + F.col("size")
    return out.select("doc", "start", "size", "node", F.when(follows, F.col("after.node")).alias("next"),
                      F.coalesce(follows & (F.col("after.src_doc") == F.col("src_doc"))
                                 & (F.col("after.src_start") == F.col("src_start") + F.col("size")), F.lit(False)).alias("onward"))


def unbranched(linked: DataFrame) -> DataFrame:
    """(node): nodes with one follower that has no other predecessor."""
    pairs = linked.where("next is not null")
    out = pairs.groupBy("node").agg(F.min("next").alias("next"), F.max("next").alias("other")).where("next = other")
    into = pairs.groupBy("next").agg(F.min("node").alias("one"), F.max("node").alias("two")).where("one = two")
    return out.join(into, "next").select("node")


def compacted(linked: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc, start, parts): pieces along unbranched links as one span;
    ``parts`` are (start, size, digest of the source's words)."""
    known = nodes.join(unbranched(linked).withColumn("straight", F.lit(True)), "node", "left")
    each = linked.join(known, "node").select(
        "doc", "start", "size", "digest", (F.col("onward") & F.coalesce("straight", F.lit(False))).alias("joins"))
    w = Window.partitionBy("doc").orderBy("start", "digest")
    goes_on = F.lag("joins").over(w) & (F.lag(F.col("start") + F.col("size")).over(w) == F.col("start"))
    marked = each.withColumn("fresh", F.when(goes_on, 0).otherwise(1)).withColumn("span", F.sum("fresh").over(w))
    return marked.groupBy("doc", "span").agg(
        F.min("start").alias("start"), F.array_sort(F.collect_list(F.struct("start", "size", "digest"))).alias("parts")).drop("span")


def repeated_spans(df: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc, start, parts): compacted spans of repeated edges."""
    found = saved(pieces(path_rows(df, window, anchor)), "pieces")
    read = saved(digests(df, found, window, anchor), "digests")
    whole = found.where("src_doc is not null").select(
        "doc", "start", "size", F.xxhash64("src_doc", "src_start", "check").alias("node"), "src_doc", "src_start")
    linked = saved(links(whole.unionByName(repeated_edges(read.where("edge").drop("edge")))), "links")
    nodes = read.groupBy("node", "digest").agg(F.lit(1).alias("_")).drop("_")
    return compacted(linked, nodes)


# ---------------------------------------------------------------- 5: verification and removal

def removed(df: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept]) per row of ``df``:
    words covered by a window that starts earlier too are removed."""
    spans = repeated_spans(df, window, anchor).groupBy("doc").agg(F.flatten(F.collect_list("parts")).alias("parts"))
    texts = _texts(df).join(spans, "doc", "left").select("doc", "t", "parts")
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * with_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            off, data = string_buffers(b.column(1))
            raw = data.tobytes()
            n_words, n_removed, shas, kept = [], [], [], []
            for i in range(b.num_rows):
                w = raw[off[i]: off[i + 1]].split()
                n_words.append(len(w))
                cut = None
                for part in b.column(2)[i].as_py() or ():
                    s, e = part["start"], part["start"] + part["size"] + window - 1
                    if e <= len(w) and _digest(w[s:e]) == part["digest"]:
                        if cut is None:
                            cut = np.zeros(len(w) + 1, np.int64)
                        cut[s] += 1
                        cut[e] -= 1
                if cut is not None:
                    stay = np.flatnonzero(np.cumsum(cut[:-1]) == 0).tolist()
                    n_removed.append(len(w) - len(stay))
                    w = [w[j] for j in stay]
                else:
                    n_removed.append(0)
                out = b" ".join(w)
                shas.append(hashlib.sha256(out).hexdigest())
                if with_text:
                    kept.append(out.decode())
            doc = b.column(0).to_numpy(zero_copy_only=False)
            columns = [pa.array(doc, mask=doc >= _NO_ID), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                       pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.string())] * with_text, names=names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return texts.mapInArrow(task(run), schema + (", kept string" if with_text else ""))
