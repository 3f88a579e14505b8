"""Ranked lexical search by an Aho-Corasick scan of the documents.

There is no index of documents.  The distinct terms of the items, each put
between two guard bytes, make one automaton, which is broadcast; a single pass
over every whole text (A-Z lowered, every other ASCII non-alphanumeric byte
made a guard) counts its term frequencies, and an output of the automaton maps
to the items that hold the term.  Overlapping outputs may share a guard, so
neighbouring terms are all found.

1. ``scanned``: per document its number of terms and the counts of the items'
   terms, written to the shared folder;
2. corpus counts (documents, terms, document frequencies) by aggregates;
3. each task scores its documents and keeps the best ``top`` of every item
   (the order is total, so the best of the bests is exact); a window over at
   most ``top`` rows an item and task ranks them.

The automaton's size is bounded: items are dealt over as many rounds as keep
the terms of a round near ``ROUND_BYTES`` (counted first); every round scans
all documents and scores its items whole, so nothing is left out.

Defined results: null or empty texts and items have no term; such a document
has score 0 and no row, such an item has no row; repeated documents are
documents of their own; the distinct texts of one item id make one item; a
null doc_id comes last among equal scores, a null item_id is an item like any
other; empty tables give an empty result; extra columns are passed by.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, saved, slices, string_buffers, task

TOP = 20
#: Bytes of distinct terms in one automaton (some 100 bytes of memory each).
ROUND_BYTES = 2 << 20
#: Scores (documents x items) held at once in a task.
TILE = 1 << 21

#: Fixed pattern of a term.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GUARD = 0x20
#: Byte to byte: letters lowered, other ASCII that is no digit to the guard.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [ord(chr(c).lower()) if chr(c).isalnum() else _GUARD for c in range(128)]


def terms(text: Column) -> Column:
    """A text's terms, by built-in functions."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(low, F.lit(TERM), F.lit(0))


def item_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term, q): how often each item holds each term."""
    rows = items.select(column(items, key).alias("item_id"), column(items, text).cast("string").alias("t")).distinct()
    return rows.select("item_id", F.explode(terms(F.col("t"))).alias("term")).groupBy("item_id", "term").agg(
        F.count("*").alias("q"))


def automaton(words: list[str]) -> ahocorasick.Automaton:
    """Guarded words as UTF-8 bytes (one character a byte) to their places."""
    a = ahocorasick.Automaton()
    for i, w in enumerate(words):
        a.add_word(f" {w.encode().decode('latin-1')} ", i)
    if words:
        a.make_automaton()
    return a


def scan(offsets: np.ndarray, data: np.ndarray, machine: ahocorasick.Automaton) -> tuple[np.ndarray, ...]:
    """(terms of each text, text, word, count): the automaton's outputs over
    texts, counted; ``text`` and ``word`` are ascending."""
    n = len(offsets) - 1
    folded = np.full(len(data) + n + 1, _GUARD, np.uint8)       # one guard before every text and at the end
    start = offsets[:-1] + np.arange(n) + 1
    folded[np.arange(len(data)) + np.repeat(np.arange(n) + 1, np.diff(offsets))] = _FOLD[data]
    inside = folded != _GUARD
    begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    sizes = np.diff(np.searchsorted(begins, np.append(start, len(folded))))
    if not len(machine):
        return sizes, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = machine.iter(folded.tobytes().decode("latin-1"))
    pairs = np.fromiter((x for hit in found for x in hit), dtype=np.int64).reshape(-1, 2)
    text = np.searchsorted(start, pairs[:, 0] - 1, side="right") - 1     # the byte before the closing guard
    key, count = np.unique(text * len(machine) + pairs[:, 1], return_counts=True)
    return sizes, key // len(machine), key % len(machine), count


def scanned(documents: DataFrame, words: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, words, tfs): every document's number of terms and the
    counts of those in ``words`` (by place in the list)."""
    shared = documents.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value)
        for b in slices(batches, "t"):
            n, doc, word, count = scan(*string_buffers(b.column(1)), machine)
            cut = pa.array(np.searchsorted(doc, np.arange(b.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), pa.ListArray.from_arrays(cut, pa.array(word, pa.int32())),
                 pa.ListArray.from_arrays(cut, pa.array(count, pa.int64()))], names=["doc_id", "n", "words", "tfs"])

    sent = documents.select(column(documents, key).cast("long").alias("doc_id"),
                            column(documents, text).cast("string").alias("t"))
    return sent.mapInArrow(task(run), "doc_id long, n long, words array<int>, tfs array<long>")


class _Best:
    """The best ``top`` (score, doc) of every item so far, best first."""

    def __init__(self, items: int, top: int):
        self.top, self.score, self.doc = top, np.zeros((items, top), np.int64), np.zeros((items, top), np.int64)

    def take(self, score: np.ndarray, doc: np.ndarray) -> None:
        """Add scores (documents x items) of documents ``doc``."""
        row, item = np.nonzero((score > 0) & (score >= self.score[:, -1]))
        at = [(item, score[row, item], doc[row])]
        touched = np.unique(item)
        held = np.repeat(touched, self.top), self.score[touched].ravel(), self.doc[touched].ravel()
        item, s, d = (np.concatenate(x) for x in zip(*at, held))
        order = np.lexsort((d, -s, item))
        item, s, d = item[order], s[order], d[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = place < self.top
        self.score[item[keep], place[keep]] = s[keep]
        self.doc[item[keep], place[keep]] = d[keep]


def _scores(counts: DataFrame, docs: int, length: int, weight: np.ndarray, cut: np.ndarray, item: np.ndarray,
            times: np.ndarray, items: int, top: int) -> DataFrame:
    """(item_no, score, doc_id): each task's best documents of every item.
    Word t stands in the items ``item[cut[t]:cut[t + 1]]``, ``times`` often."""
    shared = counts.sparkSession.sparkContext.broadcast((weight, cut, item, times))
    null = np.iinfo(np.int64).max            # a document without id comes last among equals

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, ptr, to, q = shared.value
        best, lost = _Best(items, top), _Best(items, top)
        step = max(1, TILE // max(items, 1))
        for whole in batches:
            for b in (whole.slice(a, step) for a in range(0, whole.num_rows, step)):
                n = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                m = 75 + 25 * n * docs // max(length, 1)
                of = b.column(2)
                word, tf = of.flatten().to_numpy(), b.column(3).flatten().to_numpy()
                row = np.repeat(np.arange(b.num_rows), of.value_lengths().to_numpy(zero_copy_only=False))
                part = w[word] * (1_000_000_000 * tf // (1000 * tf + 12 * m[row]))
                fan = ptr[word + 1] - ptr[word]
                at = np.arange(int(fan.sum())) - np.repeat(np.cumsum(fan) - fan - ptr[word], fan)
                score = np.zeros((b.num_rows, items), np.int64)
                np.add.at(score.reshape(-1), np.repeat(row, fan) * items + to[at], np.repeat(part, fan) * q[at])
                id_ = b.column(0)
                gone = np.asarray(id_.is_null())
                doc = id_.fill_null(null).to_numpy(zero_copy_only=False)
                best.take(score[~gone], doc[~gone])
                if gone.any():
                    lost.take(score[gone], doc[gone])
        for x, has_id in ((best, True), (lost, False)):
            no, place = np.nonzero(x.score > 0)
            doc = pa.array(x.doc[no, place], mask=None if has_id else np.ones(len(no), bool))
            yield pa.RecordBatch.from_arrays([pa.array(no, pa.int32()), pa.array(x.score[no, place]), doc],
                                             names=["item_no", "score", "doc_id"])

    return counts.mapInArrow(task(run), "item_no int, score long, doc_id long")


def _round(documents: DataFrame, pairs: DataFrame, top: int) -> DataFrame:
    """All documents ranked for the items of ``pairs`` (item_id, term, q)."""
    spark = documents.sparkSession
    rows = pairs.collect()                   # one round: bounded by ROUND_BYTES of terms
    names = list(dict.fromkeys(r.item_id for r in rows))
    words = sorted({r.term for r in rows})
    number, place = {v: i for i, v in enumerate(names)}, {v: i for i, v in enumerate(words)}
    counts = saved(scanned(documents, words), "lexical-counts")
    n = counts.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("length")).first()
    docs, length = n.docs, n.length or 0
    df = np.zeros(len(words), np.int64)
    for r in counts.select(F.explode("words").alias("word")).groupBy("word").count().collect():
        df[r.word] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    out = sorted((place[r.term], number[r.item_id], r.q) for r in rows)
    word, item, times = np.array(out, np.int64).reshape(-1, 3).T
    best = _scores(counts, docs, length, weight, np.searchsorted(word, np.arange(len(words) + 1)), item, times,
                   len(names), top)
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ids = spark.createDataFrame(list(enumerate(names)), f"item_no int, item_id {pairs.schema['item_id'].dataType.simpleString()}")
    return best.join(F.broadcast(ids), "item_no").select("item_id", "rank", "doc_id", "score")


def ranked(documents: DataFrame, items: DataFrame, top: int = TOP, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every
    item, all documents searched."""
    pairs = saved(item_terms(items), "lexical-items")
    size = pairs.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    rounds = -(-size // round_bytes) or 1
    parts = [pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == i) for i in range(rounds)] if rounds > 1 else [pairs]
    out = None
    for p in parts:
        found = _round(documents, p, top)
        out = found if out is None else out.unionByName(found)
    return out


def oracle_sql() -> str:
    """The same in DuckDB, by joining every document's terms."""
    def split(table, key):
        low = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
        return f"SELECT {key}, unnest(regexp_extract_all({low}, '{TERM}')) AS term FROM {table}"

    return f"""
WITH d AS MATERIALIZED ({split('(SELECT row_number() OVER () AS row, doc_id, text FROM documents)', 'row, doc_id')}),
b AS ({split('(SELECT DISTINCT item_id, text FROM benchmark)', 'item_id')}),
i AS (SELECT item_id, term, count(*) AS q FROM b GROUP BY ALL),
c AS (SELECT count(DISTINCT row) AS docs, count(*) AS length FROM d),
s AS (SELECT row, doc_id, count(*) AS n FROM d GROUP BY ALL),
t AS (SELECT row, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, c GROUP BY term, docs),
x AS (SELECT item_id, doc_id, row, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) AS BIGINT) AS score
      FROM i JOIN t USING (term) JOIN w USING (term) JOIN s USING (row), c GROUP BY item_id, doc_id, row),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, row) AS rank FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= {TOP}"""
