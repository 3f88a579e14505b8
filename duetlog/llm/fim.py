"""Fill-in-middle rewriting with a learned rank index over token boundaries.

A text's units are runs of white space with the word behind them (white space
at the end is a unit of its own); boundary ``r`` is the offset after ``r``
units.  Boundaries grow with their rank, so a text's are held as a learned
index: dyadic runs of ranks, each a straight line through its two end points
that misses no boundary of the run by more than ``MAX_ERROR`` code points (a
run that fits worse is halved), and one signed byte a boundary, the residual
between line and boundary.  A cut predicts its offset from the line of its
rank and adds the residual: exact, without looking at the other boundaries.

All runs of one length of a whole slice of texts are fitted at once, so the
work is a few vector passes over the boundaries.  ``rank_index`` returns the
index, ``transformed`` the rewritten texts, ``restored`` the texts rebuilt
from rewritten ones.

Defined results: a null or empty text has no unit, the form ``plain`` and the
output ''; a null id hashes as the empty string; a text that holds a marker
stays plain; very long texts are cut whole, one at a time; repeated rows give
equal rows (the draw depends on id and seed alone); an empty table gives an
empty result; extra columns are passed by, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, slices, string_buffers, task, word_spans

#: Fixed values of the output format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Largest miss of a line, so that a residual fits a signed byte.
MAX_ERROR = 127
#: Ranks in the longest run tried.
LONGEST = 1 << 14
SEED = 42
RATE = 50
SPM_RATE = 80


def boundaries(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, bounds): the boundaries of text i, as code points from its
    start, are ``places[bounds[i]:bounds[i + 1]]`` (the first is 0)."""
    _, ends, words = word_spans(offsets, data)
    n = len(offsets) - 1
    sizes = np.diff(words)
    last = np.where(sizes > 0, ends[np.maximum(words[1:] - 1, 0)] if len(ends) else 0, offsets[:-1])
    tail = (offsets[1:] > last).astype(np.int64)                 # white space at the end
    bounds = np.concatenate([[0], np.cumsum(sizes + tail + 1)])
    at = np.empty(bounds[-1], np.int64)
    at[bounds[:-1]] = offsets[:-1]
    inner = np.arange(len(ends)) - np.repeat(words[:-1] - bounds[:-1], sizes) + 1
    at[inner] = ends
    closed = np.flatnonzero(tail)
    at[bounds[closed + 1] - 1] = offsets[closed + 1]
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points[at] - np.repeat(points[offsets[:-1]], np.diff(bounds)), bounds


class RankIndex:
    """Line segments and residuals of many texts' boundaries."""

    def __init__(self, places: np.ndarray, bounds: np.ndarray, max_error: int = MAX_ERROR):
        rank = np.arange(len(places)) - np.repeat(bounds[:-1], np.diff(bounds))
        first, last = bounds[:-1], bounds[1:] - 1
        size = 1
        while size < LONGEST and size < (last - first + 1).max(initial=1):
            size *= 2
        text = np.arange(len(bounds) - 1)
        runs = -(-(last - first + 1) // size)
        text = np.repeat(text, runs)
        lo = first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)) * size
        done, residual = [], np.zeros(len(places), np.int8)
        while len(lo):
            hi = np.minimum(lo + size - 1, last[text])
            slope = (places[hi] - places[lo]) / np.maximum(hi - lo, 1)
            lens = hi - lo + 1
            start = np.cumsum(lens) - lens
            at = np.arange(int(lens.sum())) - np.repeat(start - lo, lens)
            line = np.floor(np.repeat(slope, lens) * (at - np.repeat(lo, lens)) + 0.5).astype(np.int64)
            miss = places[at] - np.repeat(places[lo], lens) - line
            fits = np.maximum.reduceat(np.abs(miss), start) <= max_error
            inside = np.repeat(fits, lens)
            residual[at[inside]] = miss[inside]
            done.append((text[fits], rank[lo[fits]], slope[fits], places[lo[fits]]))
            size = max(size // 2, 1)
            text, lo, hi = text[~fits], lo[~fits], hi[~fits]
            twice = lo + size <= hi
            lo, text = np.concatenate([lo, lo[twice] + size]), np.concatenate([text, text[twice]])
        text, start, slope, base = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64),) * 4
        order = np.lexsort((start, text))
        self.text, self.start, self.slope, self.base = text[order], start[order], slope[order], base[order]
        self.segments = np.searchsorted(self.text, np.arange(len(bounds)))
        self.residual, self.bounds = residual, bounds

    def place(self, i: int, rank: int) -> int:
        """The offset of boundary ``rank`` of text ``i``."""
        a, b = self.segments[i], self.segments[i + 1]
        s = a + int(np.searchsorted(self.start[a:b], rank, side="right")) - 1
        line = int(np.floor(self.slope[s] * (rank - self.start[s]) + 0.5))
        return int(self.base[s]) + line + int(self.residual[self.bounds[i] + rank])


def rank_index(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n, starts, slopes, bases, residuals): the index of every text.
    Boundary r = base + floor(slope * (r - start) + 0.5) + residual byte r of
    the last segment that starts at or under r."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            places, bounds = boundaries(*string_buffers(b.column(1)))
            x = RankIndex(places, bounds)
            cut = pa.array(x.segments, pa.int32())
            raw = [x.residual[s:e].tobytes() for s, e in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(bounds) - 1), pa.ListArray.from_arrays(cut, pa.array(x.start, pa.int64())),
                 pa.ListArray.from_arrays(cut, pa.array(x.slope, pa.float64())),
                 pa.ListArray.from_arrays(cut, pa.array(x.base, pa.int64())), pa.array(raw, pa.binary())],
                names=["key", "n", "starts", "slopes", "bases", "residuals"])

    sent = df.select(column(df, key).alias("key"), column(df, text).cast("string").alias("t"))
    kind = df.schema[key].dataType.simpleString()
    return sent.mapInArrow(task(run), f"key {kind}, n long, starts array<long>, slopes array<double>, "
                                      "bases array<long>, residuals binary")


def draws(key: str, seed: int) -> list[int]:
    """Four unsigned 32-bit draws of a row."""
    h = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(h[i: i + 8], 16) for i in range(0, 32, 8)]


def rewrite(text: str, cuts: tuple[int, int], spm: bool) -> str:
    """``text`` with its middle moved to the end."""
    prefix, middle, suffix = text[: cuts[0]], text[cuts[0]: cuts[1]], text[cuts[1]:]
    if spm:
        return "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def rebuild(output: str, form: str) -> str:
    """The text behind a rewritten one.  Texts that are rewritten hold no
    marker and none can arise at a joint, so each marker is found once."""
    if form == "plain":
        return output
    if form == "psm":
        prefix, _, rest = output[len(PREFIX):].partition(SUFFIX)
        suffix, _, middle = rest.partition(MIDDLE)
    else:
        suffix, _, rest = output[len(SUFFIX):].partition(PREFIX)
        prefix, _, middle = rest.partition(MIDDLE)
    return prefix + middle + suffix


def transformed(df: DataFrame, text: str = "text", key: str = "doc_id", rate: int = RATE, spm_rate: int = SPM_RATE,
                seed: int = SEED) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output): every text cut in
    three at two drawn boundaries; ``rate`` percent are rewritten, of these
    ``spm_rate`` percent with the suffix first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            places, bounds = boundaries(*string_buffers(b.column(2)))
            index, units = RankIndex(places, bounds), np.diff(bounds) - 1
            forms, prefix, middle, out = [], [], [], []
            for i, (k, t) in enumerate(zip(b.column(1), b.column(2))):
                t, n = t.as_py() or "", int(units[i])
                h = draws(k.as_py() or "", seed)
                if not t or h[2] % 100 >= rate or PREFIX in t or SUFFIX in t or MIDDLE in t:
                    forms.append("plain"), prefix.append(None), middle.append(None), out.append(t)
                    continue
                low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
                cuts = index.place(i, low), index.place(i, high)
                spm = h[3] % 100 < spm_rate
                forms.append("spm" if spm else "psm"), prefix.append(cuts[0]), middle.append(cuts[1] - cuts[0])
                out.append(rewrite(t, cuts, spm))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(units), pa.array(forms, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(out, pa.string())],
                names=["key", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = df.schema[key].dataType.simpleString()
    sent = df.select(column(df, key).alias("key"), column(df, key).cast("string").alias("k"),
                     column(df, text).cast("string").alias("t"))
    return sent.mapInArrow(task(run), f"key {kind}, n long, form string, prefix_chars long, middle_chars long, "
                                      "output string")


def restored(df: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """``df`` with the text rebuilt from ``output`` and ``form`` alone, by
    built-in functions; the marker places are found once each."""
    out, kind = column(df, output), column(df, form)

    def parts(first: str, second: str):
        """(piece behind the first marker, behind the second, behind <M>)."""
        a, m = F.locate(second, out, len(first) + 1), F.locate(MIDDLE, out, len(first) + 1)
        return (F.substring(out, F.lit(len(first) + 1), a - len(first) - 1),
                F.substring(out, a + len(second), m - a - len(second)),
                F.substring(out, m + len(MIDDLE), F.length(out)))

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    suffix2, prefix2, middle2 = parts(SUFFIX, PREFIX)
    return df.withColumn(name, F.when(kind == "psm", F.concat(prefix, middle, suffix)).when(
        kind == "spm", F.concat(prefix2, middle2, suffix2)).otherwise(out))


def digests(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``transformed`` and ``restored`` with hashes for texts."""
    done = restored(transformed(df, key=key))
    return done.select(F.col("key").alias(key), "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored"), 256).alias("restored_sha256"))


def oracle_sql() -> str:
    """The same in DuckDB, by joining units up to each cut."""
    unit = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
    h = [f"CAST('0x' || substr(hex, {1 + 8 * i}, 8) AS BIGINT)" for i in range(4)]
    return f"""
WITH a AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
b AS (SELECT *, regexp_extract_all(t, '{unit}') AS u FROM a),
c AS (SELECT *, len(u) AS n, {h[0]} % (len(u) + 1) AS r1, {h[1]} % (len(u) + 1) AS r2,
  CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR {h[2]} % 100 >= {RATE}
       THEN 'plain' WHEN {h[3]} % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM b),
d AS (SELECT *, array_to_string(u[1:least(r1, r2)], '') AS p, array_to_string(u[least(r1, r2) + 1:greatest(r1, r2)], '') AS m,
  array_to_string(u[greatest(r1, r2) + 1:], '') AS s FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m
    ELSE '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m END) AS output_sha256,
  sha256(CASE WHEN form = 'plain' THEN t ELSE p || m || s END) AS restored_sha256 FROM d"""
