"""Helpers shared by the operators: table access, shared-folder tables and a
vectorised word scanner over Arrow string buffers."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import staging_path

#: Text bytes handled at once inside a task: bounds a worker's memory.
SLICE_BYTES = 4 << 20

#: The six ASCII white-space bytes that separate words: space, \t \n \v \f \r.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
_RADIX = int(_rng.integers(1 << 62, 1 << 63)) | 1
_U = np.uint64


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: cuts
    the lineage (a lost executor loses no finished step) and computes it
    once."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(df: DataFrame, name: str):
    """A column of ``df`` by its exact name (names may hold dots or clash
    with names an operator adds)."""
    return df["`" + name.replace("`", "``") + "`"]


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets int64 of n+1 entries, UTF-8 bytes) of a string column; null
    counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if len(col) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(col.buffers()[1], dtype=kind)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    raw = col.buffers()[2]                 # the bytes themselves are not copied
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]: offsets[-1]]


def _trim() -> None:
    """Give freed memory back to the system (a worker that waits for its next
    task should not hold what the last one used)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # another C library
        pass


def task(run):
    """A ``mapInArrow`` function that leaves its worker small."""
    @functools.wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            _trim()
    return whole


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most ``max_bytes`` of text
    (one longer text stands alone; no text is cut)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        off, _ = string_buffers(b.column(b.schema.get_field_index(text)))
        at = 0
        while at < b.num_rows:
            to = int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1
            to = min(max(to, at + 1), b.num_rows)
            yield b.slice(at, to - at)
            at = to


def word_spans(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of every text: byte ``starts`` and ``ends`` in ``data`` and
    ``bounds`` (n+1): the words of text i are ``bounds[i]:bounds[i+1]``."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit reaches every output bit)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int, radix: int) -> np.ndarray:
    out = np.full(max(n, 1), _U(radix), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes (random byte codes, positional
    powers, length, finaliser); the same word hashes alike everywhere."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(first, lens)
    at = place + np.repeat(starts, lens)
    value = _BYTE_CODE[data[at]] * _powers(int(lens.max()), _RADIX)[place]
    return mixed(np.add.reduceat(value, first) + lens.astype(np.uint64))


def window_hashes(words: np.ndarray, k: int, radix: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries of ``words``
    (``len(words) - k + 1`` values; runs across texts are the caller's to
    drop)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out *= _U(radix)
        out += words[i: i + n]
    return mixed(out)
