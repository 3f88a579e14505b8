"""Parquet row groups as blocks with bounds: what the file sources share.

A block is one row group.  Its bounds come from the file's footer, so a plan
opens footers only and a task opens only blocks that can hold a wanted row.
Paths may be on any file system that Arrow knows (local, HDFS, object stores).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path on it) of a path or URI."""
    found, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path)) if ":" in path else (fs.LocalFileSystem(), path)
    return found, inner.rstrip("/")


def data_files(path: str) -> list[str]:
    """Parquet files under a folder, by name; a missing folder has none.
    Names starting with ``_`` or ``.`` (commits under way) are passed by."""
    store, root = file_system(path)
    hidden = lambda p: any(part[:1] in "_." for part in p[len(root) + 1:].split("/"))
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
    return sorted(f.path for f in found if f.is_file and f.path.endswith(".parquet") and not hidden(f.path))


@dataclass(frozen=True)
class Block:
    """One row group; ``bounds``: per column (least, greatest) or None where
    the footer does not say."""

    file: str
    group: int
    rows: int
    bounds: dict = field(compare=False)

    def meets(self, column: str, low=None, high=None) -> bool:
        """False only if no value of ``column`` lies in [low, high]."""
        known = self.bounds.get(column)
        return known is None or not ((low is not None and known[1] < low) or (high is not None and known[0] > high))


def blocks(path: str, columns: Sequence[str], files: Sequence[str] | None = None) -> list[Block]:
    """The blocks under a folder with the bounds of ``columns``."""
    store, _ = file_system(path)
    out = []
    for name in data_files(path) if files is None else files:
        with store.open_input_file(name) as f:
            meta = pq.ParquetFile(f).metadata
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                bounds = {}
                for c in (group.column(i) for i in range(group.num_columns)):
                    s = c.statistics
                    if c.path_in_schema in columns and s is not None and s.has_min_max:
                        bounds[c.path_in_schema] = s.min, s.max
                out.append(Block(name, g, group.num_rows, bounds))
    return out


def read_block(path: str, file: str, group: int, columns: Sequence[str]) -> pa.Table:
    """Columns of one block."""
    store, _ = file_system(path)
    with store.open_input_file(file) as f:
        return pq.ParquetFile(f).read_row_group(group, columns=list(columns))


def register(spark: SparkSession, *sources) -> None:
    """Make data sources known to the session, with filters handed to them."""
    spark.conf.set(PUSHDOWN, "true")
    for s in sources:
        spark.dataSource.register(s)
