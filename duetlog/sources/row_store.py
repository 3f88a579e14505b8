"""A row-key store of sorted region files, scanned by key range (SRC-16).

``write_regions`` sorts cells (rowkey, family, qualifier, value) by row key
into region files; a region's blocks carry their first and last key.  The
source ``row_regions`` accepts bounds, equality, ``IN`` and prefixes on the
row key, and equality on family and qualifier; regions that no wanted key can
lie in are not opened.  ``scan`` is the studied call: start key (included),
stop key (not included), one column per qualifier.

A row key with very many cells goes on over several regions.  Cells without a
row key are not stored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual, StringStartsWith)

from .blocks import Block, blocks, read_block, register
from .readers import cells_to_rows

FORMAT = "row_regions"
SCHEMA = "rowkey STRING, family STRING, qualifier STRING, value STRING"
CELLS = ["rowkey", "family", "qualifier", "value"]
#: Cells in a block.
BLOCK_CELLS = 65_536


def write_regions(cells: DataFrame, path: str, regions: int | None = None, block_cells: int = BLOCK_CELLS) -> None:
    """Cells sorted by (rowkey, family, qualifier) into region files, as many
    as ``regions`` or Spark's shuffle partitions."""
    key = ["rowkey", "family", "qualifier"]
    rows = cells.select(*[F.col(c).cast("string").alias(c) for c in CELLS]).where(F.col("rowkey").isNotNull())
    spread = rows.repartitionByRange(regions, *key) if regions else rows.repartitionByRange(*key)
    spread.sortWithinPartitions(*key).write.option("parquet.block.row.count.limit", block_cells).parquet(path)


class _Region(InputPartition):
    def __init__(self, file: str, group: int):
        self.file, self.group = file, group


class RegionReader(DataSourceReader):
    """``self.keep``: (column, filter) pairs that rows must pass."""

    def __init__(self, path: str):
        self.path, self.keep = path, []

    def pushFilters(self, filters):
        order = (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, In, StringStartsWith)
        for f in filters:
            name = ".".join(getattr(f, "attribute", ()))      # a negation has none
            if (name == "rowkey" and isinstance(f, order)) or (name in ("family", "qualifier") and isinstance(f, EqualTo)):
                self.keep.append((name, f))
            else:
                yield f

    def _meets(self, b: Block) -> bool:
        for name, f in self.keep:
            v = f.value
            if isinstance(f, EqualTo) and not b.meets(name, v, v):
                return False
            if isinstance(f, In) and not any(b.meets(name, x, x) for x in v if x is not None):
                return False
            if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and not b.meets(name, low=v):
                return False
            if isinstance(f, (LessThan, LessThanOrEqual)):
                if not b.meets(name, high=v) or (isinstance(f, LessThan) and name in b.bounds and b.bounds[name][0] == v):
                    return False
            if isinstance(f, StringStartsWith) and name in b.bounds:
                low, high = b.bounds[name]
                if high < v or (low > v and not low.startswith(v)):
                    return False
        return True

    def partitions(self):
        return [_Region(b.file, b.group) for b in blocks(self.path, CELLS[:3]) if self._meets(b)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        t = read_block(self.path, partition.file, partition.group, CELLS)
        for name, f in self.keep:
            x = pc.field(name)
            t = t.filter({EqualTo: lambda v: x == v, GreaterThan: lambda v: x > v, GreaterThanOrEqual: lambda v: x >= v,
                          LessThan: lambda v: x < v, LessThanOrEqual: lambda v: x <= v,
                          In: lambda v: x.isin(pa.array([i for i in v if i is not None], pa.string())),
                          StringStartsWith: lambda v: pc.starts_with(x, v)}[type(f)](f.value))
        yield from t.to_batches()


class RowRegions(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RegionReader:
        return RegionReader(self.options["path"].rstrip("/"))


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """All cells of the store; filters on the row key prune regions."""
    register(spark, RowRegions)
    return spark.read.format(FORMAT).option("path", path).load()


def scan(spark: SparkSession, path: str, start: str | None = None, stop: str | None = None,
         qualifiers: Sequence[str] = (), family: str = "cf") -> DataFrame:
    """One row per row key in [start, stop), one column per qualifier."""
    cells = read_regions(spark, path)
    if start is not None:
        cells = cells.where(F.col("rowkey") >= start)
    if stop is not None:
        cells = cells.where(F.col("rowkey") < stop)
    return cells_to_rows(cells, qualifiers, family)
