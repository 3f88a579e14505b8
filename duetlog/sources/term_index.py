"""An inverted index on files behind a batch source that takes filters
(SRC-15, PIPE-20).

``build_index`` writes the rows in time order as blocks of ``BLOCK_ROWS``
(one Parquet row group each) and, for every indexed field and term, a posting
for each block that holds the term: the places of its rows and the first and
last time among them.  Postings are sorted by (field, term, time) and lie in
blocks of their own, whose bounds are known from the footers.

The source ``term_index`` accepts equality and ``IN`` on indexed fields and
bounds on the time column.  A read with a term plans the posting blocks that
can hold it; a task opens those, and then only the row blocks whose posting
meets the time range, and takes the rows at the posted places.  A read with a
time range alone plans the row blocks that meet it.  Other filters stay with
Spark.  Planning reads footers; no posting list passes the driver.

Rows without a term or a time have no posting, as no equality or bound
matches them; a read without filters returns them too.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)
from pyspark.sql.types import StructType

from .blocks import blocks, file_system, read_block, register

FORMAT = "term_index"
BLOCK_ROWS = 4096
#: Postings in a block of the posting table.
POSTING_ROWS = 4096


def build_index(df: DataFrame, path: str, fields: Sequence[str], time: str, block_rows: int = BLOCK_ROWS,
                posting_rows: int = POSTING_ROWS) -> None:
    """Write rows, postings and the description of an index.  ``fields`` are
    text columns, ``time`` a long."""
    spark, root = df.sparkSession, path.rstrip("/")
    (df.repartitionByRange(time).sortWithinPartitions(time).write
     .option("parquet.block.row.count.limit", block_rows).parquet(f"{root}/rows"))
    rows = spark.read.schema(df.schema).parquet(f"{root}/rows").select(
        *fields, time, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    block = F.floor(F.col("row") / block_rows).cast("int")
    terms = rows.select("file", block.alias("block"), (F.col("row") % block_rows).cast("int").alias("place"), F.col(time).alias("t"),
                        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("term")) for f in fields]))
                        .alias("x")).select("file", "block", "place", "t", "x.*").where("term IS NOT NULL AND t IS NOT NULL")
    posted = terms.groupBy("field", "term", "file", "block").agg(       # at most block_rows places a posting
        F.min("t").alias("first"), F.max("t").alias("last"), F.sort_array(F.collect_list("place")).alias("places"))
    (posted.repartitionByRange("field", "term", "first").sortWithinPartitions("field", "term", "first").write
     .option("parquet.block.row.count.limit", posting_rows).parquet(f"{root}/postings"))
    store, inner = file_system(root)
    with store.open_output_stream(f"{inner}/index.json") as f:
        f.write(json.dumps({"schema": df.schema.json(), "fields": list(fields), "time": time}).encode())


class _Piece(InputPartition):
    """A block to read: of postings, or (``rows``) of rows."""

    def __init__(self, file: str, group: int, rows: bool):
        self.file, self.group, self.rows = file, group, rows


class TermReader(DataSourceReader):
    def __init__(self, path: str, about: dict):
        self.path, self.fields, self.time = path, about["fields"], about["time"]
        self.columns = StructType.fromJson(json.loads(about["schema"])).names
        self.terms: dict[str, set] = {}
        self.low = self.high = None

    def pushFilters(self, filters):
        for f in filters:
            name = ".".join(getattr(f, "attribute", ()))      # a negation has none
            if name in self.fields and isinstance(f, (EqualTo, In)):
                want = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.terms[name] = self.terms[name] & want if name in self.terms else want
            elif name == self.time and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)) and f.value is not None:
                self._bound(low=f.value + isinstance(f, GreaterThan))
                if isinstance(f, EqualTo):
                    self._bound(high=f.value)
            elif name == self.time and isinstance(f, (LessThan, LessThanOrEqual)) and f.value is not None:
                self._bound(high=f.value - isinstance(f, LessThan))
            else:
                yield f

    def _bound(self, low=None, high=None) -> None:
        if low is not None:
            self.low = low if self.low is None else max(self.low, low)
        if high is not None:
            self.high = high if self.high is None else min(self.high, high)

    def partitions(self):
        if not self.terms:
            found = blocks(f"{self.path}/rows", [self.time])
            return [_Piece(b.file, b.group, True) for b in found if b.meets(self.time, self.low, self.high)]
        field, want = next(iter(self.terms.items()))
        want = {w for w in want if w is not None}
        found = blocks(f"{self.path}/postings", ["field", "term", "first", "last"])
        return [_Piece(b.file, b.group, False) for b in found
                if b.meets("field", field, field) and b.meets("last", low=self.low) and b.meets("first", high=self.high)
                and any(b.meets("term", w, w) for w in want)]

    def postings(self, piece: _Piece) -> list[dict]:
        """The piece's postings that meet the filters: row blocks to open."""
        field, want = next(iter(self.terms.items()))
        t = read_block(self.path, piece.file, piece.group, ["field", "term", "file", "block", "first", "last", "places"])
        keep = (pc.field("field") == field) & pc.field("term").isin(sorted(w for w in want if w is not None))
        if self.low is not None:
            keep &= pc.field("last") >= self.low
        if self.high is not None:
            keep &= pc.field("first") <= self.high
        return t.filter(keep).to_pylist()

    def _kept(self, t: pa.Table) -> Iterator[pa.RecordBatch]:
        for name, want in self.terms.items():
            t = t.filter(pc.field(name).isin(pa.array(sorted(w for w in want if w is not None), pa.string())))
        if self.low is not None:
            t = t.filter(pc.field(self.time) >= self.low)
        if self.high is not None:
            t = t.filter(pc.field(self.time) <= self.high)
        yield from t.to_batches()

    def read(self, partition):
        if partition is None:
            return
        if partition.rows:
            yield from self._kept(read_block(self.path, partition.file, partition.group, self.columns))
            return
        root = file_system(self.path)[1]
        for p in self.postings(partition):
            t = read_block(self.path, f"{root}/rows/{p['file']}", p["block"], self.columns)
            yield from self._kept(t.take(pa.array(p["places"])))


class TermIndex(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _about(self) -> dict:
        store, root = file_system(self.options["path"])
        with store.open_input_stream(f"{root}/index.json") as f:
            return json.loads(f.read())

    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self._about()["schema"]))

    def reader(self, schema) -> TermReader:
        return TermReader(self.options["path"].rstrip("/"), self._about())


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index as a frame; filters on it reach the source."""
    register(spark, TermIndex)
    return spark.read.format(FORMAT).option("path", path).load()
