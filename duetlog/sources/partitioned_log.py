"""A partitioned, append-only log on shared files as a stream source of its
own, with consumer groups (SRC-19, STR-11).

A record has a partition and an offset that grows by one inside it.
``append_log`` numbers and writes records; the source ``partitioned_log``
reads offset ranges.  Options: ``path``; ``group`` (consumer group, optional);
``startingOffsets``: ``group`` (where the group stopped, default), ``earliest``
or ``latest``; ``maxOffsetsPerPartition`` bounds a batch.

Offsets of a group are committed after a batch's output is done, never before
(at least once): a query that dies between output and commit repeats exactly
that range, from its own checkpoint or, without one, from the group's offsets.

Planning reads footers only (kept per file); a batch becomes one input
partition for every block of every log partition, so a hot log partition is
read by many tasks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..operators.windows import row_number_within
from .blocks import Block, blocks, data_files, file_system, read_block

FORMAT = "partitioned_log"
SCHEMA = "partition INT, offset BIGINT, value STRING"


class LogFolder:
    """The log's blocks; footers of files seen before are not read again."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self._known: dict[str, list[Block]] = {}

    def blocks(self) -> dict[int, list[Block]]:
        """Per log partition its blocks in offset order."""
        files = data_files(f"{self.path}/records")
        new = [f for f in files if f not in self._known]
        for b in blocks(self.path, ["offset"], new):
            self._known.setdefault(b.file, []).append(b)
        out: dict[int, list[Block]] = {}
        for f in files:
            number = int(f.rsplit("/partition=", 1)[1].split("/")[0])
            out.setdefault(number, []).extend(self._known.get(f, []))
        return {p: sorted(bs, key=lambda b: b.bounds["offset"]) for p, bs in sorted(out.items())}

    def ends(self) -> dict[int, int]:
        """Per partition the offset after its last record; a gap (an append
        whose files are not all there yet) ends the readable part."""
        out = {}
        for p, bs in self.blocks().items():
            end = 0
            for b in bs:
                low, high = b.bounds["offset"]
                if low > end:
                    break
                end = max(end, high + 1)
            out[p] = end
        return out

    # consumer groups: one small file a commit, the newest counts
    def _group(self, group: str, kind: str) -> str:
        return f"{file_system(self.path)[1]}/_groups/{group}/{kind}"

    def stored(self, group: str, kind: str = "committed") -> dict[int, int] | None:
        """The group's offsets, or None before its first commit."""
        store, _ = file_system(self.path)
        found = store.get_file_info(fs.FileSelector(self._group(group, kind), allow_not_found=True))
        names = sorted(f.path for f in found if f.is_file and f.path.endswith(".json"))
        if not names:
            return None
        with store.open_input_stream(names[-1]) as f:
            return {int(p): o for p, o in json.loads(f.read()).items()}

    def store(self, group: str, offsets: dict[int, int], kind: str = "committed") -> None:
        """Write the group's offsets: a whole new file, then the old ones go."""
        store, _ = file_system(self.path)
        folder = self._group(group, kind)
        store.create_dir(folder, recursive=True)
        old = [f.path for f in store.get_file_info(fs.FileSelector(folder)) if f.path.endswith(".json")]
        number = 1 + max((int(n.rsplit("/", 1)[1][:12]) for n in old), default=-1)
        part = f"{folder}/{uuid.uuid4().hex}.part"
        with store.open_output_stream(part) as f:
            f.write(json.dumps({str(p): o for p, o in offsets.items()}).encode())
        store.move(part, f"{folder}/{number:012d}.json")
        for n in old:
            store.delete_file(n)


def append_log(df: DataFrame, path: str, partition: Column, order: Sequence[str], value: Column) -> None:
    """Append ``value`` of every row to the log: ``partition`` (null: 0) says
    where, ``order`` in which order.  Offsets go on behind the log's end; no
    partition is numbered in one task."""
    base = LogFolder(path).ends()
    rows = df.select(F.coalesce(partition.cast("int"), F.lit(0)).alias("partition"), value.cast("string").alias("value"),
                     *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    numbered = row_number_within(rows, ["partition"], [f"_o{i}" for i in range(len(order))], "_n")
    start = F.lit(0).cast("long")
    for p, end in base.items():
        start = F.when(F.col("partition") == p, F.lit(end)).otherwise(start)
    out = numbered.select("partition", (start + F.col("_n") - 1).cast("long").alias("offset"), "value")
    (out.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset")
     .write.mode("append").partitionBy("partition").parquet(f"{path.rstrip('/')}/records"))


class _Range(InputPartition):
    """Offsets [low, high) of one block."""

    def __init__(self, partition: int, file: str, group: int, low: int, high: int):
        self.partition, self.file, self.group, self.low, self.high = partition, file, group, low, high


def _ranges(folder: LogFolder, start: dict[int, int], end: dict[int, int]) -> list[_Range]:
    out = []
    for p, bs in folder.blocks().items():
        low, high = start.get(p, 0), end.get(p, 0)
        for b in bs:
            first, last = b.bounds["offset"]
            if max(first, low) < min(last + 1, high):
                out.append(_Range(p, b.file, b.group, max(first, low), min(last + 1, high)))
    return out


def _records(path: str, part: _Range | None) -> Iterator[pa.RecordBatch]:
    if part is None:               # Spark's stand-in where nothing is planned
        return
    t = read_block(path, part.file, part.group, ["offset", "value"])
    t = t.filter((pc.field("offset") >= part.low) & (pc.field("offset") < part.high))
    number = pa.array([part.partition] * t.num_rows, pa.int32())
    yield from pa.table({"partition": number, "offset": t["offset"], "value": t["value"].cast(pa.string())}).to_batches()


class LogReader(DataSourceReader):
    """All records that are there when the read is planned."""

    def __init__(self, options):
        self.path = options["path"]

    def partitions(self):
        folder = LogFolder(self.path)
        return _ranges(folder, {}, folder.ends())

    def read(self, partition):
        yield from _records(self.path, partition)


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.group = options["path"], options.get("group")
        self.start = options.get("startingOffsets", "group" if self.group else "earliest")
        self.most = int(options["maxOffsetsPerPartition"]) if options.get("maxOffsetsPerPartition") else None
        if self.most is not None and not self.group:
            raise ValueError("maxOffsetsPerPartition needs a group, which remembers what is planned")
        self.folder = LogFolder(self.path)

    def initialOffset(self) -> dict:
        at: dict[int, int] = {}
        if self.start == "latest":
            at = self.folder.ends()
        elif self.start == "group":
            at = self.folder.stored(self.group) or {}
        if self.most is not None:
            self.folder.store(self.group, at, "planned")
        return {str(p): o for p, o in at.items()}

    def latestOffset(self) -> dict:
        ends = self.folder.ends()
        if self.most is not None:
            at = self.folder.stored(self.group, "planned") or {}
            ends = {p: min(e, at.get(p, 0) + self.most) for p, e in ends.items()}
        return {str(p): o for p, o in ends.items()}

    def partitions(self, start: dict, end: dict):
        ends = {int(p): o for p, o in end.items()}
        if self.most is not None:
            self.folder.store(self.group, ends, "planned")
        return _ranges(self.folder, {int(p): o for p, o in start.items()}, ends)

    def read(self, partition):
        yield from _records(self.path, partition)

    def commit(self, end: dict) -> None:
        """Called when the output up to ``end`` is done."""
        if self.group:
            self.folder.store(self.group, {int(p): o for p, o in end.items()})


class PartitionedLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogReader:
        return LogReader(self.options)

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(self.options)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log as a batch frame."""
    spark.dataSource.register(PartitionedLog)
    return spark.read.format(FORMAT).option("path", path).load()


def stream_log(spark: SparkSession, path: str, group: str | None = None, **options) -> DataFrame:
    """The log as a streaming frame."""
    spark.dataSource.register(PartitionedLog)
    r = spark.readStream.format(FORMAT).option("path", path)
    for k, v in {**({"group": group} if group else {}), **options}.items():
        r = r.option(k, str(v))
    return r.load()
