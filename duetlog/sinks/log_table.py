"""A log-structured keyed table on shared files (SNK-09, SNK-10).

The table is cut into buckets by the hash of its key.  A bucket has at most
one base (whole rows, one a key) and any number of deltas on top:

* ``upsert`` writes the batch as a delta, nothing else: "insert, on duplicate
  key set these columns, add to those" is resolved on reading;
* ``delete`` writes a tombstone, a condition on one column that holds for the
  rows as they stand at that moment;
* ``read`` folds each key's base row and deltas in the order they came;
* ``compact`` folds the buckets that have deltas into new bases; the files of
  other buckets keep their names.

A version is one manifest (which base, deltas and tombstones count); it is
written after the files it names and renamed into place, so a reader sees a
whole version, a failed write leaves nothing behind that counts, and of two
writers of one version one fails.  A batch id makes an upsert idempotent, as
``foreachBatch`` needs.

A batch holds a key once (aggregate first).  Rows with a null in their key
match nothing, as in a unique index: each stays a row of its own.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import delete_path, list_files, path_exists, read_small, write_once

KEEP_VERSIONS = 3
_BUCKET, _LONE, _SEQ = "_bucket", "_lone", "_seq"


class LogTable:
    """``key``: key columns; ``set_columns``: taken from the newest row;
    ``add``: accumulated column -> column of the batch that is added to it;
    any other column keeps its first value."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str], set_columns: Sequence[str] = (),
                 add: Mapping[str, str] | None = None, buckets: int = 16):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.set_columns, self.add, self.buckets = tuple(key), tuple(set_columns), dict(add or {}), buckets

    # --- versions ----------------------------------------------------------------------

    def _manifest(self, version: int) -> str:
        return f"{self.path}/versions/{version:012d}.json"

    def version(self) -> int:
        """The newest version, 0 for a new table."""
        if not path_exists(self.spark, f"{self.path}/versions"):
            return 0
        names = [f.rsplit("/", 1)[1] for f in list_files(self.spark, f"{self.path}/versions")]
        return max((int(n[:12]) for n in names if n.endswith(".json") and n[0] != "."), default=0)

    def state(self, version: int | None = None) -> dict:
        """``base``: bucket -> version of its base; ``deltas``: [version,
        buckets]; ``tombstones``: [version, column, values]; ``batch``: the
        last batch id."""
        version = self.version() if version is None else version
        if version == 0:
            return {"version": 0, "base": {}, "deltas": [], "tombstones": [], "batch": None}
        return json.loads(read_small(self.spark, self._manifest(version)))

    def _commit(self, state: dict) -> None:
        state = {**state, "version": state["version"] + 1}
        write_once(self.spark, self._manifest(state["version"]), json.dumps(state))

    # --- writing ------------------------------------------------------------------------

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.key])
        lone = F.when(~whole, F.uuid())
        return rows.withColumn(_LONE, lone).withColumn(
            _BUCKET, F.pmod(F.xxhash64(*self.key, F.col(_LONE)), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame, folder: str) -> list[int]:
        """Rows by bucket; the buckets written.  What an attempt that died
        before its version left in the folder goes."""
        (rows.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(folder))
        names = [f.rsplit("/", 1)[1] for f in list_files(self.spark, folder)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{_BUCKET}="))

    def upsert(self, batch: DataFrame, batch_id: int | None = None) -> None:
        """Add a batch: the table's columns (accumulated ones are taken from
        their source column).  A batch id that is not newer than the last one
        does nothing."""
        state = self.state()
        if batch_id is not None and state["batch"] is not None and batch_id <= state["batch"]:
            return
        rows = batch.select(*[F.col(self.add.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in self.schema])
        number = state["version"] + 1
        touched = self._write(self._bucketed(rows), f"{self.path}/delta/{number:012d}")
        deltas = [*state["deltas"], [number, touched]] if touched else state["deltas"]
        self._commit({**state, "deltas": deltas, "batch": state["batch"] if batch_id is None else batch_id})

    def delete(self, column: str, values: Iterable) -> None:
        """Delete the rows whose ``column`` now has one of ``values``."""
        state = self.state()
        stone = [state["version"] + 1, column, [str(v) for v in values]]
        self._commit({**state, "tombstones": [*state["tombstones"], stone]})

    # --- reading ------------------------------------------------------------------------

    def _folder(self, kind: str, number: int, buckets: Sequence[int]) -> list[str]:
        return [f"{self.path}/{kind}/{number:012d}/{_BUCKET}={b}" for b in buckets]

    def _rows(self, kind: str, number: int, buckets: Sequence[int]) -> DataFrame:
        """One folder's rows with the version they came in, 0 for a base."""
        schema = StructType([*self.schema.fields]).add(_LONE, "string").add(_BUCKET, "integer")
        root = f"{self.path}/{kind}/{number:012d}"
        rows = self.spark.read.schema(schema).option("basePath", root).parquet(*self._folder(kind, number, buckets))
        return rows.withColumn(_SEQ, F.lit(0 if kind == "base" else number))

    def _folded(self, rows: DataFrame, tombstones: Sequence) -> DataFrame:
        """Base rows, deltas and tombstones of every key, in order."""
        names = [f.name for f in self.schema if f.name not in self.key]
        fields = {f.name: f.dataType for f in self.schema}
        event = lambda seq, stone, values: F.struct(
            seq.cast("long").alias("seq"), F.lit(stone).cast("int").alias("stone"), *[v.cast(fields[n]).alias(n) for n, v in values])
        # a base row takes part in the order of its compaction: before every later version
        mine = F.collect_list(event(F.col(_SEQ), -1, [(n, F.col(n)) for n in names]))
        stones = F.array(*[event(F.lit(s[0]), i, [(n, F.lit(None)) for n in names]) for i, s in enumerate(tombstones)])
        events = F.array_sort(F.concat("events", stones) if tombstones else F.col("events"),
                              lambda a, b: F.when(a["seq"] < b["seq"], -1).when(a["seq"] > b["seq"], 1).otherwise(0))
        held = lambda live, values: F.struct(F.lit(live).alias("live"), *[v.cast(fields[n]).alias(n) for n, v in values])

        def step(now: Column, e: Column) -> Column:
            fresh = held(True, [(n, e[n]) for n in names])
            merged = held(True, [(n, e[n] if n in self.set_columns else now[n] + e[n] if n in self.add
                                  else F.coalesce(now[n], e[n])) for n in names])
            out = F.when(now["live"], merged).otherwise(fresh)
            for i, (_, column, values) in enumerate(tombstones):
                gone = now["live"] & F.coalesce(now[column].cast("string").isin(values), F.lit(False))
                out = F.when(e["stone"] == i, F.when(gone, held(False, [(n, F.lit(None)) for n in names])).otherwise(now)).otherwise(out)
            return out

        folded = rows.groupBy(*self.key, _LONE, _BUCKET).agg(mine.alias("events")).withColumn(
            "x", F.aggregate(events, held(False, [(n, F.lit(None)) for n in names]), step)).where("x.live")
        return folded.select(*[F.col(f"x.{f.name}") if f.name in names else F.col(f.name) for f in self.schema], _LONE, _BUCKET)

    def _changed(self, state: dict) -> list[int]:
        """Buckets that are more than their base."""
        if state["tombstones"]:
            return sorted({int(b) for b in state["base"]} | {b for _, bs in state["deltas"] for b in bs})
        return sorted({b for _, bs in state["deltas"] for b in bs})

    def _merged(self, state: dict, buckets: Sequence[int]) -> DataFrame:
        """The present rows of ``buckets``."""
        want, parts = set(buckets), []
        by_base: dict[int, list[int]] = {}
        for b, number in state["base"].items():
            if int(b) in want:
                by_base.setdefault(number, []).append(int(b))
        parts += [self._rows("base", n, bs) for n, bs in by_base.items()]
        parts += [self._rows("delta", n, [b for b in bs if b in want]) for n, bs in state["deltas"] if want & set(bs)]
        return self._folded(reduce(DataFrame.unionByName, parts), state["tombstones"])

    def read(self, version: int | None = None) -> DataFrame:
        """The table's rows.  Buckets without deltas are read as they are."""
        state = self.state(version)
        changed = self._changed(state)
        plain: dict[int, list[int]] = {}
        for b, number in state["base"].items():
            if int(b) not in changed:
                plain.setdefault(number, []).append(int(b))
        parts = [self._rows("base", n, bs) for n, bs in plain.items()]
        if changed:
            parts.append(self._merged(state, changed))
        names = self.schema.names
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return reduce(DataFrame.unionByName, [p.select(*names) for p in parts])

    # --- upkeep ---------------------------------------------------------------------------

    def compact(self) -> list[int]:
        """Fold changed buckets into new bases; returns them.  A tombstone
        changes the buckets it deletes from: those it leaves as they are are
        told by a count and keep their files."""
        state = self.state()
        changed = self._changed(state)
        if state["tombstones"] and changed:
            with_deltas = {b for _, bs in state["deltas"] for b in bs}
            hit = [r[_BUCKET] for r in self._base_hits(state, [b for b in changed if b not in with_deltas]).collect()]
            changed = sorted(with_deltas | set(hit))
        if not changed:
            if state["tombstones"]:
                self._commit({**state, "tombstones": []})
            return []
        number = state["version"] + 1
        written = self._write(self._merged(state, changed), f"{self.path}/base/{number:012d}")
        base = {b: n for b, n in state["base"].items() if int(b) not in changed}
        base.update({str(b): number for b in written})
        self._commit({**state, "base": base, "deltas": [], "tombstones": []})
        return changed

    def _base_hits(self, state: dict, buckets: Sequence[int]) -> DataFrame:
        """The buckets without deltas that hold a row of a tombstone."""
        parts = [self._rows("base", state["base"][str(b)], [b]) for b in buckets]
        if not parts:
            return self.spark.createDataFrame([], f"{_BUCKET} int")
        hit = reduce(lambda a, b: a | b, [F.coalesce(F.col(c).cast("string").isin(v), F.lit(False)) for _, c, v in state["tombstones"]])
        return reduce(DataFrame.unionByName, parts).where(hit).select(_BUCKET).distinct()

    def vacuum(self, keep: int = KEEP_VERSIONS) -> None:
        """Delete versions before the last ``keep`` and the folders that only
        they name."""
        newest = self.version()
        states = [self.state(v) for v in range(max(1, newest - keep + 1), newest + 1)]
        used = {("base", n) for s in states for n in s["base"].values()} | {("delta", n) for s in states for n, _ in s["deltas"]}
        for kind in ("base", "delta"):
            if path_exists(self.spark, f"{self.path}/{kind}"):
                for f in list_files(self.spark, f"{self.path}/{kind}"):
                    number = int(f.rsplit("/", 1)[1])
                    if number <= newest and (kind, number) not in used:
                        delete_path(self.spark, f)
        for f in list_files(self.spark, f"{self.path}/versions") if newest else []:
            name = f.rsplit("/", 1)[1]
            if name[0] != "." and int(name[:12]) <= newest - keep:
                delete_path(self.spark, f)
