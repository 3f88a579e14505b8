"""Exact distinct counts that merge (AGG-06, FLT-10, PIPE-15).

Distinct users do not add up over days, but their bitmaps do: every day's ids
are kept as bits, in rows of 32,768 bits for each key, and the distinct count
of any range of days is the count of bits of the rows or-ed together.  A new
day writes its own folder and rereads no log; a longer range reads bitmaps.

Ids are whole numbers; text ids get dense numbers from an ``IdDictionary``,
which also keeps the bitmaps short.  Null ids count nowhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, read_small, write_once
from .windows import row_number_within


def bitmaps(df: DataFrame, keys: Sequence[str], user: str | Column) -> DataFrame:
    """(keys, bucket, bits): the distinct ids of each key, combined map-side."""
    id_ = (F.col(user) if isinstance(user, str) else user).cast("long")
    rows = df.select(*keys, id_.alias("_id")).where(F.col("_id").isNotNull())
    return rows.groupBy(*keys, F.bitmap_bucket_number("_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits"))


def distinct_counts(maps: DataFrame, keys: Sequence[str], out: str = "uv") -> DataFrame:
    """(keys, uv) of bitmap rows, whatever days they are from."""
    merged = maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(out))


class DailyBitmaps:
    """Bitmaps by day under one folder."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], key_types: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), tuple(keys)
        kinds = ", ".join(f"`{k}` {t}" for k, t in zip(keys, key_types))
        self.schema = f"{kinds}, bucket BIGINT, bits BINARY, day DATE"

    def add(self, df: DataFrame, day: str | Column, user: str | Column) -> None:
        """Add the days that ``df`` holds whole; the same days again replace
        themselves, other days are not touched."""
        rows = df.withColumn("day", (F.col(day) if isinstance(day, str) else day).cast("date"))
        (bitmaps(rows, [*self.keys, "day"], user).hint("rebalance", "day").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(self.path))

    def read(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Bitmap rows of the days in [first, last]; other folders are not read."""
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        if first is not None:
            rows = rows.where(F.col("day") >= F.lit(first).cast("date"))
        if last is not None:
            rows = rows.where(F.col("day") <= F.lit(last).cast("date"))
        return rows

    def counts(self, first: str | None = None, last: str | None = None, floor: int = 0, out: str = "uv") -> DataFrame:
        """(keys, uv): distinct ids over the range, kept from ``floor`` on."""
        return distinct_counts(self.read(first, last), self.keys, out).where(F.col(out) >= floor)


class IdDictionary:
    """Dense numbers for text ids; numbers once given stay."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _state(self) -> tuple[int, int]:
        """(parts, ids) so far."""
        n = 0
        while path_exists(self.spark, f"{self.path}/sizes/{n}"):
            n += 1
        return n, int(read_small(self.spark, f"{self.path}/sizes/{n - 1}")) if n else 0

    def read(self) -> DataFrame:
        """(id, number)."""
        parts, _ = self._state()
        if not parts:
            return self.spark.createDataFrame([], "id STRING, number BIGINT")
        return self.spark.read.schema("id STRING, number BIGINT").parquet(*[f"{self.path}/part={i}" for i in range(parts)])

    def extend(self, ids: DataFrame, column: str) -> None:
        """Number the ids that are not there yet."""
        parts, size = self._state()
        known = self.read()
        new = ids.select(F.col(column).cast("string").alias("id")).where("id IS NOT NULL").distinct()
        new = row_number_within(new.join(known, "id", "left_anti"), [], ["id"], "_n")
        new.select("id", (F.col("_n") + size - 1).cast("long").alias("number")).write.mode("overwrite").parquet(f"{self.path}/part={parts}")
        added = self.spark.read.parquet(f"{self.path}/part={parts}").count()
        write_once(self.spark, f"{self.path}/sizes/{parts}", str(size + added))

    def numbered(self, df: DataFrame, column: str, out: str = "number") -> DataFrame:
        """``df`` with the number of its id (null where it has none)."""
        names = self.read().select(F.col("id").alias("_id"), F.col("number").alias(out))
        return df.join(names, df[column].cast("string") == F.col("_id"), "left").drop("_id")
