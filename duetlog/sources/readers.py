"""Readers (SRC-*).  Every path, option and connector setting is a
parameter; nothing here names a host, a key or "today".

Text formats are read with an explicit schema and typed with ANSI-safe
expressions, so a dirty line gives nulls (or the documented sentinel), not a
failed task.  Columnar and partitioned layouts get predicate and partition
pushdown from Spark's file sources.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C

def _all_strings(cols: Sequence[str]) -> str:
    return ", ".join(f"`{c}` STRING" for c in cols)


# --- SRC-01 / SRC-09 / SRC-10: text ---------------------------------------------------

def read_text_lines(spark: SparkSession, path: str | Sequence[str], with_path: bool = False) -> DataFrame:
    """Lines as ``value``; compressed files are decoded by suffix (bz2, gz).
    ``with_path`` adds ``file_path`` from the scan's file metadata."""
    df = spark.read.text(path if isinstance(path, str) else list(path))
    if with_path:
        df = df.select("value", F.col("_metadata.file_path").alias("file_path"))
    return df


# --- SRC-02..06: delimited ------------------------------------------------------------

def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",",
                   header: bool = False) -> DataFrame:
    """Delimited text with every column read as a string (typed later).  A
    line is split at every ``sep``: quotes are characters like any other."""
    return (spark.read.schema(_all_strings(columns)).option("sep", sep).option("header", header)
            .option("quote", "").option("mode", "PERMISSIVE").csv(path))


def read_user_ip_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-02: ``user_id,ip`` rows; ``ip_num`` is the address as a long."""
    df = read_delimited(spark, path, ("user_id", "ip"))
    return df.select("user_id", C.ip_to_long("ip").alias("ip_num"))


def type_profile(df: DataFrame, missing: str = K.MISSING_TEXT) -> DataFrame:
    """SRC-03 typing: retention as int, addresses as long with ``NULL``,
    null or junk -> 0; other fields stay text."""
    out = df
    for c in ("a_retention", "b_retention"):
        out = out.withColumn(c, C.safe_int(c))
    for c in ("a_ip", "b_ip"):
        out = out.withColumn(c, C.safe_long(c, missing, 0))
    return out


def read_profile_tsv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-03: the 16-column tab profile export."""
    return type_profile(read_delimited(spark, path, K.PROFILE_COLUMNS, sep="\t"))


def read_guide_tsv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-04: ``date, dim, el, num`` tab rows (text)."""
    return read_delimited(spark, path, K.GUIDE_COLUMNS, sep="\t")


def read_space_user_tsv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-04: ``space_id, user_id`` tab rows as longs."""
    df = read_delimited(spark, path, ("space_id", "user_id"), sep="\t")
    return df.select(*[F.col(c).try_cast("bigint").alias(c) for c in ("space_id", "user_id")])


def read_ip_ranges(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """SRC-06: pipe-delimited range table with dotted ends -> ``lo, hi``
    longs plus the five attributes."""
    df = read_delimited(spark, path, K.IP_RANGE_COLUMNS, sep=sep)
    return df.select(C.ip_to_long("start_ip").alias("lo"), C.ip_to_long("end_ip").alias("hi"),
                     *K.IP_RANGE_COLUMNS[2:])


# --- SRC-07 / SRC-08: JSON -------------------------------------------------------------

def read_json(spark: SparkSession, path: str | Sequence[str], schema: str | None = None) -> DataFrame:
    """JSON lines; the schema is inferred only when none is given (inference
    is an extra pass over the data)."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.json(path if isinstance(path, str) else list(path))


# --- SRC-11 / SRC-13: tables ---------------------------------------------------------------

def read_table(spark: SparkSession, name: str, where: str | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table; a ``where`` on its partition column prunes partitions."""
    df = spark.table(name)
    if where:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_partitioned(spark: SparkSession, path: str, schema: str | None = None,
                     where: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A partitioned folder (``key=value`` sub-folders), pruned by ``where``."""
    r = spark.read.format(fmt)
    if schema:
        r = r.schema(schema)
    df = r.load(path)
    return df.where(where) if where else df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """SRC-13: a JDBC table; with a partition column the read is split into
    ``num_partitions`` range queries instead of one connection."""
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=dict(properties))
    return spark.read.jdbc(url, table, properties=dict(properties))


# --- SRC-15..18: key-value and wide-column stores as tables ------------------------------------

def cells_to_rows(cells: DataFrame, qualifiers: Sequence[str], family: str = "cf",
                  rowkey: str = "rowkey") -> DataFrame:
    """SRC-16: a (rowkey, family, qualifier, value) cell table -> one row per
    row key with one column per qualifier (pivot with fixed values, so no
    extra pass to discover them)."""
    return (cells.where(F.col("family") == family)
                 .groupBy(rowkey).pivot("qualifier", list(qualifiers)).agg(F.first("value")))


def hash_entries(entries: DataFrame, keys: Iterable[str]) -> DataFrame:
    """SRC-17: ``(field, value)`` of the hashes under ``keys``."""
    return entries.where(F.col("key").isin(list(keys))).select("field", "value")


def hashes_by_keys(entries: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """SRC-17: ``(key, field, value)`` of the hashes whose keys a table lists,
    however many: a semi join, hot keys split by adaptive execution."""
    wanted = keys.select(F.col(key).alias("_key")).distinct()
    return entries.join(wanted, F.col("key") == F.col("_key"), "left_semi").select("key", "field", "value")


def members_of_sets(entries: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """SRC-18: ``(key, member)`` of all sets whose keys a table lists."""
    wanted = keys.select(F.col(key).alias("_key")).distinct()
    return entries.join(wanted, F.col("key") == F.col("_key"), "left_semi").select("key", "member").distinct()


def set_members(entries: DataFrame, key: str) -> DataFrame:
    """SRC-18: members of one set."""
    return entries.where(F.col("key") == key).select("member")


# --- SRC-19 / SRC-20: streams ---------------------------------------------------------------------

def read_stream(spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None,
                schema: str | None = None, path: str | None = None) -> DataFrame:
    """A streaming source: ``kafka`` (subscribe, startingOffsets, ...),
    ``socket``, or a file format for tests and replays.  Kafka records come
    back with ``value`` cast to text."""
    r = spark.readStream.format(fmt)
    if schema:
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load(path) if path else r.load()
    if fmt == "kafka":
        df = df.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp")
    return df
