"""Writers (SNK-*).  Output paths, formats, modes and connector options are
parameters.  Every task writes its own file; the studied jobs' single file
(all rows through one task) is not offered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..session import staging_path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists",
              sep: str = ",") -> None:
    """SNK-01 / SNK-02: CSV (UTF-8), with or without a header row."""
    (df.write.mode(mode).option("header", header).option("encoding", "UTF-8")
     .option("sep", sep).csv(path))


def text_value(df: DataFrame, sep: str = " ") -> DataFrame:
    """Join every column into one ``value`` text column (nulls as ``null``)."""
    if df.columns == ["value"]:
        return df
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns])
                     .alias("value"))


def write_text(df: DataFrame, path: str, mode: str = "errorifexists",
               sep: str = " ", partition_by: str | None = None) -> None:
    """SNK-03 / SNK-04: plain text lines (columns joined by ``sep``)."""
    out = df.hint("rebalance", partition_by) if partition_by else text_value(df, sep)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.text(path)


def append_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet",
                 partition_by: Iterable[str] = ()) -> None:
    """SNK-05 / SNK-07: append to a catalog table (created on first write);
    ``path`` makes it an external table at a shared location."""
    w = df.write.mode("append").format(fmt)
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def create_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> None:
    """SNK-06: create a table; fails if it exists (default save mode)."""
    w = df.write.format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def write_bucketed(df: DataFrame, keys: Iterable[str], buckets: int | None = None, path: str | None = None) -> DataFrame:
    """``df`` written as a table of hash buckets sorted by ``keys``, read
    back.  Two tables with equal bucket counts join on the keys, and one is
    grouped by them, without an exchange.  Rows are dealt like the buckets, so
    each task writes one file; a key's rows lie in one bucket, so aggregate
    first where a key may be hot."""
    spark, cols = df.sparkSession, list(keys)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or staging_path(spark, "bucketed")
    name = "bucketed_" + path.rsplit("-", 1)[-1].replace("/", "_")
    df.repartition(n, *cols).write.format("parquet").option("path", path).bucketBy(n, *cols).sortBy(*cols).saveAsTable(name)
    return spark.table(name)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append",
               batch_size: int = 1000, num_partitions: int | None = None) -> None:
    """SNK-08: JDBC append; ``num_partitions`` bounds the open connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.mode(mode).option("batchsize", batch_size).jdbc(url, table, properties=dict(properties))


def deliver_partitions(df: DataFrame, send: Callable[[Iterable[Row]], None]) -> None:
    """SNK-11: hand each partition's rows to ``send`` (e.g. a webhook client
    that batches requests); runs on the executors, nothing is collected."""
    df.foreachPartition(send)


def write_partitioned(df: DataFrame, path: str, partition_by: Iterable[str], fmt: str = "parquet",
                      mode: str = "errorifexists") -> None:
    """Partitioned folder write.  The ``rebalance`` hint lets adaptive
    execution shuffle rows by the partition columns, splitting a hot value
    over several tasks and merging small ones, so each folder gets a few
    right-sized files instead of one file per task per value."""
    cols = list(partition_by)
    df.hint("rebalance", *cols).write.mode(mode).format(fmt).partitionBy(*cols).save(path)


def upsert_accumulate(state: DataFrame, batch: DataFrame, key: list[str], set_cols: list[str],
                      add_cols: dict[str, str]) -> DataFrame:
    """SNK-09: keyed upsert as a table rewrite - ``INSERT ... ON DUPLICATE
    KEY UPDATE set_cols = new, acc = acc + new``.

    ``add_cols`` maps an accumulated state column to the batch column added
    to it (``{"total_num": "num"}``); new keys start with the batch value.
    A full outer join on the key: unmatched state rows are kept, unmatched
    batch rows inserted.  Null keys never match (each is inserted), as in a
    unique index."""
    s = state.select(*[F.col(c).alias(f"_s_{c}") for c in state.columns])
    b = batch.select(*[F.col(c).alias(f"_b_{c}") for c in batch.columns], F.lit(True).alias("_in_b"))
    cond = None
    for k in key:
        e = F.col(f"_s_{k}") == F.col(f"_b_{k}")
        cond = e if cond is None else cond & e
    j = s.join(b, cond, "full_outer")
    in_b, in_s = F.col("_in_b").isNotNull(), F.col(f"_s_{key[0]}").isNotNull() | F.col(f"_s_{set_cols[0]}").isNotNull()
    out = []
    for c in state.columns:
        if c in key:
            out.append(F.when(in_b, F.col(f"_b_{c}")).otherwise(F.col(f"_s_{c}")).alias(c))
        elif c in set_cols:
            out.append(F.when(in_b, F.col(f"_b_{c}")).otherwise(F.col(f"_s_{c}")).alias(c))
        elif c in add_cols:
            bc = F.col(f"_b_{add_cols[c]}")
            out.append(F.when(in_b & in_s, F.col(f"_s_{c}") + bc).when(in_b, bc).otherwise(F.col(f"_s_{c}")).alias(c))
        else:
            out.append(F.coalesce(F.col(f"_s_{c}"), F.col(f"_b_{c}")).alias(c))
    return j.select(*out)


def delete_by_status(state: DataFrame, statuses, status_col: str = "status") -> DataFrame:
    """SNK-10: the table without rows in ``statuses`` (a rewrite, not a
    per-row delete)."""
    return state.where(~F.col(status_col).isin(list(statuses)) | F.col(status_col).isNull())
