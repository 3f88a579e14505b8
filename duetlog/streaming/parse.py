"""Stateless stream steps: JSON payload parsing (STR-02) and event routing
(STR-03).  They are plain DataFrame transforms, so the same code runs on a
streaming frame and on a batch replay of the same records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def parse_error_log(df: DataFrame, value_col: str = "value", default: str = K.MISSING_ERR) -> DataFrame:
    """JSON text -> ``sv, bn, url, err_code, err_msg, time_stamp, ip_addr``;
    a missing code or message becomes ``default``; milliseconds -> seconds."""
    j = F.from_json(F.col(value_col), K.ERROR_LOG_SCHEMA).alias("j")
    return df.select(j).select(
        "j.sv", "j.bn", "j.url",
        F.coalesce(F.col("j.err_code"), F.lit(default)).alias("err_code"),
        F.coalesce(F.col("j.err_msg"), F.lit(default)).alias("err_msg"),
        F.floor(F.col("j.`@timestamp-log`") / 1000).alias("time_stamp"),
        "j.ip_addr")


def route_label(sv: Column, bn: Column, el: Column) -> Column:
    """``farm/login``, ``tree/sunshine``, ``tree/water`` -> a label; else null."""
    return (F.when((sv == "farm") & (bn == "login"), F.lit(K.ROUTE_LOGIN))
             .when((sv == "tree") & (el == "sunshine"), F.lit(K.ROUTE_SUNSHINE))
             .when((sv == "tree") & (el == "water"), F.lit(K.ROUTE_WATER)))


def route_events(df: DataFrame, value_col: str | None = "value") -> DataFrame:
    """Route JSON events (or already-parsed ``sv, bn, el, time`` columns
    with ``value_col=None``) to ``(label, time)``; others are dropped."""
    if value_col is not None:
        df = df.select(F.from_json(F.col(value_col), K.EVENT_ROUTE_SCHEMA).alias("j")).select("j.*")
    label = route_label(F.col("sv"), F.col("bn"), F.col("el"))
    return df.select(label.alias("label"), "time").where(F.col("label").isNotNull())


def run_route_stream(source: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Start the routing job: raw JSON events in, ``(label, time)`` rows out
    as Parquet.  Spark's file sink logs each batch's files, so a replayed
    batch adds nothing twice; ``trigger`` defaults to the studied five seconds."""
    return (route_events(source).writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start())
