"""Event-time streaming aggregates (STR-09, STR-12).

The studied streams use arrival time only.  For replays and late data the
error log's own event time is used: ``withWatermark`` bounds the state kept
for open windows, and a window is emitted once the watermark passes its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(df: DataFrame, ts_col: str, window: str, watermark: str,
                    keys: Sequence[str] = (), out: str = "n") -> DataFrame:
    """Tumbling event-time windows with a watermark.  A ``timestamp_ntz``
    column is read as UTC wall clock (watermarks need a zoned timestamp)."""
    ts = F.col(ts_col)
    if dict(df.dtypes)[ts_col] == "timestamp_ntz":
        # wall clock -> the same instant in UTC, whatever the session zone
        ts = F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), ts))
    return (df.withColumn("_ts", ts).withWatermark("_ts", watermark)
              .groupBy(F.window("_ts", window).alias("w"), *keys)
              .agg(F.count(F.lit(1)).alias(out))
              .select(F.unix_seconds(F.col("w.start")).alias("window_start"), *keys, out))


def running_counts(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Page views per (date, hour) key, accumulated over all batches (the
    studied ``mapWithState`` running sum): an update-mode streaming count."""
    ts = F.col(ts_col)
    return (df.groupBy(F.to_date(ts).cast("string").alias("date"), F.hour(ts).alias("hour"))
              .agg(F.count(F.lit(1)).alias("pv")))
