"""Error-log alarm (STR-04..08, SNK-09/10, PIPE-25).

Per micro-batch the studied job aggregates errors per key and runs six
statements against a state table:

1. delete rows with status 2 (recovered last time);
2. ``num >= T``: insert status 0 (new alarm, ``total = num``), or, if the
   key exists, set status 1 (ongoing), ``num``, ``final_time`` and
   ``total += num``;
3. state rows whose presence key (``url, err_code``) is absent from the
   batch: status 2, ``num = 0``, ``final_time`` kept;
4. ``num < T``: insert status 3, or, if the key exists, set status 2 and
   ``total += num``;
5. delete status 3;
6. send every state row.

``alarm_step`` computes the same new state as one DataFrame expression (a
full outer join of state and batch on the key, plus an anti-join for
presence).  ``AlarmStateTable`` applies it inside ``foreachBatch``: state
version ``n`` is written as a new folder named by the batch id, so a
replayed batch id changes no state and a failed batch leaves the previous
version intact.  Messages go out after the version is committed and before
its delivery is recorded; a batch replayed without that record is delivered
again (exactly-once state, at-least-once messages).

``alarm_status_batch`` is the closed form over a replayed log when the
presence key equals the group key: ``hot & !prev -> 0``, ``hot & prev -> 1``,
``!hot & prev -> 2``, a hot key absent in the next batch -> 2, otherwise no
row; the total is the running sum of ``num`` within the run that status 0
started.  It uses ``lag``/``lead`` over each key's batches, so no dense
key x batch grid is built.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.columns import epoch_seconds_to_text, map_label
from ..session import delete_path, path_exists, touch
from ..sinks.writers import deliver_partitions
from .parse import parse_error_log

GROUP_KEY = ("sv", "bn", "url", "err_code", "err_msg")
PRESENCE_KEY = ("url", "err_code")
STATE_SCHEMA = ("sv STRING, bn STRING, url STRING, err_code STRING, err_msg STRING, time_stamp STRING, "
                "num BIGINT, status INT, final_time STRING, total_num BIGINT")


# --- STR-04 --------------------------------------------------------------------------

def batch_aggregate(parsed: DataFrame, key: Sequence[str] = GROUP_KEY, extra_keys: Sequence[str] = (),
                    distinct_ips: bool = True) -> DataFrame:
    """Per key: first time, error count, last time, distinct addresses.
    (Exact distinct counts are allowed here: inside ``foreachBatch`` the
    frame is a batch frame.)  The state merge does not read ``ip_num``, so
    it asks for ``distinct_ips=False`` and saves the distinct-count shuffle."""
    aggs = [epoch_seconds_to_text(F.min("time_stamp")).alias("time_stamp"),
            F.count("ip_addr").alias("num"),
            epoch_seconds_to_text(F.max("time_stamp")).alias("final_time")]
    if distinct_ips:
        aggs.append(F.countDistinct("ip_addr").alias("ip_num"))
    return parsed.groupBy(*extra_keys, *key).agg(*aggs)


# --- STR-05 / STR-06 / STR-07 / SNK-09 / SNK-10 ------------------------------------------

def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def alarm_step(state: DataFrame, batch: DataFrame, threshold: int = K.ALARM_THRESHOLD,
               presence: Sequence[str] = PRESENCE_KEY, key: Sequence[str] = GROUP_KEY) -> DataFrame:
    """New state table after one batch (rules 1-5 above).

    State rows and batch rows are unioned, flagged by side; a window over
    the presence key marks state rows whose presence key occurs in the
    batch; a group-by on the full key (which contains the presence key, so
    the window's partitioning is reused: one shuffle) pairs each state row
    with its batch row.  As in SQL joins, a key with a null part never
    matches anything."""
    cols = ["time_stamp", "num", "final_time"]
    s = state.where(F.col("status") != 2)                                   # rule 1
    s = s.select(*key, *cols, "status", "total_num", F.lit(False).alias("_b"))
    b = batch.select(*key, *cols, F.lit(None).cast("int").alias("status"),
                     F.lit(None).cast("bigint").alias("total_num"), F.lit(True).alias("_b"))
    u = s.unionByName(b)
    p_ok = None
    for c in presence:
        e = F.col(c).isNotNull()
        p_ok = e if p_ok is None else p_ok & e
    k_ok = None
    for c in key:
        e = F.col(c).isNotNull()
        k_ok = e if k_ok is None else k_ok & e
    u = (u.withColumn("_present", p_ok & F.max("_b").over(Window.partitionBy(*presence)))
          .withColumn("_nk", F.when(~k_ok, F.monotonically_increasing_id())))   # null key: own group
    side = lambda flag, c: F.max(F.when(F.col("_b") == flag, F.col(c)))
    g = u.groupBy(*key, "_nk").agg(
        side(False, "time_stamp").alias("s_ts"), side(False, "num").alias("s_num"),
        side(False, "final_time").alias("s_final"), side(False, "status").alias("s_status"),
        side(False, "total_num").alias("s_total"), F.max(F.when(~F.col("_b"), F.col("_present"))).alias("s_present"),
        side(True, "time_stamp").alias("b_ts"), side(True, "num").alias("b_num"),
        side(True, "final_time").alias("b_final"), F.max("_b").alias("in_b"),
        F.min("_b").alias("_min_b"))
    in_b = F.col("in_b")
    in_s = ~F.col("_min_b")                                                  # some row came from state
    hot = F.col("b_num") >= threshold
    absent = ~F.coalesce(F.col("s_present"), F.lit(False))
    status = (F.when(in_b & hot & in_s, 1)                                   # rule 2, existing
               .when(in_b & hot, 0)                                          # rule 2, new
               .when(in_b & in_s, 2)                                         # rule 4, existing
               .when(in_b, 3)                                                # rule 4, new (deleted)
               .when(absent, 2)                                              # rule 3, absent
               .otherwise(F.col("s_status")))
    num = F.when(in_b, F.col("b_num")).when(absent, F.lit(0).cast("bigint")).otherwise(F.col("s_num"))
    total = (F.when(in_b & in_s, F.col("s_total") + F.col("b_num"))
              .when(in_b, F.col("b_num")).otherwise(F.col("s_total")))
    out = g.select(*key, F.coalesce(F.col("s_ts"), F.col("b_ts")).alias("time_stamp"),
                   num.cast("bigint").alias("num"), status.cast("int").alias("status"),
                   F.when(in_b, F.col("b_final")).otherwise(F.col("s_final")).alias("final_time"),
                   total.cast("bigint").alias("total_num"))
    return out.where(F.col("status") != 3)                                   # rule 5


class AlarmStateTable:
    """``foreachBatch`` handler keeping the alarm state as versioned Parquet
    folders ``<base>/batch=<id>`` in a shared location.

    ``parse`` turns the raw micro-batch into parsed error rows (default:
    JSON ``value`` -> ``parse_error_log``); ``on_state`` receives each new
    state (e.g. build messages and deliver them) and may see a version twice,
    never not at all.  ``keep_versions`` prunes older versions once a newer
    one is delivered (None keeps all)."""

    def __init__(self, base_path: str, threshold: int = K.ALARM_THRESHOLD,
                 presence: Sequence[str] = PRESENCE_KEY,
                 parse: Callable[[DataFrame], DataFrame] | None = parse_error_log,
                 on_state: Callable[[DataFrame, int], None] | None = None,
                 keep_versions: int | None = 5):
        if keep_versions is not None and keep_versions < 2:
            raise ValueError("the version before the one being written must be kept")
        self.base, self.threshold, self.presence = base_path.rstrip("/"), threshold, tuple(presence)
        self.parse, self.on_state, self.keep_versions = parse, on_state, keep_versions

    def path(self, batch_id: int) -> str:
        return f"{self.base}/batch={batch_id:012d}"

    def _delivered(self, batch_id: int) -> str:
        return f"{self.base}/_delivered/{batch_id:012d}"

    def committed(self, spark: SparkSession, batch_id: int) -> bool:
        """True once the version's write job committed (its ``_SUCCESS``
        marker exists); a partial folder left by a crashed attempt is not."""
        return path_exists(spark, f"{self.path(batch_id)}/_SUCCESS")

    def read(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """State version ``batch_id``; raises if it was never committed."""
        if not self.committed(spark, batch_id):
            raise RuntimeError(f"alarm state version {batch_id} is missing under {self.base}")
        return spark.read.schema(STATE_SCHEMA).parquet(self.path(batch_id))

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if not self.committed(spark, batch_id):
            prev = self.read(spark, batch_id - 1) if batch_id else empty_state(spark)
            rows = self.parse(batch_df) if self.parse else batch_df
            new = alarm_step(prev, batch_aggregate(rows, distinct_ips=False), self.threshold, self.presence)
            new.write.mode("overwrite").parquet(self.path(batch_id))
        if self.on_state is not None and not path_exists(spark, self._delivered(batch_id)):
            self.on_state(self.read(spark, batch_id), batch_id)
            touch(spark, self._delivered(batch_id))
        if self.keep_versions is not None and batch_id >= self.keep_versions:
            delete_path(spark, self.path(batch_id - self.keep_versions))
            delete_path(spark, self._delivered(batch_id - self.keep_versions))


def deliver_messages(send: Callable[[Iterable[Row]], None]) -> Callable[[DataFrame, int], None]:
    """``on_state`` handler: the state's messages, handed to ``send`` one
    partition at a time on the executors (SNK-11)."""
    return lambda state, _batch_id: deliver_partitions(alarm_messages(state), send)


def run_alarm_stream(source: DataFrame, state: AlarmStateTable, checkpoint: str,
                     trigger: dict | None = None):
    """Start the alarm query: ``source`` is a streaming frame of raw records
    (e.g. ``read_stream(spark, 'kafka', {...})``); ``trigger`` defaults to the
    studied 30-second interval."""
    w = (source.writeStream.foreachBatch(state).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"processingTime": "30 seconds"})))
    return w.start()


# --- batch twin (closed form) ------------------------------------------------------------

def alarm_status_batch(agg: DataFrame, threshold: int, batch_col: str = "batch",
                       key: Sequence[str] = GROUP_KEY, last_batch: Column | None = None) -> DataFrame:
    """Alarm rows per (key, batch) over a replayed log with dense integer
    batch ids; ``agg`` holds ``key, batch, time_stamp, num, final_time``."""
    w = Window.partitionBy(*key).orderBy(batch_col)
    b = F.col(batch_col)
    x = (agg.withColumn("_hot", F.col("num") >= threshold)
            .withColumn("_prev", F.coalesce((F.lag(batch_col).over(w) == b - 1) & F.lag("_hot").over(w),
                                            F.lit(False)))
            .withColumn("_next", F.lead(batch_col).over(w)))
    status = (F.when(F.col("_hot") & ~F.col("_prev"), 0).when(F.col("_hot"), 1)
               .when(F.col("_prev"), 2))
    x = x.withColumn("status", status).where(F.col("status").isNotNull())
    run = Window.partitionBy(*key).orderBy(batch_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = (x.withColumn("_run", F.sum((F.col("status") == 0).cast("int")).over(run))
          .withColumn("total_num", F.sum("num").over(Window.partitionBy(*key, "_run").orderBy(batch_col)
                                                     .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
          .withColumn("time_stamp", F.first("time_stamp").over(Window.partitionBy(*key, "_run").orderBy(batch_col)
                                                               .rowsBetween(Window.unboundedPreceding, 0))))
    if last_batch is None:
        last_batch = agg.select(F.max(batch_col)).scalar()
    gone = (x.where(F.col("_hot") & (F.col("_next").isNull() | (F.col("_next") != b + 1)) & (b + 1 <= last_batch))
             .select(*key, (b + 1).alias(batch_col), "time_stamp", F.lit(0).cast("bigint").alias("num"),
                     F.lit(2).alias("status"), "final_time", "total_num"))
    cols = [*key, batch_col, "time_stamp", "num", "status", "final_time", "total_num"]
    return x.select(*cols).unionByName(gone.select(*cols))


# --- STR-08 ----------------------------------------------------------------------------

def _fill(template: str, fields: dict[str, Column]) -> Column:
    """Template text with ``{name}`` slots -> ``concat`` of literals and
    columns (a null field prints as ``null``)."""
    parts, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        parts += [F.lit(head), F.coalesce(fields[name].cast("string"), F.lit("null"))]
    parts.append(F.lit(rest))
    return F.concat(*parts)


def alarm_content(state: DataFrame, labels=K.SERVICE_LABELS) -> Column:
    """Markdown text of one alarm row by status (0 new, 1 ongoing,
    2 recovered, else unknown)."""
    f = {"service": map_label("sv", labels), "bn": F.col("bn"), "url": F.col("url"),
         "err_code": F.col("err_code"), "err_msg": F.col("err_msg"), "num": F.col("num"),
         "time": F.col("time_stamp"), "total": F.col("total_num"), "final_time": F.col("final_time")}
    st = F.col("status")
    return (F.when(st == 0, _fill(K.ALARM_TEMPLATE_NEW, f))
             .when(st == 1, _fill(K.ALARM_TEMPLATE_ONGOING, f))
             .when(st == 2, _fill(K.ALARM_TEMPLATE_RECOVERED, f))
             .otherwise(F.lit(K.ALARM_UNKNOWN_STATE)))


def message_body(state: DataFrame) -> Column:
    """The webhook's JSON body of an alarm row."""
    content = alarm_content(state)
    return F.to_json(F.struct(F.lit("markdown").alias("msgtype"), F.struct(content.alias("content")).alias("markdown")))


def alarm_messages(state: DataFrame) -> DataFrame:
    """``{"msgtype":"markdown","markdown":{"content":...}}`` per state row."""
    return state.select(*GROUP_KEY, "status", alarm_content(state).alias("content"), message_body(state).alias("body"))
