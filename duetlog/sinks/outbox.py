"""An outbox: messages delivered once by key, with retries and dead letters
(SNK-11).

``enqueue`` keeps messages under an idempotency key (by default the hash of
the body), so a batch that comes again adds nothing.  ``deliver`` hands every
message that is neither delivered nor dead to ``send`` on the executors, one
call a message, and writes what came of it as a new folder of attempts.  The
state of a message is the sum of its attempts: delivered (one succeeded), dead
(``max_attempts`` failed) or pending.

If an executor is lost after sending and before its attempts are written, the
message goes out again under the same key, by which the receiver can tell; no
message is lost and none is delivered twice by key to a receiver that does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists

MESSAGES = "key STRING, body STRING"
ATTEMPTS = "key STRING, attempt INT, ok BOOLEAN, error STRING"
MAX_ATTEMPTS = 5


class Outbox:
    def __init__(self, spark: SparkSession, path: str, max_attempts: int = MAX_ATTEMPTS):
        self.spark, self.path, self.max_attempts = spark, path.rstrip("/"), max_attempts

    def enqueue(self, messages: DataFrame, batch_id: int | str, body: str = "body", key: Column | None = None) -> None:
        """Keep a batch of messages; the same batch id again replaces its own
        folder.  Messages without a body are not kept."""
        key = F.sha2(F.col(body), 256) if key is None else key
        rows = messages.select(key.cast("string").alias("key"), F.col(body).alias("body")).where("body IS NOT NULL")
        rows.write.mode("overwrite").parquet(f"{self.path}/messages/batch={batch_id}")

    def _read(self, name: str, schema: str) -> DataFrame:
        where = f"{self.path}/{name}"
        if not path_exists(self.spark, where):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(where).select(*[c.split()[0] for c in schema.split(", ")])

    def messages(self) -> DataFrame:
        """Every message once: (key, body)."""
        return self._read("messages", MESSAGES).groupBy("key").agg(F.min("body").alias("body"))

    def status(self) -> DataFrame:
        """(key, body, attempts, state, error): the state of every message."""
        tried = self._read("attempts", ATTEMPTS).groupBy("key").agg(
            F.count("*").alias("attempts"), F.max("ok").alias("ok"), F.max_by("error", F.when(~F.col("ok"), F.col("attempt"))).alias("error"))
        n = F.coalesce("attempts", F.lit(0)).cast("int")
        state = F.when(F.col("ok"), "delivered").when(n >= self.max_attempts, "dead").otherwise("pending")
        return self.messages().join(tried, "key", "left").select("key", "body", n.alias("attempts"), state.alias("state"), "error")

    def deliver(self, send: Callable[[str, str, int], None]) -> dict[str, int]:
        """One round over the pending messages: ``send(key, body, attempt)``
        delivers or raises.  Returns how many messages are in each state."""
        pending = self.status().where("state = 'pending'").select("key", "body", (F.col("attempts") + 1).alias("attempt"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ok, error = [], []
                for k, body, n in zip(*(c.to_pylist() for c in b.columns)):
                    try:
                        send(k, body, n)
                        ok.append(True), error.append(None)
                    except Exception as e:  # noqa: BLE001 - whatever a sender raises is a failed attempt
                        ok.append(False), error.append(f"{type(e).__name__}: {e}"[:500])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2).cast(pa.int32()), pa.array(ok, pa.bool_()),
                                                  pa.array(error, pa.string())], names=["key", "attempt", "ok", "error"])

        pending.mapInArrow(run, ATTEMPTS).write.parquet(f"{self.path}/attempts/round={uuid.uuid4().hex}")
        return {r.state: r["count"] for r in self.status().groupBy("state").count().collect()}

    def deliver_all(self, send: Callable[[str, str, int], None]) -> dict[str, int]:
        """Rounds until nothing is pending (at most ``max_attempts``)."""
        out: dict[str, int] = {}
        for _ in range(self.max_attempts):
            out = self.deliver(send)
            if not out.get("pending"):
                break
        return out

    def dead_letters(self) -> DataFrame:
        """(key, body, attempts, error) of messages that are given up."""
        return self.status().where("state = 'dead'").drop("state")
