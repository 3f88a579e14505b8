"""Named queries over the driver's tables, each with its DuckDB twin.

``@query(name, sql=..., fixtures=(...))`` registers a function
``fn(t: Tables) -> DataFrame``; the oracle text is the fixtures' ``WITH``
clause followed by ``sql``.  A query without ``sql`` has no SQL twin (a
rows-only check by the driver, plus pytest equivalence tests).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.fixtures import Tables, duck_with

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ROUNDED: dict[str, tuple[str, ...]] = {}
DIGITS = 4


def query(name: str, sql: str | None = None, fixtures: tuple[str, ...] = (),
          extra: dict[str, str] | None = None, rounded: tuple[str, ...] = ()):
    """Register a query.  ``rounded`` names double columns that are rounded
    to ``DIGITS`` places on both sides (float sums differ in the last bits
    between engines)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        ROUNDED[name] = tuple(rounded)
        if sql is not None:
            head, body = duck_with(*fixtures, extra=extra), sql.strip()
            if head and body[:5].upper() == "WITH ":
                body = ",\n" + body[5:]
                head = head.rstrip()
            text = head + body
            if rounded:
                reps = ", ".join(f'CAST(round(CAST("{c}" AS DECIMAL(38,10)), {DIGITS}) AS DOUBLE) AS "{c}"'
                                 for c in rounded)
                text = f"SELECT * REPLACE ({reps}) FROM (\n{text}\n) AS _q"
            ORACLE[name] = text
        return fn
    return deco


def round_double(c, digits: int = DIGITS):
    """Round through a fixed-scale decimal: the 1e-10 step absorbs the
    last-bit differences of float sums, and decimal HALF_UP rounding is the
    same in both engines."""
    return F.round(c.cast("decimal(38,10)"), digits).cast("double")


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    load_all()
    df = QUERIES[name](Tables(spark, sf_dir))
    rounded = ROUNDED.get(name, ())
    if rounded:
        df = df.select(*[round_double(F.col(c)).alias(c) if c in rounded else F.col(c) for c in df.columns])
    return df


def load_all() -> None:
    """Import every catalog module so their queries register."""
    from . import (basic, joins_q, couples_q, logs_q, farm_q, sources_q, streams_q)  # noqa: F401


def spark_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_all()
    return {k: (lambda spark, sf_dir, _k=k: run(_k, spark, sf_dir)) for k in QUERIES}


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
