"""Joins: the IP interval lookup and its helpers.

The studied jobs collect the range table to the driver, broadcast it as an
array and binary-search it per row.  Here the lookup is an equi-join that
Catalyst plans: the dimension is exploded to one row per ``ip >> bits`` prefix
bucket it overlaps, the fact side gets its own prefix, and the join is on the
bucket plus the residual ``BETWEEN``.  For non-overlapping ranges the exploded
table has at most ``ranges + 2**(32 - bits)`` rows, however wide they are.

It is broadcast when its measured bytes are under ``max_broadcast_bytes`` (no
shuffle of the fact side, no skew); above that it is a shuffled join whose
buckets are salted, so a hot prefix is spread over ``salt`` tasks (adaptive
skew splitting applies too) and rows without an address, which match nothing,
are spread by their hash.

Unmatched points (gaps, below all ranges, null) keep a null region.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 64 << 20
#: Rows without an address are spread over this many keys that match nothing.
NULL_KEYS = 1024


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a dimension-sized frame, counted: its text plus 8 a field and
    row (an explicit size check, one pass over the dimension)."""
    text = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema if f.dataType.simpleString() == "string"]
    one = F.lit(8 * (len(df.columns) + 1)).cast("bigint")
    for t in text:
        one = one + t
    return df.agg(F.sum(one)).first()[0] or 0


def explode_ranges(dim: DataFrame, lo: str = "lo", hi: str = "hi", bits: int = 16,
                   bucket: str = "_bucket") -> DataFrame:
    """One row per prefix bucket a range overlaps."""
    return dim.withColumn(
        bucket, F.explode(F.sequence(F.shiftright(F.col(lo), bits), F.shiftright(F.col(hi), bits))))


def refuse_overlaps(dim: DataFrame, lo: str = "lo", hi: str = "hi", bits: int = 16) -> DataFrame:
    """``dim``, after a check that no two of its ranges share an address (one
    job over the dimension: neighbours within every prefix bucket)."""
    before = Window.partitionBy("_bucket").orderBy(lo, hi).rowsBetween(Window.unboundedPreceding, -1)
    bad = (explode_ranges(dim.select(lo, hi), lo, hi, bits).withColumn("_reach", F.max(hi).over(before))
           .where(F.col(lo) <= F.col("_reach")).select(lo, hi).head())
    if bad is not None:
        raise ValueError(f"range {bad[0]} to {bad[1]} overlaps another; use operators.prefixes.prefix_join")
    return dim


def ip_range_join(fact: DataFrame, dim: DataFrame, ip: str | Column, lo: str = "lo", hi: str = "hi",
                  how: str = "left", bits: int = 16, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                  salt: int = 16, keep_bounds: bool = False, dim_bytes: int | None = None,
                  check: bool = False) -> DataFrame:
    """Attach the attributes of the range containing ``ip`` (inclusive ends).

    ``dim`` must hold non-overlapping ranges ``[lo, hi]`` (``check`` refuses
    others); its other columns are the attributes added to each ``fact`` row
    (null when unmatched with ``how='left'``).  ``dim_bytes`` gives the
    exploded size when it is known; otherwise a job measures it while the plan
    is built.
    """
    if check:
        dim = refuse_overlaps(dim, lo, hi, bits)
    ip_col = F.col(ip) if isinstance(ip, str) else ip
    attrs = [c for c in dim.columns if keep_bounds or c not in (lo, hi)]
    fact_cols = [F.col(f"_f.{c}") for c in fact.columns]
    dim_cols = [F.col(f"_d.{c}") for c in attrs]
    d = explode_ranges(dim, lo, hi, bits)
    f = fact.withColumn("_ip", ip_col).withColumn("_bucket", F.shiftright(F.col("_ip"), bits))
    keys = ["_bucket"]
    if (measured_bytes(d) if dim_bytes is None else dim_bytes) <= max_broadcast_bytes:
        d = F.broadcast(d)
    else:
        # the dimension is copied `salt` times, each fact row picks one copy by its hash
        own = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
        d = d.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        f = f.withColumn("_salt", F.pmod(own, F.lit(salt)).cast("int")).withColumn(
            "_bucket", F.coalesce("_bucket", -1 - F.pmod(own, F.lit(NULL_KEYS))))
        keys.append("_salt")
    f, d = f.alias("_f"), d.alias("_d")
    cond = F.col("_f._ip").between(F.col(f"_d.{lo}"), F.col(f"_d.{hi}"))
    for k in keys:
        cond = cond & (F.col(f"_f.{k}") == F.col(f"_d.{k}"))
    return f.join(d, cond, how).select(*fact_cols, *dim_cols)


def enrich_sides(df: DataFrame, dim: DataFrame, sides: dict[str, str],
                 attrs: Sequence[str] = ("country", "province", "city"),
                 lo: str = "lo", hi: str = "hi", **kw) -> DataFrame:
    """Look up several address columns of one row (``{'a': 'a_ip', ...}``);
    attributes are prefixed ``<side>_`` (``a_country``...)."""
    out = df
    if "dim_bytes" not in kw:      # every side uses the same ranges: measure them once
        kw["dim_bytes"] = measured_bytes(explode_ranges(dim.select(lo, hi, *attrs), lo, hi, kw.get("bits", 16)))
    for side, ip in sides.items():
        d = dim.select(lo, hi, *[F.col(a).alias(f"{side}_{a}") for a in attrs])
        out = ip_range_join(out, d, ip, lo, hi, how="left", **kw)
    return out


def left_anti(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with no equal key in ``other`` (null keys never match)."""
    o = other.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(on)])
    cond = None
    for i, c in enumerate(on):
        e = F.col(c) == F.col(f"_k{i}")
        cond = e if cond is None else cond & e
    return df.join(o, cond, "left_anti")
