"""Longest-prefix lookup for ranges that may nest or overlap (JOIN-01, UDF-11).

A range of addresses is cut into its dyadic pieces: the largest aligned blocks
of a power of two that fill it, at most two for every bit of an address.  A
piece is a binary prefix, so "address in range" becomes equality of prefixes:
an address is looked up once for every prefix length that occurs, by a hash
join, and of all hits the longest prefix wins (then the narrower range, then
the lower one).  For nested ranges that is the innermost range around the
address.  32-bit and 128-bit addresses are keys of one kind and may be mixed.

Each distinct address is looked up once, however many rows hold it; the pieces
are broadcast while their measured bytes are small, and otherwise both sides
are shuffled with salt, so a short prefix over many addresses is many tasks.
Spark's own size estimate is of no use here, as it counts an exploded row once:
the shuffled form names its join, or either side may go through the driver.
"""

from __future__ import annotations

import ipaddress
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import MAX_BROADCAST_BYTES, measured_bytes

SALT = 16


def bits_of_long(ip: Column) -> Column:
    """The key of a 32-bit address held as a long; null outside its range."""
    return F.when(ip.between(0, (1 << 32) - 1), F.concat(F.lit("4"), F.lpad(F.bin(ip), 32, "0")))


def bits_of_text(ip: Column) -> Column:
    """The key of an address in text, dotted or with colons; null where it is
    neither.  Built-in functions only."""
    octet = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    dotted = rf"{octet}(\.{octet}){{3}}"
    binary = lambda parts, base, width: F.array_join(
        F.transform(parts, lambda p: F.lpad(F.conv(p, base, 2), width, "0")), "")
    four = F.concat(F.lit("4"), binary(F.split(ip, r"\."), 10, 8))
    # a dotted tail is its two groups; "::" stands for the groups that are missing
    tail = F.split(F.regexp_extract(ip, rf"({dotted})$", 1), r"\.")
    pair = lambda i: F.lower(F.hex(F.get(tail, F.lit(i)).try_cast("int") * 256 + F.get(tail, F.lit(i + 1)).try_cast("int")))
    text = F.when(ip.rlike(rf":{dotted}$"), F.concat(F.regexp_replace(ip, rf"{dotted}$", ""), pair(0), F.lit(":"), pair(2))).otherwise(ip)
    groups = lambda t: F.filter(F.split(t, ":"), lambda g: g != "")
    sides = F.split(text, "::")
    left, right = groups(F.get(sides, F.lit(0))), groups(F.coalesce(F.get(sides, F.lit(1)), F.lit("")))
    missing = F.lit(8) - F.size(left) - F.size(right)
    whole = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), right)
    form = text.rlike(r"^([0-9a-fA-F]{1,4}(:[0-9a-fA-F]{1,4})*)?(::([0-9a-fA-F]{1,4}(:[0-9a-fA-F]{1,4})*)?)?$")
    fits = F.when(text.contains("::"), missing >= 1).otherwise(missing == 0)
    return F.when(ip.rlike(f"^{dotted}$"), four).when(form & text.contains(":") & fits, F.concat(F.lit("6"), binary(whole, 16, 16)))


def address(value) -> tuple[str, int] | None:
    """(family, number) of an address given as a number (32 bits) or text."""
    try:
        if isinstance(value, int):
            return ("4", value) if 0 <= value < 1 << 32 else None
        ip = ipaddress.ip_address(value)
    except (ValueError, TypeError):
        return None
    return str(ip.version), int(ip)


def pieces(low: int, high: int, bits: int) -> Iterator[str]:
    """The binary prefixes of the aligned blocks that fill [low, high]."""
    while low <= high:
        size = min(low & -low if low else 1 << bits, 1 << ((high - low + 1).bit_length() - 1))
        length = bits - (size.bit_length() - 1)
        yield format(low >> (bits - length), "b").zfill(length) if length else ""
        low += size


def exploded(ranges: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """The ranges with (_prefix, _length, _width, _low), one row a piece.
    Ranges with an end that is no address, ends of two families or a low end
    over the high one hold nothing and have no piece."""
    at_lo, at_hi = ranges.columns.index(lo), ranges.columns.index(hi)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, prefix, width, low = [], [], [], []
            for i, (x, y) in enumerate(zip(b.column(at_lo).to_pylist(), b.column(at_hi).to_pylist())):
                x, y = address(x), address(y)
                if x is None or y is None or x[0] != y[0] or x[1] > y[1]:
                    continue
                for p in pieces(x[1], y[1], 32 if x[0] == "4" else 128):
                    row.append(i), prefix.append(x[0] + p)
                    width.append(f"{y[1] - x[1]:032x}"), low.append(f"{x[1]:032x}")
            kept = [c.take(pa.array(row, pa.int64())) for c in b.columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(prefix, pa.string()), pa.array([len(p) for p in prefix], pa.int32()),
                 pa.array(width, pa.string()), pa.array(low, pa.string())],
                names=[*b.schema.names, "_prefix", "_length", "_width", "_low"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema)
    return ranges.mapInArrow(run, f"{fields}, _prefix string, _length int, _width string, _low string")


def prefix_join(fact: DataFrame, ranges: DataFrame, key: Column, lo: str = "lo", hi: str = "hi",
                max_broadcast_bytes: int = MAX_BROADCAST_BYTES, salt: int = SALT) -> DataFrame:
    """``fact`` with the other columns of the range that its address falls in
    (null without one).  ``key``: ``bits_of_long`` or ``bits_of_text`` of the
    address.  Measuring the pieces runs a job over ``ranges``."""
    attrs = [c for c in ranges.columns if c not in (lo, hi)]
    parts = exploded(ranges, lo, hi)
    lengths = sorted(r[0] for r in parts.select("_length").distinct().collect())      # at most 161
    best = F.struct((-F.col("_length")).alias("l"), F.col("_width"), F.col("_low"), *[F.col(f"`{a}`") for a in attrs])
    parts = parts.select("_prefix", best.alias("_rank"))
    points = fact.select(key.alias("_key")).where(F.col("_key").isNotNull()).distinct()
    cut = points.withColumn("_length", F.explode(F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")))
    cut = cut.where(F.col("_length") <= F.length("_key")).select("_key", F.substring("_key", F.lit(1), F.col("_length")).alias("_prefix"))
    on = ["_prefix"]
    if measured_bytes(parts.select("_prefix", F.to_json("_rank").alias("r"))) <= max_broadcast_bytes:
        parts = F.broadcast(parts)
    else:
        parts = parts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        cut = cut.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(salt)).cast("int"))
        parts = parts.hint("merge")     # an estimate must not broadcast either side: both are exploded
        on.append("_salt")
    found = cut.join(parts, on).groupBy("_key").agg(F.min("_rank").alias("_rank"))
    out = fact.withColumn("_key", key).join(found, "_key", "left")
    return out.select(*[out[f"`{c}`"] for c in fact.columns], *[F.col("_rank").getField(a).alias(a) for a in attrs])
