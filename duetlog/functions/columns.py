"""Column functions: ``Column -> Column``.

Every function here is a composition of built-in Spark expressions, so it
stays inside whole-stage codegen and can be pushed down or constant-folded.
None of them is a Python UDF.  They are ANSI-safe: dirty text gives null,
never a task failure (``try_cast``, ``try_to_date``, ``get``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


# --- SCL-01 / SCL-02 / SCL-03 / SCL-04: text ----------------------------------

def split_get(col: ColumnOrName, sep_regex: str, index: int,
              java_trailing: bool = True) -> Column:
    """Field ``index`` (0-based) of ``split(col, sep_regex)``; null when the
    line is too short.  With ``java_trailing`` trailing empty fields are
    dropped first, as ``String.split`` does."""
    c = _c(col)
    if java_trailing:
        c = F.regexp_replace(c, f"({sep_regex})+$", "")
    return F.get(F.split(c, sep_regex), index)


def field_count(col: ColumnOrName, sep_regex: str, java_trailing: bool = True) -> Column:
    c = _c(col)
    if java_trailing:
        c = F.regexp_replace(c, f"({sep_regex})+$", "")
    return F.size(F.split(c, sep_regex))


def java_trim(col: ColumnOrName) -> Column:
    """``String.trim``: strips every char <= U+0020 (tab, newline too)."""
    return F.regexp_replace(_c(col), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def trim_reverse_upper(col: ColumnOrName) -> Column:
    return F.upper(F.reverse(java_trim(col)))


def is_digits(col: ColumnOrName) -> Column:
    return _c(col).rlike(r"^[0-9]+$")


# --- SCL-05..10: dates and times ---------------------------------------------------

def safe_date(col: ColumnOrName) -> Column:
    """Date from a date, timestamp or text column; bad text -> null."""
    c = _c(col)
    return F.try_to_date(c.cast("string"))


def days_since(as_of: str | Column, col: ColumnOrName) -> Column:
    """``datediff(as_of, col)`` with ANSI-safe parsing of ``col``."""
    return F.datediff(F.to_date(_lit(as_of)), safe_date(col))


def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    return F.datediff(safe_date(end), safe_date(start))


def date_text_to_epoch_millis(col: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """Date/time text -> epoch milliseconds, the text read as UTC wall clock
    (independent of the session zone for date-only formats; a format with a
    time of day is parsed in the session zone and read back as wall clock)."""
    if not any(ch in fmt for ch in "HhKkms"):
        ts = F.try_to_date(_c(col), fmt).cast("timestamp_ntz")
    else:
        ts = F.try_to_timestamp(_c(col), F.lit(fmt)).cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), ts)


def ts_text_to_millis(col: ColumnOrName, keep_fraction: bool = False) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.SSS]`` text -> epoch millis (UTC wall clock).
    The studied formatter stops at whole seconds, so by default the fraction
    is ignored; ``keep_fraction`` keeps it."""
    c = _c(col)
    if not keep_fraction:
        c = F.substring(c, 1, 19)
    ts = c.try_cast("timestamp_ntz")              # text -> wall clock, no zone involved
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), ts)


def epoch_seconds_to_text(col: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """``from_unixtime`` in UTC wall clock, independent of the session zone."""
    return F.date_format(F.timestamp_add("SECOND", _c(col), F.expr(_EPOCH_NTZ)), fmt)


def epoch_millis_to_text(col: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return epoch_seconds_to_text(F.floor(_c(col) / 1000), fmt)


def ntz_epoch_millis(col: ColumnOrName) -> Column:
    """timestamp_ntz -> epoch millis (UTC wall clock)."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), _c(col))


# --- SCL-11 / 12 / 13 / 14: casts, nulls, collections --------------------------------

def safe_long(col: ColumnOrName, sentinel: str = K.MISSING_TEXT, default: int | None = 0) -> Column:
    """``"NULL"`` / null / junk -> ``default``; else the long value."""
    c = _c(col).cast("string")
    v = F.when(c == sentinel, F.lit(None)).otherwise(c.try_cast("bigint"))
    return v if default is None else F.coalesce(v, F.lit(default).cast("bigint"))


def safe_int(col: ColumnOrName) -> Column:
    return _c(col).cast("string").try_cast("int")


def nvl(col: ColumnOrName, default) -> Column:
    return F.coalesce(_c(col), _lit(default))


def element_1based(arr: ColumnOrName, idx: ColumnOrName) -> Column:
    return F.try_element_at(_c(arr), _c(idx))


# --- SCL-15 / 16: JSON --------------------------------------------------------------

def json_fields(col: ColumnOrName, schema: str) -> Column:
    return F.from_json(_c(col), schema)


# --- SCL-17: IPv4 ---------------------------------------------------------------------

def ip_to_long(col: ColumnOrName) -> Column:
    """Dotted IPv4 text -> long by folding ``(n << 8) | octet``.  The usual
    four-part address takes a plain arithmetic path (code-generated); any
    other shape is folded part by part, as the studied function did (empty
    parts at the end are dropped first: ``1.2.3.4.`` is an address)."""
    parts = F.split(F.rtrim(_c(col), F.lit(".")), r"\.")
    octet = lambda i: F.get(parts, i).try_cast("bigint")
    four = (F.shiftleft(octet(0), 24).bitwiseOR(F.shiftleft(octet(1), 16))
            .bitwiseOR(F.shiftleft(octet(2), 8)).bitwiseOR(octet(3)))
    fold = F.aggregate(parts, F.lit(0).cast("bigint"),
                       lambda acc, x: F.shiftleft(acc, 8).bitwiseOR(x.try_cast("bigint")))
    return F.when(F.size(parts) == 4, four).otherwise(fold)


def long_to_ip(col: ColumnOrName) -> Column:
    c = _c(col).cast("bigint")
    return F.concat_ws(".", *[F.shiftright(c, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)])


# --- SCL-18 / 19: mapping, arithmetic ----------------------------------------------------

def map_label(col: ColumnOrName, mapping: Mapping[str, str], default: ColumnOrName | None = None) -> Column:
    """``case col when k then v ... else default end`` (default: the value)."""
    c = _c(col)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    dflt = c if default is None else _c(default) if isinstance(default, Column) else F.lit(default)
    return dflt if out is None else out.otherwise(dflt)


def percent(part: ColumnOrName, whole: ColumnOrName) -> Column:
    return _c(part) / _c(whole) * 100


# --- UDF-01..06: the studied scalar functions as native expressions -----------------------

def bucket_floor(x: ColumnOrName, step: ColumnOrName | int) -> Column:
    """Largest multiple of ``step`` not above ``x`` (negatives too);
    ``step <= 1`` -> 0; null in -> null."""
    xc, sc = _c(x), _lit(step)
    return (F.when(xc.isNull() | sc.isNull(), F.lit(None).cast("int"))
            .when(sc <= 1, F.lit(0))
            .otherwise((xc - F.pmod(xc, sc)).cast("int")))


def user_type(days: ColumnOrName, last_act: ColumnOrName,
              new_days: int = K.NEW_USER_DAYS, active_days: int = K.ACTIVE_DAYS) -> Column:
    """``new`` within ``new_days`` of sign-up, else ``old`` if active within
    ``active_days``, else ``"0"``; null in -> null."""
    d, a = _c(days), _c(last_act)
    return (F.when(d.isNull() | a.isNull(), F.lit(None).cast("string"))
            .when(d <= new_days, F.lit(K.USER_NEW))
            .when(a <= active_days, F.lit(K.USER_OLD))
            .otherwise(F.lit(K.NEITHER_USER_TYPE)))


def love_days_type(days: ColumnOrName, split: int = K.LOVE_DAYS_SPLIT) -> Column:
    d = _c(days)
    return (F.when(d.isNull(), F.lit(None).cast("string"))
            .when(d <= split, F.lit(K.LOVE_SHORT)).otherwise(F.lit(K.LOVE_LONG)))


def country_pair_type(a: ColumnOrName, b: ColumnOrName, home: str = K.HOME_COUNTRY,
                      partners: Mapping[str, str] = K.COUNTRY_PAIR_LABELS,
                      other: str = K.OTHER_PAIR) -> Column:
    """Unordered pair (home, partner) -> label; anything else -> ``other``."""
    ac, bc = _c(a), _c(b)
    out = None
    for partner, label in partners.items():
        cond = ((ac == home) & (bc == partner)) | ((ac == partner) & (bc == home))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(other) if out is None else out.otherwise(F.lit(other))


def age_at(birthday: ColumnOrName, as_of: str = K.REFERENCE_AS_OF,
           missing: str = K.MISSING_TEXT) -> Column:
    """Full years at ``as_of`` from ``yyyy-MM-dd`` text; ``"NULL"`` -> -1.
    Plain year/month/day compare (Feb 29 birthdays age on Mar 1)."""
    y0, m0, d0 = (int(p) for p in as_of.split("-"))
    bc = _c(birthday).cast("string")
    parts = F.split(bc, "-")
    y = F.get(parts, 0).try_cast("int")
    m = F.get(parts, 1).try_cast("int")
    d = F.get(parts, 2).try_cast("int")
    age = (F.lit(y0) - y
           - F.when(F.lit(m0) < m, 1).when((F.lit(d0) < d) & (m == m0), 1).otherwise(0))
    return F.when(bc == missing, F.lit(-1)).otherwise(age.cast("int"))


def same_country_type(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Equal (null-safe) -> ``同国``, else ``异国``."""
    return F.when(_c(a).eqNullSafe(_c(b)), F.lit(K.SAME_COUNTRY)).otherwise(F.lit(K.DIFFERENT_COUNTRY))
