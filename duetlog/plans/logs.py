"""Log and export jobs (PIPE-04, PIPE-14..17, PIPE-20..24).

Inputs are DataFrames: raw text lines (``value``), JSON-derived rows or
tables.  Readers live in ``duetlog.sources``; writers in ``duetlog.sinks``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..operators.windows import global_row_number
from .farm import valid_ids


# --- PIPE-14 ---------------------------------------------------------------------

def parse_space_log(lines: DataFrame, positions: Mapping[str, int], min_fields: int,
                    drop_containing: str | None = None, keep_containing: Sequence[str] = (),
                    malformed: Sequence[str] | None = None) -> DataFrame:
    """Space-delimited lines -> named fields by position.

    Lines shorter than ``min_fields`` become the ``malformed`` sentinel row
    (the studied parser's ``("0","0","0")``); with ``malformed=None`` they keep
    the fields they have and get nulls for the rest.  Trailing empty fields are dropped first, as ``String.split``
    does."""
    v = F.col("value")
    df = lines
    if drop_containing:
        df = df.where(~v.contains(drop_containing))
    for s in keep_containing:
        df = df.where(v.contains(s))
    arr = F.split(F.regexp_replace(v, " +$", ""), " ")
    ok = F.size(arr) >= min_fields
    cols = []
    for i, (name, pos) in enumerate(positions.items()):
        val = F.get(arr, pos)
        if malformed is not None:
            val = F.when(ok, val).otherwise(F.lit(malformed[i]))
        cols.append(val.alias(name))
    return df.select(*cols)


def log_ip_counts(lines: DataFrame) -> DataFrame:
    """Rows per (date, user, ip) of a request log; ``K.VIEW_MARKER``
    lines dropped, short lines counted under the ``0,0,0`` sentinel."""
    parsed = parse_space_log(lines, {"date": 0, "user_id": 4, "ip": 3}, min_fields=6,
                             drop_containing=K.VIEW_MARKER, malformed=K.MALFORMED_LOG)
    return (parsed.where(F.col("user_id").isNotNull())
                  .groupBy("date", "user_id", "ip").agg(F.count(F.lit(1)).alias("ip_num_cnt"))
                  .orderBy("date", "user_id"))


# --- PIPE-15 ---------------------------------------------------------------------

def log_uv(lines: DataFrame, threshold: int = K.UV_THRESHOLD, marker: str = K.LOG_MARKER) -> DataFrame:
    """Distinct users per (type, date) among ``marker`` lines, kept when at
    least ``threshold``."""
    parsed = parse_space_log(lines, {"types": 0, "date": 1, "spaceId": 7, "userId": 8}, min_fields=9,
                             keep_containing=(marker, " "))
    return (parsed.groupBy("types", "date").agg(F.countDistinct("userId").alias("uv"))
                  .where(F.col("uv") >= threshold).orderBy("date", "types"))


# --- PIPE-16 ---------------------------------------------------------------------

DATE_IN_NAME = r"log_(\d{4}-\d{2}-\d{2})"


def users_by_file_date(lines_with_path: DataFrame, pattern: str = DATE_IN_NAME,
                       path_col: str = "file_path") -> DataFrame:
    """``(user_id, c_date)``: first field of each line, date from its file
    name - one scan over all files (the studied job listed files on the
    driver and read them one by one)."""
    return lines_with_path.select(
        C.split_get("value", " ", 0).alias("user_id"),
        F.regexp_extract(F.col(path_col), pattern, 1).alias("c_date"))


# --- PIPE-17 ---------------------------------------------------------------------

SOURCE_RULES = {
    # name: (id column, event name or None, time rule)
    "tree": ("user_id", "click_trace", "upper"),
    "farm": ("user_id", None, "range"),
    "house": ("user_id", "login", "upper"),
    "qqmp": ("user_id", "login", "upper"),
    "wxmp": ("open_id", None, "upper"),
    "app": ("user_id", None, "upper"),
}


def active_pairs(sources: Mapping[str, DataFrame], upper_ms: int, farm_range: tuple[int, int],
                 app_name: str = "main", ts_col: str = "ts_ms", rules=SOURCE_RULES) -> DataFrame:
    """Union (by position) of the valid ``(space_id, id)`` pairs of each
    source; names come from the first input, as in the studied job."""
    parts = []
    for name, (id_col, bn, rule) in rules.items():
        df = sources[name]
        if bn is not None:
            df = df.where(F.col("bn") == bn)
        df = valid_ids(df, ("space_id", id_col))
        ts = F.col(ts_col)
        df = df.where(ts.between(*farm_range) if rule == "range" else ts <= upper_ms)
        parts.append(df.where(F.col("app_name") == app_name).select("space_id", id_col))
    return reduce(DataFrame.union, parts)


def active_union_lines(sources: Mapping[str, DataFrame], day_list: DataFrame, upper_ms: int,
                       farm_range: tuple[int, int], prefix: str = "7") -> DataFrame:
    """Active pairs whose space id starts with ``prefix``, plus a fixed
    ``(space_id, user_id)`` list, as ``"space user"`` text lines."""
    pairs = active_pairs(sources, upper_ms, farm_range)
    pairs = pairs.where(F.col("space_id").cast("string").startswith(prefix))
    both = pairs.union(day_list.select("space_id", "user_id"))
    return both.select(F.concat_ws(" ", F.col("space_id").cast("string"),
                                   F.col(both.columns[1]).cast("string")).alias("value"))


# --- PIPE-20 ---------------------------------------------------------------------

def term_time_range(df: DataFrame, term_col: str, term: str, ts_col: str, lo, hi) -> DataFrame:
    """``term_col = term AND lo <= ts <= hi`` (both ends inclusive) - the
    pushed-down query of the studied index read, on any source."""
    return df.where((F.col(term_col) == term) & F.col(ts_col).between(lo, hi))


def index_users(index: DataFrame, term: str, lo, hi, term_col: str = "sv", ts_col: str = "ts") -> DataFrame:
    """Valid ``(space_id, user_id)`` of one service in a time range, as
    ``"space user"`` text lines (one column, so a text sink can take it)."""
    hits = valid_ids(term_time_range(index, term_col, term, ts_col, lo, hi))
    return hits.select(F.concat_ws(" ", F.col("space_id").cast("string"),
                                   F.col("user_id").cast("string")).alias("value"))


# --- PIPE-21 ---------------------------------------------------------------------

def numbered_new_users(new_user: DataFrame, c_date: str) -> DataFrame:
    """New users of one day partition, numbered by ``(space_id, user_id)``."""
    day = new_user.where(F.col("c_date") == c_date).select(
        "user_id", "space_id", C.date_text_to_epoch_millis("c_date").alias("time"))
    return global_row_number(day, ["space_id", "user_id"])


# --- PIPE-22 ---------------------------------------------------------------------

def resort_report(lines: DataFrame) -> DataFrame:
    """Tab lines ``date, dim, el, num`` sorted by el, dim ascending and date
    descending."""
    arr = F.split(F.col("value"), "\t")
    rows = lines.select(*[F.get(arr, i).alias(n) for i, n in enumerate(("date", "dim", "el", "num"))])
    return rows.orderBy(F.asc("el"), F.asc("dim"), F.desc("date"))


# --- PIPE-23 ---------------------------------------------------------------------

def revenue_by_platform(orders_paid: DataFrame, logins: DataFrame, since: str) -> DataFrame:
    """Paid revenue per (platform, os): paid orders per user since a date
    partition, inner-joined with distinct user/os/platform rows."""
    paid = (orders_paid.where((F.col("c_date") >= since) & F.col("pay_date").isNotNull())
            .groupBy("user_id").agg(F.sum("price").alias("price")))
    users = logins.select("user_id", "os", "platform").dropDuplicates()
    return (users.join(paid, "user_id").where(paid["user_id"].isNotNull())
                 .groupBy("platform", "os").agg(F.sum("price").alias("price")))


# --- PIPE-04 ---------------------------------------------------------------------

def two_app_avgs(apps: Mapping[str, DataFrame]) -> DataFrame:
    """Global averages of two counters for each app's input."""
    parts = [df.select(F.lit(name).alias("app"), F.avg("anni_create").alias("avg_anni"),
                       F.avg("photo_create").alias("avg_photo")) for name, df in apps.items()]
    return reduce(DataFrame.unionByName, parts)
