"""The studied scalar functions as SQL functions (UDF-10).

``register(spark)`` creates session-scoped, SQL-bodied functions, so SQL
users can write ``SELECT bucket_floor(love_days, 5) ...``.  Their bodies are
plain SQL expressions that the optimizer inlines into the calling plan
(whole-stage codegen, no Python worker), with the same semantics as the
Column functions in ``columns.py``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import constants as K


def _pairs_case(a: str, b: str, home: str, partners: dict[str, str], other: str) -> str:
    whens = " ".join(f"WHEN ({a} = '{home}' AND {b} = '{p}') OR ({a} = '{p}' AND {b} = '{home}') THEN '{l}'"
                     for p, l in partners.items())
    return f"CASE {whens} ELSE '{other}' END"


def definitions(as_of: str = K.REFERENCE_AS_OF) -> dict[str, str]:
    y, m, d = (int(p) for p in as_of.split("-"))
    return {
        "bucket_floor": "(x INT, step INT) RETURNS INT RETURN CASE WHEN x IS NULL OR step IS NULL THEN NULL "
                        "WHEN step <= 1 THEN 0 ELSE x - pmod(x, step) END",
        "user_type": f"(days INT, last_act INT) RETURNS STRING RETURN CASE WHEN days IS NULL OR last_act IS NULL "
                     f"THEN NULL WHEN days <= {K.NEW_USER_DAYS} THEN '{K.USER_NEW}' "
                     f"WHEN last_act <= {K.ACTIVE_DAYS} THEN '{K.USER_OLD}' ELSE '{K.NEITHER_USER_TYPE}' END",
        "love_days_type": f"(days INT) RETURNS STRING RETURN CASE WHEN days IS NULL THEN NULL "
                          f"WHEN days <= {K.LOVE_DAYS_SPLIT} THEN '{K.LOVE_SHORT}' ELSE '{K.LOVE_LONG}' END",
        "country_pair_type": "(a STRING, b STRING) RETURNS STRING RETURN "
                             + _pairs_case("a", "b", K.HOME_COUNTRY, K.COUNTRY_PAIR_LABELS, K.OTHER_PAIR),
        "same_country_type": f"(a STRING, b STRING) RETURNS STRING RETURN CASE WHEN a <=> b "
                             f"THEN '{K.SAME_COUNTRY}' ELSE '{K.DIFFERENT_COUNTRY}' END",
        "age_at": f"(birthday STRING) RETURNS INT RETURN CASE WHEN birthday = '{K.MISSING_TEXT}' THEN -1 ELSE "
                  f"CAST({y} - try_cast(get(split(birthday, '-'), 0) AS INT) - CASE "
                  f"WHEN {m} < try_cast(get(split(birthday, '-'), 1) AS INT) THEN 1 "
                  f"WHEN {d} < try_cast(get(split(birthday, '-'), 2) AS INT) "
                  f"AND try_cast(get(split(birthday, '-'), 1) AS INT) = {m} THEN 1 ELSE 0 END AS INT) END",
        "ip_to_long": "(ip STRING) RETURNS BIGINT RETURN aggregate(split(ip, '[.]'), 0L, "
                      "(acc, x) -> shiftleft(acc, 8) | try_cast(x AS BIGINT))",
    }


def register(spark: SparkSession, as_of: str = K.REFERENCE_AS_OF) -> list[str]:
    """Create (or replace) the temporary SQL functions; returns their names."""
    defs = definitions(as_of)
    for name, body in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(defs)
