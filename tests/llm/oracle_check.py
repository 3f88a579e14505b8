"""Spark against DuckDB for the queries of ``duetlog.llm``; also a script:
``python tests/llm/oracle_check.py NAME [sf_dir]``."""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


def compare(name, spark, sf_dir="/root/testdata/sf0.01"):
    from duetlog.llm import queries
    from tests.oracle import _rows, duck_connect
    got = queries.QUERIES[name](spark, sf_dir)
    cols, rows = _rows(got.columns, got.collect())
    cur = duck_connect(sf_dir).execute(queries.ORACLE_SQL[name])
    want_cols, want = _rows([c[0] for c in cur.description], cur.fetchall())
    assert cols == want_cols, (cols, want_cols)
    bad = [(a, b) for a, b in zip(rows, want) if a != b]
    assert len(rows) == len(want) and not bad, (len(rows), len(want), len(bad), bad[:3])
    return len(rows)


if __name__ == "__main__":
    from duetlog.session import get_session
    s = get_session("local[8]", shuffle_partitions=8)
    print(sys.argv[1], compare(sys.argv[1], s, *sys.argv[2:]))
