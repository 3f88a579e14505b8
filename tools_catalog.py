"""Write CATALOG.md: every registered query with its SURVEY ids, module and
whether it has a DuckDB twin.  Run: python tools_catalog.py"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from duetlog.catalog import registry  # noqa: E402


NO_KEY = [
    ("SRC-12 Excel", "not built", "a local library behind a thin wrapper; export the sheet as CSV"),
    ("SRC-13 JDBC read", "`sources.readers.read_jdbc` (optionally range-partitioned)", "no: no database or driver here"),
    ("SRC-19 Kafka itself", "`sources.readers.read_stream(spark, 'kafka', options)`", "no jar; an own log source runs as `src_partitioned_log`"),
    ("SRC-20 socket", "`sources.readers.read_stream(spark, 'socket', options)`", "not opened (no servers in tests)"),
    ("SNK-07 Hive-format append", "`sinks.writers.append_table(fmt=...)`", "parquet format in `snk_table_append`"),
    ("SNK-08 JDBC append", "`sinks.writers.write_jdbc` (bounded connections)", "no: no database here"),
    ("UDF-10 registration", "`functions.sql_functions.register` (SQL-bodied, inlined)", "`tests/test_functions.py`"),
    ("STR-01 trigger interval", "`streaming.alarm.run_alarm_stream(trigger=...)` (default 30 s)", "availableNow in tests"),
]


def main() -> None:
    registry.load_all()
    lines = ["# CATALOG", "", "Every registered query (`__spark_entry__.queries()`), the SURVEY §2 rows it",
             "covers, where it lives and whether `oracle_sql()` has a DuckDB twin.  Generated by",
             "`python tools_catalog.py`.", "", "| Key | SURVEY rows | Module | DuckDB twin | What it does |",
             "|---|---|---|---|---|"]
    for k in sorted(registry.QUERIES):
        fn = registry.QUERIES[k]
        doc = " ".join((fn.__doc__ or "").split())
        ids = ", ".join(re.findall(r"\b[A-Z]{2,4}-\d{2}\b", doc)) or "-"
        text = re.sub(r"^([A-Z]{2,4}-\d{2}( / )?)+:?\s*", "", doc).replace("|", "/")
        mod = fn.__module__.replace("duetlog.", "")
        lines.append(f"| `{k}` | {ids} | `{mod}` | {'yes' if k in registry.ORACLE else 'no'} | {text} |")
    lines += ["", "## SURVEY rows without a query key", "",
              "| SURVEY row | Covered by | Tested |", "|---|---|---|"]
    lines += [f"| {a} | {b} | {c} |" for a, b, c in NO_KEY]
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "CATALOG.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
