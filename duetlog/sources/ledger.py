"""Import each arriving file once, whatever is run again (SRC-09, PIPE-16).

The ledger says which files - path, size and modification time - are in which
import.  ``import_new`` lists the arriving files, leaves out those in the
ledger, writes the rest as one import folder and then its ledger entry, a
single rename.  A run that dies before the entry leaves a folder that nobody
reads and that the next run overwrites; a second run finds nothing new.  A
file that was replaced under its old name counts as new, and the rows of the
older one are not read any more.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_files, path_exists, read_small, write_once


def arriving(spark: SparkSession, pattern: str) -> dict[str, list]:
    """Path -> [size, modification time] of the files that match a glob."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(path) or []
    return {s.getPath().toString(): [s.getLen(), s.getModificationTime()] for s in found
            if s.isFile() and not s.getPath().getName().startswith(("_", "."))}


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> list[dict]:
        """Per import its files, in order."""
        if not path_exists(self.spark, f"{self.path}/ledger"):
            return []
        names = [f for f in list_files(self.spark, f"{self.path}/ledger") if f.endswith(".json") and f.rsplit("/", 1)[1][0] != "."]
        return [json.loads(read_small(self.spark, f)) for f in names]

    def files(self) -> dict[str, tuple[int, list]]:
        """File -> (the import it was last read in, [size, time])."""
        return {f: (n, about) for n, e in enumerate(self.entries()) for f, about in e["files"].items()}

    def import_new(self, pattern: str, read: Callable[[list[str]], DataFrame]) -> list[str]:
        """Import the files that are new; ``read`` turns paths into rows with
        a ``file_path`` column.  Returns the files imported."""
        known = {f: about for f, (_, about) in self.files().items()}
        new = {f: about for f, about in sorted(arriving(self.spark, pattern).items()) if known.get(f) != about}
        if not new:
            return []
        number = len(self.entries())
        read(list(new)).write.mode("overwrite").parquet(f"{self.path}/import={number}")
        write_once(self.spark, f"{self.path}/ledger/{number:012d}.json", json.dumps({"files": new}))
        return list(new)

    def read(self, schema: str) -> DataFrame:
        """The imported rows; of a file imported twice the newer rows."""
        entries = self.entries()
        if not entries:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, `import` INT").option("basePath", self.path).parquet(
            *[f"{self.path}/import={n}" for n in range(len(entries))])
        latest = self.files()
        stale = [(f, n) for n, e in enumerate(entries) for f in e["files"] if latest[f][0] != n]
        if stale:
            old = self.spark.createDataFrame(stale, "_file string, _import int")
            rows = rows.join(old, (F.col("file_path") == F.col("_file")) & (F.col("import") == F.col("_import")), "left_anti")
        return rows.drop("import")
