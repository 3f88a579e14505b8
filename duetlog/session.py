"""Session construction and shared-folder helpers.

Every job takes a ready ``SparkSession``; this module only builds one for
tests, the bench and command-line use.  Settings are the ones that matter at
scale: adaptive execution (coalescing, skew-join splitting, runtime broadcast
conversion), UTC wall clock, ANSI left on.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "duetlog",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.  ``master`` is only set when given, so a
    cluster submit keeps its own master URL."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The folder is read from the running context or ``spark.checkpoint.dir``.
    Where neither is set, a local master (tests, a laptop) gets a private
    folder; any other master raises, because executors on other machines
    would write to their own disks and the read-back would be incomplete."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="duetlog-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for
    intermediate tables written by a job (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/duetlog-{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of any path Spark can write."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file."""
    fs, p = _file_system(spark, path)
    fs.create(p, True).close()


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet: a whole hidden file, then
    a rename, so readers see all of it or nothing and of two writers one
    fails."""
    fs, p = _file_system(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(part, p):
        fs.delete(part, False)
        raise FileExistsError(path)


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, p = _file_system(spark, path)
    source = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def set_times(spark: SparkSession, path: str, millis: int) -> None:
    """Set a file's modification time (arrival order of a replay)."""
    fs, p = _file_system(spark, path)
    fs.setTimes(p, millis, -1)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths directly under a folder, by name."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(p))


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and
    safe against executor loss."""
    path = staging_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver's Parquet tables (one plan at every size)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
