"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
_bucketed: dict[str, list[str]] = {}    # application id -> names of its bucketed tables
_local_dirs: dict[str, str] = {}    # application id -> folder of a one-process session without the setting


def build_session(app: str = "skeinwork", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the settings the jobs expect; `conf` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in `spark.checkpoint.dir`.

    The setting is required wherever executors are processes of their own. A
    session that is one process (`local[n]`) and lacks it, as in tests, gets a
    temporary folder that goes when the process ends.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="skeinwork-")
            atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
        path = _local_dirs[app]
    return path.rstrip("/")


def _home(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/skeinwork/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{_home(spark)}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark reaches."""
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own making; nothing happens when it is not there."""
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def name_parts(spark: SparkSession, path: str, n: int, name: str, empty: bytes = b"") -> None:
    """Give the part files of partitions 0 to n - 1 in a written folder the names `name.format(partition)`.

    Renames only, on any file system that Spark reaches, after the write has
    been committed. The writer makes no file for a partition without rows: it
    gets one that holds `empty`.
    """
    fs, where = _file_system(spark, path)
    parts = {}
    for status in fs.listStatus(where):
        found = re.match(r"part-(\d+)-", status.getPath().getName())
        if found:
            parts[int(found.group(1))] = status.getPath()
    for number in range(n):
        target = spark._jvm.org.apache.hadoop.fs.Path(where, name.format(number))
        if number in parts:
            fs.rename(parts[number], target)
        else:
            out = fs.create(target)
            out.write(bytearray(empty))
            out.close()


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value) -> Iterator[None]:
    """The session's setting has this value meanwhile; a stream keeps what it finds at its start."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def remove_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once its results are written."""
    for name in _bucketed.pop(spark.sparkContext.applicationId, ()):
        spark.sql(f"drop table if exists {name}")
    remove_path(spark, _home(spark))


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` as a parquet table in the shared folder and read it back.

    Cuts the lineage like `checkpoint()`, survives the loss of any executor,
    and gives the planner real file sizes and a pruned scan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, name: str = "table") -> tuple[DataFrame, int]:
    """`materialize`, and the number of rows, counted while they are written."""
    seen = Observation()
    written = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return written, seen.get["rows"]


def materialize_bucketed(df: DataFrame, buckets: int, *columns: str) -> DataFrame:
    """Write `df` in the shared folder as a table of `buckets` buckets by the columns, one sorted file each.

    A join or aggregation on these columns reads the buckets as they lie: only
    the other side is shuffled. The table is registered in the session's catalog
    under a name of its own until `remove_scratch`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "bucketed")
    name = "skeinwork_" + path.rsplit("-", 1)[-1]
    dealt = df.repartition(buckets, *columns)
    dealt.write.format("parquet").bucketBy(buckets, *columns).sortBy(*columns).option("path", path).saveAsTable(name)
    _bucketed.setdefault(spark.sparkContext.applicationId, []).append(name)
    return spark.table(name)
