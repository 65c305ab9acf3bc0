"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgermatch", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings of SURVEY §4.4.

    On a cluster leave ``master`` unset and let spark-submit decide; the
    shuffle partition count should then be sized to the data (AQE coalesces
    small ones at run time).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_BASE: dict[str, str] = {}


def checkpoint_base(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session,
    as it is written there (any URI scheme).

    Where it is unset, a local master gets one temporary folder per
    application, remembered here (no configuration is changed) and removed at
    exit; on a cluster master a machine-local folder would be wrong, so that
    is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = session_key(spark)
    if key not in _LOCAL_BASE:
        _LOCAL_BASE[key] = tempfile.mkdtemp(prefix="ledgermatch-")
        atexit.register(shutil.rmtree, _LOCAL_BASE[key], ignore_errors=True)
    return _LOCAL_BASE[key]


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under ``checkpoint_base``; Spark makes the folder when
    something is written to it. It is deleted when the application ends."""
    path = f"{checkpoint_base(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    except AttributeError:  # Spark Connect has no JVM handle; the folder's owner cleans it
        pass
    return path


# How much of a file, and of a shuffle, one task reads.
TASK_SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
_TASK_LOCK = threading.Lock()
_TASK_HELD: dict[str, tuple[int, dict[str, str]]] = {}


def size_bytes(text: str) -> int:
    """Bytes of a size as Spark writes it (``64MB``, ``16m``, ``67108864b``)."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def small_tasks(spark: SparkSession, most: int | None) -> Iterator[None]:
    """Tasks that read at most ``most`` bytes each, for actions inside; smaller
    settings of the session stay. Threads share it: the last one out restores."""
    if most is None:
        yield
        return
    key = session_key(spark)
    with _TASK_LOCK:
        users, before = _TASK_HELD.get(key, (0, {}))
        if not users:
            before = {k: v for k in TASK_SIZES if size_bytes(v := spark.conf.get(k)) > most}
            for k in before:
                spark.conf.set(k, f"{most}b")
        _TASK_HELD[key] = (users + 1, before)
    try:
        yield
    finally:
        with _TASK_LOCK:
            users, before = _TASK_HELD.pop(key)
            if users > 1:
                _TASK_HELD[key] = (users - 1, before)
            else:
                for k, v in before.items():
                    spark.conf.set(k, v)


def materialize(df: DataFrame, name: str, partition_by: str | None = None, task_bytes: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the
    lineage without depending on any single executor's disk. With ``task_bytes``
    a task of the write reads no more than that, whatever the table's size."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    writer = df.write.mode("overwrite")
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")   # the table replaces the shuffle files that made it
    try:
        with small_tasks(spark, task_bytes):
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    # read with the written schema: no footer-inference job, same column order
    out = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    out._materialized_at = path
    return out


def release(table: DataFrame) -> None:
    """Deletes the folder of a ``materialize`` result that nothing will read
    any more (left to the end of the application where there is no JVM handle)."""
    spark, path = table.sparkSession, table._materialized_at
    try:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
    except AttributeError:
        pass


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (classic or Spark Connect)."""
    try:
        return spark.conf.get("spark.app.id")
    except Exception:
        return str(id(spark))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable: register the session's shared
    folder on the context when the context has none yet."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect manages checkpoint storage itself
        return
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_base(spark))
