"""Session helpers: defaults, the shared working folder and input parallelism."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.settings import COMPRESSION, MAX_BROADCAST_ROWS

_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)
#: With it a job's shuffle files go when the job ends, and not when the driver happens to collect its garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "corpuslake", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    A machine-local folder is only used by a local master with no folder named,
    because executors on other machines could not read it back.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="corpuslake-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` stored once in the shared folder, for plans that read it several times.

    Unlike a cache it survives the loss of executors without being computed again.
    Inside :func:`scratch` it is there until that ends, else until it is deleted by hand.
    """
    folder, made = shared_folder(df.sparkSession, purpose), _scratch.get()
    if made is not None:
        made.append(folder)
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(folder)
    return df.sparkSession.read.parquet(folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes what :func:`written` stored in this block at its end, when nothing may read it any more.

    Shuffle files go with the job that wrote them, so a plan that ran is not to run again.
    """
    before, token = spark.conf.get(_TIDY, None), _scratch.set([])
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_TIDY)
        else:
            spark.conf.set(_TIDY, before)
        made = _scratch.get()
        _scratch.reset(token)
        for folder in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, none when it does not exist."""
    if not folder_exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return [status.getPath().getName() for status in listed]


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with ``*``, on the file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return [status.getPath().toString() for status in found or []]


def make_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def spread(df: DataFrame) -> DataFrame:
    """Use every core when the input has fewer splits than the cluster has slots.

    A large input has more splits than slots, and is returned untouched.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def fits(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; stops counting beyond them."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when its counted size allows it.

    Beyond the bound the plan keeps a shuffled join, where the adaptive skew
    handling splits hot keys.
    """
    return F.broadcast(df) if fits(df, max_rows) else df
