"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"


def build_session(app: str = "stratavault", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling on, UTC clock, no web page."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # larger generated methods are never compiled by the JVM; smaller pieces are
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, else a fresh local one (tests only)."""
    named = spark.conf.get(SHARED_DIR_KEY, None) or spark.sparkContext.getConf().get(SHARED_DIR_KEY, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_DIR_KEY} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="stratavault-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set(SHARED_DIR_KEY, made)
    return made


_STORED: list[str] = []


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder in any store that the session reaches; whether there was one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in store.listStatus(place)) if store.exists(place) else []


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Give a file or folder another name in its store, and make the folders above it."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    store = old.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(new.getParent())
    if not store.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, to be deleted by :func:`release`."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _STORED.append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back, so that later plans start from files.

    Used where one result feeds several outputs; a lost executor re-reads files instead of recomputing
    the whole lineage. :func:`release` deletes what was stored, once the results built on it have been used.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete all intermediate tables stored so far; returns their number. Results that read them end with this."""
    done = 0
    while _STORED:
        done += delete_path(spark, _STORED.pop())
    return done
