"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None) -> SparkSession:
    """A session for tests and the bench. On a cluster the submitter's settings are used."""
    builder = (
        SparkSession.builder.master(master)
        .appName("firmlens")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    session = builder.getOrCreate()
    ship(session)
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    sc = spark.sparkContext
    # The context appends a folder of its own to the setting, so the setting itself comes first.
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="firmlens-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


class _Inside(threading.local):
    """The open ``temporary`` blocks of one thread: other threads' tables are not theirs to remove."""

    def __init__(self):
        self.blocks: list[list[str]] = []


_inside = _Inside()


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the application's own folder below the shared one.

    The folder goes when the application ends; what is made inside ``temporary`` goes with the block.
    """
    own = f"{shared_dir(spark).rstrip('/')}/firmlens-{spark.sparkContext.applicationId}"
    folder, store = _path(spark, own)
    store.mkdirs(folder)
    store.deleteOnExit(folder)
    path = f"{own}/{name}-{uuid.uuid4().hex}"
    if _inside.blocks:
        _inside.blocks[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    target, store = _path(spark, path)
    store.delete(target, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Written tables that this thread makes inside are removed at the end. For work that is finished
    by then: nothing that is still to be computed may read them."""
    _inside.blocks.append([])
    try:
        yield
    finally:
        for path in _inside.blocks.pop():
            remove(spark, path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, unless it is installed there anyway."""
    sc = spark.sparkContext
    if getattr(sc, "_firmlens_shipped", False):
        return
    sc._firmlens_shipped = True
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="firmlens-ship-"), "firmlens.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there, and a lost
    executor costs a re-read instead of a re-run that could come out differently."""
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def hold(df: DataFrame) -> DataFrame:
    """``settle`` and keep in memory, for solvers that pass over the rows many times. The written
    copy has as many partitions as its size asks for, and a lost cached block is read, not redone.
    Call ``unpersist`` when done."""
    return settle(df).persist()


def release(df: DataFrame) -> None:
    """Forget a held table that nothing reads any more, its written copy too."""
    df.unpersist()
    if getattr(df, "_written", None):
        remove(df.sparkSession, df._written)


def parallelism(spark: SparkSession) -> int:
    """Tasks for work that is heavy per row, where small-partition merging would hurt."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
