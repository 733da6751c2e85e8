"""Session helpers: the shared work folder and durable cut points."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Set by ``work_scope`` while it is open, and once for a local session without a work folder.
SCOPE_KEY = "wattline.work.dir"


def local_session(app: str = "wattline", cpus: int | str = "*", work: str | None = None) -> SparkSession:
    """Session for tests and the bench, with a work folder; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config(CHECKPOINT_KEY, work or tempfile.mkdtemp(prefix="wattline-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    The cluster sets ``spark.checkpoint.dir``. Only a local session without the
    setting gets a fresh temporary folder, since driver and executors then share
    one machine; anywhere else a missing setting is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get(SCOPE_KEY, None) or spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if root:
        return root
    if not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="wattline-")
    spark.conf.set(SCOPE_KEY, root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is ever overwritten."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The file system that holds a path, and the path as it names it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[str]:
    """Tables cut inside the scope go to a folder of their own, which is removed at its end.

    Frames made inside read those tables, so write or collect them before the scope closes.
    """
    outer = spark.conf.get(SCOPE_KEY, None)
    inner = work_path(spark, "scope")
    spark.conf.set(SCOPE_KEY, inner)
    try:
        yield inner
    finally:
        if outer:
            spark.conf.set(SCOPE_KEY, outer)
        else:
            spark.conf.unset(SCOPE_KEY)
        fs, folder = file_system(spark, inner)
        fs.delete(folder, True)


def cut(df: DataFrame, name: str = "cut", codec: str | None = None) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared folder and read it back.

    Used where a plan feeds several consumers: the lineage ends at files that
    outlive any executor, unlike cached blocks. ``codec`` is the session's by default;
    text is a third as large in zstd as in snappy.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table of this name: written by the first who asks for it, read by those who follow.

    A session remembers where it lies; where it has gone meanwhile (a closed scope), it is
    built again.
    """
    key = f"wattline.stored.{name}"
    path = spark.conf.get(key, None)
    if path:
        fs, place = file_system(spark, path)
        if fs.exists(place):
            return spark.read.parquet(path)
    path = work_path(spark, "stored")
    build().write.parquet(path)
    spark.conf.set(key, path)
    return spark.read.parquet(path)
