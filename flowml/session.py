"""Session construction and shared scratch locations."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Whether the shuffle files of a query go when it ends; else they lie until the driver happens to collect its garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Lists that note what is materialised now.
_NOTED: ContextVar[tuple[list[str], ...]] = ContextVar("noted", default=())


def get_session(master: str | None = None, app: str = "flowml",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the library is tuned for.

    A master is set only when the caller passes one: otherwise the one given to
    spark-submit (or in ``spark-defaults``) holds, and Spark's own default is local.
    Driver memory is set for an explicit local master only, where tasks run inside
    the driver JVM.
    """
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings["spark.driver.memory"] = os.environ.get("FLOWML_DRIVER_MEMORY", "12g")
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_single_machine(master: str) -> bool:
    """True for ``local`` / ``local[n]``: driver and tasks share one disk.
    ``local-cluster`` runs separate executors and does not count."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where none is set, a temporary folder is registered on a single-machine master
    (tests) and refused anywhere else: executors would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not is_single_machine(master):
            raise RuntimeError(f"spark.checkpoint.dir is not set for master {master!r}: "
                               "name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="flowml-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/flowml/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """For writes inside: the shuffle files of each go when it ends."""
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage with files that survive a lost executor (a plain cache or a
    localCheckpoint does not). What the write shuffled is deleted when it ends.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    for noted in _NOTED.get():
        noted.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def drop_scratch(spark: SparkSession, *frames_or_paths) -> None:
    """Delete scratch written by ``materialise`` / ``scratch_path`` once it is not needed.
    Only paths under this session's own scratch folder are touched."""
    root = f"{checkpoint_root(spark)}/flowml/"
    jvm = spark.sparkContext._jvm
    for item in frames_or_paths:
        paths = [item] if isinstance(item, str) else {f.rsplit("/", 1)[0] for f in item.inputFiles()}
        for p in paths:
            hpath = jvm.org.apache.hadoop.fs.Path(p)
            plain = hpath.toUri().getPath()
            if jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") in plain:
                hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


@contextmanager
def scratch_dropped(spark: SparkSession) -> Iterator[list[str]]:
    """What is materialised inside is deleted at the end, but for what the caller takes off the list."""
    made: list[str] = []
    token = _NOTED.set((*_NOTED.get(), made))
    try:
        yield made
    finally:
        _NOTED.reset(token)
        drop_scratch(spark, *made)
