"""Session defaults and the one shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
import weakref
from collections.abc import Iterator

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; on a cluster use the session the cluster hands out."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quarryline")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


_BATCH_BYTES = 4 << 20  # of texts in one Arrow batch
_SHARED_BY_ALL = "local"  # masters whose executors run on the driver's machine begin like this
_staged: list[tuple[SparkSession, str]] = []
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()  # of staged tables
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_reached: set[tuple[str, str]] = set()  # application and root, once all executors were seen to share it


def bound_batches(spark: SparkSession) -> None:
    """Spark's Arrow batch of 10,000 rows holds up to 64 MB of text, several times over in every Python worker. Gives the
    session's batches a smaller bound, unless one is set already; results do not depend on it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(_BATCH_BYTES))


def file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def check_shared(scheme: str, master: str, folder: str) -> None:
    """On a cluster a folder of the local file system is another one on every machine, and results would be incomplete."""
    if scheme == "file" and not master.startswith(_SHARED_BY_ALL):
        raise ValueError(f"{folder} is on the local file system; executors of {master} do not share it")


def comes_back_whole(spark: SparkSession, root: str) -> bool:
    """Whether a small table that every core writes below ``root`` is read back by all of them with all its rows."""
    tasks = max(64, 4 * spark.sparkContext.defaultParallelism)
    probe = f"{root.rstrip('/')}/quarryline-{uuid.uuid4().hex}"
    _staged.append((spark, probe))  # goes with the others, also after a failure
    rows = spark.range(0, tasks, 1, tasks)
    rows.write.parquet(probe)
    return spark.read.schema(rows.schema).parquet(probe).count() == tasks


def _check_reached(spark: SparkSession, root: str) -> None:
    """A path without a scheme of its own may be a mount that all machines share, or a disk of each: one write and one read
    per session and root tell. Executors that join later are taken to be like those that were there."""
    master, scheme = spark.sparkContext.master, file_system(spark, root)[1].getUri().getScheme()
    seen = (spark.sparkContext.applicationId, root)
    if scheme != "file" or master.startswith(_SHARED_BY_ALL) or seen in _reached:
        return
    try:
        whole = comes_back_whole(spark, root)
    except PySparkException as error:  # a task does not find the files of another, or may not write there
        raise ValueError(f"executors of {master} cannot write or read all of {root}; set spark.checkpoint.dir to a folder they share") from error
    if not whole:
        check_shared(scheme, master, root)
    _reached.add(seen)


def _root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, else the session's checkpoint folder, else the warehouse; a temporary folder where all work
    is done by the driver's own process."""
    context = spark.sparkContext
    if root := spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir():
        return root
    if re.fullmatch(r"local(\[.*\])?", context.master):
        return tempfile.mkdtemp(prefix="quarryline-")
    return spark.conf.get("spark.sql.warehouse.dir")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that the driver and all executors reach, below ``spark.checkpoint.dir`` or what stands in for it."""
    root = _root(spark)
    _check_reached(spark, root)
    folder = f"{root.rstrip('/')}/quarryline-{uuid.uuid4().hex}"
    _staged.append((spark, folder))
    return folder


def drop_staged(since: int = 0) -> None:
    """Delete the folders handed out after the first ``since``; runs by itself when the process ends."""
    while len(_staged) > since:
        spark, folder = _staged.pop()
        with contextlib.suppress(Exception):  # the session may be gone, and what it left is not worth a failure
            path, system = file_system(spark, folder)
            system.delete(path, True)


atexit.register(drop_staged)


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Folders that are staged inside the block are deleted at its end; read results before."""
    since = len(_staged)
    try:
        yield
    finally:
        drop_staged(since)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the job that wrote them ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so that several readers see the very same rows.

    A Parquet table rather than an RDD checkpoint: readers prune columns, push filters down, and the planner knows
    its size. It outlives lost executors and cuts the lineage just as well.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(folder)
    staged = spark.read.schema(df.schema).parquet(folder)
    _folders[staged] = folder
    return staged


def unstage(*tables: DataFrame) -> None:
    """Delete tables that ``stage`` returned and that nothing reads any more, before the process ends."""
    for table in tables:
        folder = _folders.pop(table)
        path, system = file_system(table.sparkSession, folder)
        system.delete(path, True)
        _staged.remove((table.sparkSession, folder))
