"""Session helpers: suggested settings and durable intermediate tables."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []
_own_folder: list[str] = []
_shipped: set[str] = set()
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
RELEASE_S = 1.5        # in which the driver's JVM hears of what Python has let go, about
PART_BYTES = 16 << 20  # of files or a shuffle that a task reads within ``small_parts``, about

SUGGESTED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g", app_name: str = "harrow") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in SUGGESTED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def small_parts(spark: SparkSession, parts: int) -> Iterator[None]:
    """For jobs run within, at least ``parts`` shuffle partitions and tasks of PART_BYTES.

    A task that shuffles into many partitions holds all that it writes, so its memory
    follows what it reads: with a fixed number of partitions it would grow with the input.
    """
    number = "spark.sql.shuffle.partitions"
    sizes = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = {name: spark.conf.get(name) for name in (number, *sizes)}
    spark.conf.set(number, str(max(parts, int(before[number]))))
    for name in sizes:
        spark.conf.set(name, str(PART_BYTES))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    go without; it then gets one folder of its own, deleted when Python ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="harrow-"))
        atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
    return _own_folder[0]


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, unless they have been given it before.

    Needed where the package is not installed on the executors and the driver has it on
    its own path only.
    """
    app = spark.conf.get("spark.app.id", "")
    if app not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="harrow-package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = os.path.join(folder, "harrow_package.zip")
        with zipfile.ZipFile(archive, "w") as package:
            for top, _, names in os.walk(here):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(top, name)
                        package.write(path, os.path.relpath(path, os.path.dirname(here)))
        spark.addArtifacts(archive, pyfile=True)
        _shipped.add(app)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table, below the one work folder of this application."""
    top = os.path.join(work_dir(spark), f"harrow-{spark.conf.get('spark.app.id', 'local')}")
    path = os.path.join(top, f"{name}-{uuid.uuid4().hex}")
    _written.append(path)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    return path


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run within delete their shuffle files as they end.

    Else these stay until the driver happens to collect its garbage, so disk would hold
    those of every step at once.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def collect_garbage(spark: SparkSession) -> None:
    """Have the driver find what nothing refers to any more.

    Spark then deletes the shuffle files and stored blocks of such RDDs.
    """
    gc.collect()
    time.sleep(RELEASE_S)
    spark.sparkContext._jvm.System.gc()


def checkpoint_folder(spark: SparkSession) -> None:
    """Give RDD checkpoints a folder, unless they have one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(spark))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the work folder and read it back.

    Used where a table feeds several later stages: it is computed once, survives
    the loss of executors, and later reads fetch only the columns they need.  What was
    shuffled on the way is deleted.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    with passing_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(tables: Sequence[DataFrame]) -> DataFrame:
    """The rows of some tables of ``materialize``, all of one schema, read as one table."""
    folders = {os.path.dirname(file) for table in tables for file in table.inputFiles()}
    read = tables[0].sparkSession.read.schema(tables[0].schema)
    return read.parquet(*sorted(folders)) if folders else tables[0]


def discard(*tables: DataFrame) -> None:
    """Delete the tables of ``materialize`` that these read, as nothing needs them any more.

    Tables in a store that is no local file system stay for ``clear_materialized`` to name.
    """
    read = {_local(os.path.dirname(file)) for table in tables for file in table.inputFiles()}
    for path in [x for x in _written if _local(x) in read]:
        if _deleted(path):
            _written.remove(path)


def clear_materialized() -> list[str]:
    """Delete the tables ``materialize`` wrote for this program; give those it cannot.

    Call it when no DataFrame that reads them is needed any more.  Paths of a local file
    system are deleted; tables in any other store are returned for its own tools.
    """
    kept = []
    while _written:
        path = _written.pop()
        if not _deleted(path):
            kept.append(path)
    return kept


def materialize_last(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """``materialize`` what ``build`` returns, and delete the tables that it wrote for that.

    ``build`` gives nothing else away that reads them.  Tables in a store that is no local
    file system stay for ``clear_materialized`` to name.
    """
    outer, own = _passing.get(), []
    token = _passing.set(own)
    try:
        last = materialize(build(), name)
    finally:
        _passing.reset(token)
    *passed, path = own
    if outer is not None:
        outer.append(path)
    for x in passed:
        if _deleted(x):
            if x in _written:  # not discarded before
                _written.remove(x)
        elif outer is not None:
            outer.append(x)
    return last


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def _deleted(path: str) -> bool:
    local = _local(path)
    if "://" in local:
        return False
    shutil.rmtree(local, ignore_errors=True)
    return True
