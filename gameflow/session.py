"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "gameflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # Chunks are sent side by side, each in a pool of its own.
        .config("spark.scheduler.mode", "FAIR")
        # Chunk folders are written side by side, which saves sorting each task by chunk.
        .config("spark.sql.maxConcurrentOutputFileWriters", "64")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder, because all of its tasks share one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app_id = spark.conf.get("spark.app.id")
    if app_id not in _local_roots:
        _local_roots[app_id] = tempfile.mkdtemp(prefix="gameflow-")
    return _local_roots[app_id]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that nothing has used before."""
    return f"{scratch_root(spark)}/gameflow/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, in order."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(jvm_path)
    return sorted(status.getPath().toString() for status in found or [])


def move_path(spark: SparkSession, source: str, target: str) -> None:
    paths = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    if not paths[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(*paths):
        raise OSError(f"{source} could not be moved to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jvm_path)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(jvm_path, True).close()


@contextmanager
def scratch_folders(spark: SparkSession, *names: str) -> Iterator[list[str]]:
    """Scratch paths for the steps of one job, deleted when it is done."""
    paths = [scratch_path(spark, name) for name in names]
    try:
        yield paths
    finally:
        for path in paths:
            delete_path(spark, path)


def side_by_side(spark: SparkSession, calls: Sequence[Callable[[], Result]], workers: int) -> list[Result]:
    """Results of the calls, in their order, at most ``workers`` of them running Spark jobs at a time.

    Each call has a fair-scheduler pool of its own, so a large one does not hold the others up.
    All calls are let end; then the first error, if there is one, is raised.
    """
    pool = f"side-{uuid.uuid4().hex[:8]}"

    def in_pool(number: int) -> Result:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{pool}-{number}")
        return calls[number]()

    with ThreadPoolExecutor(max(1, workers)) as threads:
        futures = [threads.submit(inheritable_thread_target(spark)(in_pool), k) for k in range(len(calls))]
    return [future.result() for future in futures]
