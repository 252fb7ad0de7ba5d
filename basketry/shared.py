"""Staged tables in the folder all executors share.

A staged table cuts lineage: after an executor is lost, its readers go back to
the files instead of recomputing the job that wrote them.
"""

import gc
import sys
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.  Unset means a local run: make one."""
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    local = tempfile.mkdtemp(prefix="basketry-")
    spark.conf.set(_CHECKPOINT_DIR, local)
    return local


def run_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/basketry/{name}-{uuid.uuid4().hex}"


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Remove the tables staged inside at the end: for work that is repeated for ever."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the package on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Of each session, what the setting was before those who are inside ``no_shuffle_left``, in whatever thread.
_cleaning: dict[str, list] = {}


@contextmanager
def no_shuffle_left(spark: SparkSession):
    """Shuffle files of what is written inside go at its end, not when some garbage collection comes."""
    held = _cleaning.setdefault(spark._jsparkSession.sessionUUID(), [])
    held.append(held[0] if held else spark.conf.get(_CLEANUP, None))
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        before = held.pop()
        if not held and before is None:
            spark.conf.unset(_CLEANUP)
        elif not held:
            spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back."""
    path = run_dir(df.sparkSession, name)
    if _scratch:
        _scratch[-1].append(path)
    with no_shuffle_left(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(module_name: str) -> None:
    """Send a module's functions inside the task, so executors need no installed copy.

    This module goes along, as modules that call ``ship`` hold it.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def send(spark: SparkSession, value):
    """Broadcast an object whose class executors need no copy of; ``received`` gives it back."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent):
    """The object of a ``send``, in a task; a Python worker makes it once for all its tasks."""
    held = vars(sent)
    if "received" not in held:
        held["received"] = cloudpickle.loads(sent.value)
    return held["received"]


def forget(spark: SparkSession) -> None:
    """Let Spark find at once which cached blocks and shuffle files nobody refers to any more, and remove them."""
    gc.collect()
    spark._jvm.System.gc()


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative algorithms cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/basketry/checkpoints")


def task_count(spark: SparkSession, groups: int | None = None) -> int:
    """Partitions for groups that are small in bytes but heavy to compute.

    Given as a number to ``repartition``: adaptive execution would merge such partitions
    by their size and leave most cores idle.
    """
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(shuffle, 4 * spark.sparkContext.defaultParallelism)
    return wanted if groups is None else max(1, min(groups, wanted))
