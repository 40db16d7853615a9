"""Session construction and the shared folder that lineage is cut into."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "threadmill", cores: str = "8", partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark. On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


#: Folders this process made itself, by application; only these are ever removed whole.
_OWN: dict[str, str] = {}
#: The parts of shared folders that belong to an application of this process.
_PARTS: set[str] = set()
#: Tables that open ``scratch`` blocks remove when they end.
_SCRATCH: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or ``THREADMILL_CHECKPOINTS``.

    Where neither is set a local master gets a temporary folder, removed at exit;
    any other master is refused, as tables on one machine's disk would be lost to
    the rest. A folder that was named by the user is never removed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or os.environ.get("THREADMILL_CHECKPOINTS")
    if folder:
        return folder
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="threadmill-")
        atexit.register(shutil.rmtree, _OWN[app], True)
    return _OWN[app]


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of the JVM for a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def scratch_path(spark: SparkSession, kind: str = "tables") -> str:
    """A new name in the application's part of the shared folder.

    What is put there goes when the surrounding ``scratch`` block ends, and all
    of the part goes when the application ends.
    """
    base = f"{shared_dir(spark)}/threadmill-{spark.sparkContext.applicationId}"
    if base not in _PARTS:
        fs, part = hadoop_path(spark, base)
        fs.mkdirs(part)
        fs.deleteOnExit(part)  # only takes what exists
        _PARTS.add(base)
    path = f"{base}/{kind}/{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that ``stored`` wrote inside the block when it ends. Results must be written by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            fs, p = hadoop_path(spark, path)
            fs.delete(p, True)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared folder and continue from there.

    Reliable checkpointing, so the loss of an executor costs no recomputation
    of what lies before the cut.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut`` for large tables: a compressed columnar table in the shared folder.

    It takes a fraction of a checkpoint's disk, later reads only the columns they
    need, and joins know its size. See ``scratch`` for how long it stays.
    """
    path = scratch_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many tasks as there are cores, where files alone would give fewer, for stages that compute much per row.

    Rows go round robin before the heavy expressions, so a few large row groups
    don't keep the cores idle. With enough input partitions nothing is moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
