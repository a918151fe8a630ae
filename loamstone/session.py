"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "loamstone", cpus: int | None = None, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine.

    On a cluster the caller brings its own session; nothing in this package depends on the settings made here.
    """
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers of the session's executors, once per application.

    Functions that run in workers import it there; Spark distributes the archive, so neither the working folder nor
    PYTHONPATH of the executors matters.
    """
    context = spark.sparkContext
    if getattr(context, "_loamstone_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="loamstone-"), "loamstone.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("loamstone", os.path.relpath(path, package)))
    context.addPyFile(archive)
    context._loamstone_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Where the setting is absent and the master is local, a temporary folder of this machine is used; on a cluster its
    absence is an error, since executors could not read each other's files.
    """
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="loamstone-")
    spark.sparkContext.setCheckpointDir(path)
    return path


#: Folders written by stored() in this process.
_FOLDERS: list[str] = []


def stored(df: DataFrame, name: str = "t", partition_by: list[str] | None = None) -> DataFrame:
    """df written as a compressed columnar table in the shared folder and read again.

    Preferred over checkpointed() for wide or large data: it is columnar, so later reads take only the columns they
    need. The files go when the process ends, or with clean_up().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _FOLDERS.append(path)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def owned(folder: str) -> str:
    """The folder, which goes when the process ends or with clean_up(), like those of stored()."""
    _FOLDERS.append(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder; its lineage ends there, so a lost executor loses nothing.

    A written table does what checkpoint() does, but computes the last stage once (checkpoint() runs it a second time
    to write it) and is columnar and compressed.
    """
    return stored(df, "cut")


def clean_up(spark: SparkSession | None = None) -> None:
    """Removes the tables that stored() wrote in this process; frames that read them cannot be used any more."""
    spark = spark or SparkSession.getActiveSession()
    while _FOLDERS and spark is not None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@atexit.register
def _at_exit() -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        clean_up()


def spread(df: DataFrame) -> DataFrame:
    """df over as many partitions as there are cores, if its scan gives fewer.

    For work in Python that takes long per row: a small file is one partition, whatever the number of cores. A scan with
    at least as many partitions as cores is left alone, so large data are never shuffled for this, and frames that
    already hold an exchange are left to adaptive execution.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    execution = df._jdf.queryExecution()
    if "Exchange" in execution.executedPlan().toString() or execution.toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
