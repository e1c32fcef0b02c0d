"""Session construction and intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: Folder of stored tables below the shared one, and the folders that this thread's earlier steps have left.
_FOLDER: ContextVar[str] = ContextVar("folder", default="tables")
_LEFT: ContextVar[tuple[str, ...]] = ContextVar("left", default=())
#: Whether Spark deletes a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "reviewmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here expects.

    Static settings (serializer, driver memory) can only be given here; the
    rest may be overridden at run time. ``conf`` keys use ``__`` for dots.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that every executor can read: ``spark.checkpoint.dir``.

    A session on one machine (local master) may go without the setting and gets a temporary
    folder; on a cluster that would be another folder on each machine, so it is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="reviewmill-"))
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    Cuts the lineage and fixes row placement: whatever depends on placement
    (partition ids, generated row ids) must come out of or after this, so that
    a lost executor replays the same rows. Parquet keeps column pruning, and
    its file sizes let the planner decide on broadcasts from facts. The shuffle
    files of the write go when it ends, since nothing reads them any more.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{_FOLDER.get()}/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _give_back(spark: SparkSession) -> None:
    """Hands memory that the driver's JVM has freed outside its heap back to the system, where the JVM can (glibc)."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    with suppress(Py4JError):  # a JVM without this command
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        # The server's class is not exported, so the call goes through its public interface.
        found = [m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke"]
        call = gateway.new_array(jvm.Object, 4)
        call[0], call[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        found[0].invoke(server, call)


@contextmanager
def step_tables(df: DataFrame, first: bool = False) -> Iterator[None]:
    """One of several steps in a row: its intermediate tables lie in a folder of their own, those of the steps before go.

    Each step's result must be stored before the next step begins with it as ``df``. A folder that ``df`` reads
    stays until it no longer does. The ``first`` step starts a new row and deletes nothing. Shuffle files of earlier
    jobs are deleted by Spark once their frames are collected as garbage, which is asked for here. Memory that the driver
    no longer uses goes back to the system before each step.
    """
    spark = df.sparkSession
    left = () if first else _LEFT.get()
    read = df.inputFiles() if left else []
    stay = tuple(name for name in left if any(f"/{name}/" in file for file in read))
    for name in left:
        if name not in stay:
            _delete(spark, f"{shared_folder(spark)}/{name}")
    if left:
        gc.collect()
        spark._jvm.System.gc()
    _give_back(spark)
    own = f"tables/step-{uuid.uuid4().hex}"
    _LEFT.set((*stay, own))
    token = _FOLDER.set(own)
    try:
        yield
    finally:
        _FOLDER.reset(token)


def drop_intermediate(spark: SparkSession) -> None:
    """Deletes this application's intermediate tables; frames built on them are gone afterwards."""
    _delete(spark, f"{shared_folder(spark)}/tables")
