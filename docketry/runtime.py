"""Session-wide helpers: shared working folder, lineage cuts, table access."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table, a Parquet file or folder ``<folder>/<name>.parquet``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    It is the one that the cluster names in ``spark.checkpoint.dir``, or the context's
    checkpoint folder.  Only where neither is set, as in local tests, one is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = set_dir.get() if set_dir.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="docketry-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def step_path(spark: SparkSession, label: str) -> str:
    """A new path for a step of this application in the shared folder."""
    return f"{shared_dir(spark)}/docketry/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as this machine's file system has it, or None where it lies in another one."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(there).toUri().getPath() if fs.getUri().getScheme() == "file" else None


#: Spark deletes the shuffle files of a plan as soon as it has run.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def trim(spark: SparkSession) -> None:
    """Hand native memory that the driver's JVM has freed back to the system.

    The C library keeps what is freed in arenas of its threads, the more the more code is generated and
    compiled, so a driver with many steps grows as long as it runs.  Not every JVM can do this; where
    it can't, nothing is done.
    """
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    kind = jvm.java.lang.Class.forName
    try:
        # the server's own class is closed to reflection, its interface is open
        names = ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")
        kinds, args = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
        for i, n in enumerate(names):
            kinds[i] = kind(n)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        kind("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:
        pass


def cut(df: DataFrame, label: str = "step") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    Cuts the lineage, so that a lost executor costs no recomputation before this point and an
    iterative plan does not grow.  The file is compressed and columnar, unlike an RDD checkpoint.
    Nothing reads the shuffle files of the write again, so they go with it, as does native memory
    that the driver has freed.
    """
    spark = df.sparkSession
    path = step_path(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    trim(spark)
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete the files behind a frame that :func:`cut` returned, once nothing reads it again."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    folders = {os.path.dirname(f) for f in df.inputFiles()}
    mine = f"/docketry/{spark.sparkContext.applicationId}/"
    for folder in folders:
        if mine in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_cuts(spark: SparkSession) -> None:
    """Delete every step that this application has written; to be called once no result is read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/docketry/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that nothing refers to any more.

    Executors keep them until the driver's collector finds the plan gone, which on a driver with
    little to do can be after the query.  For what is not written by :func:`cut`, as counts and rows
    that come to the driver.
    """
    gc.collect()
    # a thread of py4j's tells the JVM what Python has let go of, but looks only once a second; before that the plan is still held
    waiting = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    for _ in range(30):
        if not waiting:
            break
        time.sleep(0.1)
    spark.sparkContext._jvm.System.gc()
    trim(spark)


def blank_to_null(c: Column) -> Column:
    """The trimmed text, or null where nothing but white space is left."""
    t = F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return F.when(F.length(t) > 0, t)


def effective_case_id(case_id: str = "case_id", doc_id: str = "doc_id") -> Column:
    """case_id, or where it is null or blank doc_id's prefix before the first ``_``; trimmed, lower case."""
    prefix = blank_to_null(F.split_part(F.col(doc_id), F.lit("_"), F.lit(1)))
    return F.lower(F.coalesce(blank_to_null(F.col(case_id)), prefix))
