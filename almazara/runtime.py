"""Session helpers shared by every operator: tables, scratch space, checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folder of the scratch tables below the shared checkpoint folder.
SCRATCH = "almazara-scratch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the checkpoint folder set on the context.

    Only in local mode, where one machine does all the work, a temporary folder of
    this machine is made where neither is set; on a cluster that is an error.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("almazara.scratch.dir", None)
    if not found:
        told = context._jsc.sc().getCheckpointDir()
        found = told.get() if told.isDefined() else None
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="almazara-")
    spark.conf.set("almazara.scratch.dir", found)
    return found.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """This application's own folder below the shared one; it goes when the application ends."""
    path = f"{shared_dir(spark)}/{SCRATCH}/{spark.sparkContext.applicationId}"
    if spark.conf.get("almazara.scratch.marked", None) != path:
        at, system = _hadoop(spark, path)
        system.mkdirs(at)
        system.deleteOnExit(at)
        spark.conf.set("almazara.scratch.marked", path)
    return path


def _hadoop(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a replicated, columnar copy: a lost executor costs
    a re-read, and later scans still prune columns and push filters down.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application, and of no other."""
    at, system = _hadoop(spark, scratch_dir(spark))
    system.delete(at, True)
    spark.conf.unset("almazara.scratch.marked")
