"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tallywise", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, UTC and no UI; `conf` overrides any setting."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    Where it is unset, a folder in the warehouse, which all executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tallywise/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, **options):
    """Write `df` to the shared folder and read it back, so that lost executors cost no recomputation.

    A written table also carries its real size: a checkpoint keeps the estimate of the plan it
    came from, and iterated joins would multiply these estimates without end.
    """
    path = work_path(df.sparkSession, "cut")
    df.write.options(**options).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.work_table = path
    return stored


def _located(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    system, path = _located(spark, folder)
    return system.exists(path)


def delete(spark: SparkSession, folder: str) -> None:
    system, path = _located(spark, folder)
    system.delete(path, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder, in one step where the file system can; its parent is made if there is none."""
    system, source = _located(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"{old} could not be renamed to {new}")


def release(*stored) -> None:
    """Delete the tables behind frames that `cut_lineage` returned, once nothing reads them any more."""
    for df in stored:
        delete(df.sparkSession, df.work_table)
