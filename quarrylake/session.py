"""Cutting lineage in a place that every executor can reach, and sessions for tests and benches."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", **conf: str) -> SparkSession:
    """A session on this machine for tests and the bench; production code takes the caller's session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("quarrylake")
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only where it is unset and the master is this machine, one is made here."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quarrylake-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager)


def written(df: DataFrame, name: str = "part") -> DataFrame:
    """df as a Parquet table in the shared folder: columns can be pruned and statistics used when it is read again."""
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def drop_written(*tables: DataFrame | None) -> None:
    """Deletes the files of tables that `written` made and nothing reads any more."""
    for df in tables:
        path = getattr(df, "written_at", None)
        if path:
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
