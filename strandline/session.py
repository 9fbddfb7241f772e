"""Session factory and the shared folder that long plans write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "strandline", cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session with the settings the operators expect of any session (UTC, adaptive execution)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; one of our own only where none is set and all is on one machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        base = configured
    elif (existing := spark.sparkContext.getCheckpointDir()) is not None:
        base = existing
    elif not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    else:
        base = "file://" + tempfile.mkdtemp(prefix="strandline-")
        spark.conf.set("spark.checkpoint.dir", base) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete what was written to a scratch path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def settled(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: computed once however often it is used, in columns, with its size known to the planner."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def subfolders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers n of the folders name=n below path, ascending; none if there is no such path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or []
    return sorted(int(s.getPath().getName().split("=")[1]) for s in found)
