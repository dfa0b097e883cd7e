"""Session settings, and the one place where intermediate results are written down."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "nearfold") -> SparkSession:
    """A session for tests and the bench. On a cluster the caller brings the session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("NEARFOLD_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.minPartitionNum", "8")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Only a local session (tests) may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="nearfold-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def freeze(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back; `options` go to the writer.

    Cuts the lineage, so a lost executor recomputes nothing upstream, and fixes values that a
    recomputation could give differently (generated ids, range bounds). Later readers prune columns.
    The table stays, because the caller's lazy result reads it.
    """
    return _written(df, new_folder(df.sparkSession, name), **options)


class Steps:
    """Frozen tables of one run that nothing reads once its result is written; removed at the end.

    After an error they stay. Use as `with Steps(spark) as steps: ...` and write the result before the block ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.path = new_folder(spark, "steps")

    def freeze(self, df: DataFrame, name: str) -> DataFrame:
        return _written(df, f"{self.path}/{name}")

    def __enter__(self) -> Steps:
        return self

    def __exit__(self, kind: type | None, *_: object) -> None:
        if kind is not None:  # what failed may still be looked into, or be the only copy
            return
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder that does not exist yet, below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/nearfold/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str, **options: str | int) -> DataFrame:
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
