"""Session settings, checkpointing and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and local timing; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("panelwright")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a temporary folder of its own.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="panelwright-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def run_folder(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{shared_root(spark).rstrip('/')}/panelwright-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's folder."""
    return f"{run_folder(spark)}/{uuid.uuid4().hex}/{label}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into a table in the shared folder and read it back.

    Used where a result feeds several later plans: it is neither recomputed nor
    lost with an executor, a sketched value stays one value, and the optimizer
    knows its size, so it broadcasts the table exactly when that is small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Remove tables that ``materialise`` has stored and that nothing reads any more.

    Whatever was made of them must be stored itself by then.
    """
    for df in stored:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            assert run_folder(spark).rpartition("/")[2] in folder.split("/"), folder
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Remove what this application has stored below the shared folder; tables read from there are gone then."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
