"""Sessions for local runs, and checkpoints that every executor can read."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session on this machine, for tests and bench. On a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").config(map=DEFAULTS | {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": "8g"} | conf)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, shared by all executors.

    Only where that setting is missing and the master is local (tests, bench) is a temporary
    folder taken; on a cluster a missing folder is an error, because a folder of one machine
    is lost with it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="selvedge-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept in checkpoint_folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df, computed once and kept as a compressed table in checkpoint_folder, of which later steps read only the columns they need."""
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once per context.

    Spark's file server hands the archive out, so nothing need be installed on the executors.
    """
    context = spark.sparkContext
    if getattr(context, "_selvedge_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="selvedge-"), "selvedge_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(package)))
    context.addPyFile(archive)
    context._selvedge_shipped = True
