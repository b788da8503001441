"""Session helpers: one place that knows where shared intermediate data may live."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that every job wants; none depends on the size of the data.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config(map=DEFAULTS)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, as in tests, may do without the setting: a temporary folder is made for it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="quirewright-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_written: list[str] = []


def release(spark: SparkSession | None = None) -> None:
    """Deletes the tables that :func:`settled` wrote; also done when the driver ends."""
    spark = spark or SparkSession.getActiveSession()
    while spark and _written:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again.

    Cuts the lineage so that a costly table used more than once is computed once and survives lost executors. The table
    is deleted when the driver ends, or by :func:`release`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.unregister(release)
        atexit.register(release)  # anew, so that it runs before the session's own end
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reachable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, whatever the working directory."""
    home = str(Path(__file__).resolve().parents[1])
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *paths])


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores if its scan has fewer tasks than cores; a large scan stays as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
