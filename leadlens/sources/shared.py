"""The shared folder for tables and checkpoints that must outlive an executor."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from leadlens.dictionary import DatasetError


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """``folder`` if given, else ``spark.checkpoint.dir`` of the session, else a folder beside the warehouse's tables. A warehouse on a
    local disk is shared with nobody: off a local master that is an error."""
    folder = folder or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
        if folder.startswith(("file:", "/")) and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise DatasetError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder.rstrip("/")


def app_path(spark: SparkSession, name: str) -> str:
    """A path of this application in the shared folder."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}"


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is one file; a table written by Spark is a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes what this application has written to ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Gives iterative fits a place to cut their lineage, unless the cluster has set one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


ROWS_PER_TASK = 20_000


def spread(df: DataFrame, n_rows: int) -> DataFrame:
    """Gives a small table, which many passes will read, one partition per 20,000 rows, up to the
    cores. A table with work for every core is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if n_rows >= 2 * cores * ROWS_PER_TASK:
        return df
    return df.repartition(min(cores, max(1, n_rows // ROWS_PER_TASK)))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back."""
    spark = df.sparkSession
    path = app_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
