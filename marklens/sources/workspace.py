"""The folder for tables that a query writes and reads again."""

from __future__ import annotations

from pyspark.sql import SparkSession


def workspace(spark: SparkSession) -> str:
    """A folder that driver and executors share, one per application.

    It lies in ``spark.checkpoint.dir``. A local session, whose executors are the
    driver, may go without that setting and gets one in its warehouse folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/marklens-{spark.sparkContext.applicationId}"
