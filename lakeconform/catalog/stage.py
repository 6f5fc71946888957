"""Rows that a query uses more than once, written once to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Spark's own setting that deletes the shuffle files of a statement when it has ended.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_path(spark: SparkSession) -> str | None:
    """A new path in ``spark.checkpoint.dir``, removed when the session's JVM ends.

    Only a session on one machine may do without that folder; elsewhere there is no path.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            return None
        root = tempfile.gettempdir()
    home = f"{root.rstrip('/')}/lakeconform-stage/{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(home)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    # A path that is not there yet cannot be marked for removal.
    store.mkdirs(folder)
    store.deleteOnExit(folder)
    return f"{home}/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """The frame written and read back, so that its texts are parsed once, however often it is used.

    Filters on the result meet the written columns; on the frame itself Catalyst would push them
    below the parsing and so parse again. Without a shared folder the frame is used as it is.
    """
    spark = df.sparkSession
    path = stage_path(spark)
    if path is None:
        return df
    before = spark.conf.get(FILE_CLEANUP)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FILE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
