"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; a temporary one only where that is unset and the master is local."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, by: str | None = None, key: str | None = None, lies: bool = False) -> DataFrame:
    """The rows of df as a table in a shared folder: written once, read by all that follows, safe against lost executors.

    by: a column of few values, on which filters read only what they need. key: rows of a key lie in one bucket, so whoever
    groups, windows or joins by it need not exchange them again. lies: rows of a key lie in one task already, though Spark cannot
    know it (Python made them of such rows), so each task writes the buckets that it has and nothing is exchanged; were that not
    so, there would be more files and the same rows.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession)
    if key is None:
        df.write.option("compression", "zstd").parquet(path, partitionBy=by)
        return spark.read.schema(df.schema).parquet(path)
    name, n = f"stored_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [by, key] if by else [key]
    (df if lies else df.repartition(n, key)).write.option("compression", "zstd").bucketBy(n, key).sortBy(*order).option("path", path).format("parquet").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name goes, the files stay, and out knows them
    return out
