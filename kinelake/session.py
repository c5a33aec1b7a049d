"""Session-level helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.  Where that is unset, a local session (as in
    tests) takes a folder under its warehouse directory; on a cluster it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_kinelake"
    return folder.rstrip("/")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder written by :func:`materialise`."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def materialise(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Writes ``df`` to the shared folder and reads it again: cuts the lineage, and a lost executor costs nothing.  The
    folder goes when the application ends, if :func:`drop_folder` did not remove it before: results read from it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path), path
