"""Scratch folders that all executors can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data; where none is named, one below the warehouse,
    which all executors share as well."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder. Spark removes it when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(jvm_path)
    files.deleteOnExit(jvm_path)
    return path
