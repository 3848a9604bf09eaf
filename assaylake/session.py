"""Session settings shared by every job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Settings the jobs rely on. All can be overridden by the caller or by spark-submit.
LAKE_CONF = {
    # Epoch seconds are read as UTC whatever the zone of the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.adaptive.enabled": "true",
    # Merge small shuffle partitions up to this size, as Silver files are made from them.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Silver has three partition folders. With one open writer per folder, a task writes its rows
    # as they come instead of sorting them by folder first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def object_store_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    *,
    path_style: bool = True,
    tls: bool = False,
    provider: str = "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
) -> dict[str, str]:
    """Connector settings for an S3-compatible store. Keys always come from the caller."""
    # The connector's own names.
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
        "spark.hadoop.fs.s3a.aws.credentials.provider": provider,
    }


def lake_session(
    app_name: str, *, master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """Get or create a session. ``master`` stays unset on a cluster, where spark-submit names it."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**LAKE_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Jobs read and print times in UTC, also in a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
