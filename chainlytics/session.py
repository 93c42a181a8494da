"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from chainlytics import storage

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_own_roots: dict[str, str] = {}

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Per-group row limits are applied map-side up to this limit (Spark's default is 1000); a block of
    # the lightest possible transactions has fewer rows. Beyond it such a limit is applied after the
    # shuffle, with the same result.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000000",
    # INT96, Spark's default, has no smallest and largest value in the file footers to skip by.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Lets tables.read_footers answer from footers; without effect on the ordinary Parquet source.
    "spark.sql.parquet.aggregatePushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator relies on: UTC time and adaptive execution."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where the setting is missing a folder is made on this machine, one per application, if that is
    where everything runs (a ``local`` master); on a cluster it is an error, as executors would write
    to their own disks.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors can reach")
        application = spark.sparkContext.applicationId
        if application not in _own_roots:
            _own_roots[application] = tempfile.mkdtemp(prefix="chainlytics-")
        root = _own_roots[application]
    return root.rstrip("/")


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder name for intermediate tables; Spark creates it on first write. They belong to
    the application and stay until :func:`drop_workspaces` or the cluster's clean-up of the folder."""
    return f"{workspaces(spark)}/{label}-{uuid.uuid4().hex}"


def workspaces(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{shared_root(spark)}/chainlytics-{spark.sparkContext.applicationId}"


def drop_workspaces(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application. Call it when no result built on them is
    still to be read."""
    storage.drop(spark, workspaces(spark))


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a Parquet table under the shared root: computed once, safe from lost executors, and
    of known size when Spark plans the joins it goes into."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session, the unit in which hot groups are split."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
