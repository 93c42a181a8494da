"""Reading the tables of a folder and cutting lineage with written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainlytics.session import workspace, written


#: Rows and bytes that Spark hands a Python task at a time. The defaults (10,000 rows, 64 MB) are held several times over, by
#: the JVM and by Python, which whole texts make too much for small executors.
BATCH_ROWS, BATCH_BYTES = "1000", "8m"


def small_batches(spark: SparkSession) -> SparkSession:
    """Set the session's Arrow batches to the sizes above; queries and pipeline stages begin with it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: lost executors cost no earlier stage."""
    return written(df, workspace(df.sparkSession, label))


def measured(df: DataFrame, label: str, **sums) -> tuple[DataFrame, dict]:
    """``kept`` and some sums over it (name=column expression), computed from the written files."""
    out = kept(df, label)
    row = out.agg(*[expression.alias(name) for name, expression in sums.items()]).first()
    return out, row.asDict()
