"""Tables that live in a relational database or in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    split_by: str | None = None,
    bounds: tuple | None = None,
    parts: int | None = None,
) -> dict[str, str]:
    """Options of a parallel read: ``split_by`` with ``bounds`` cuts the table into ``parts`` ranges.
    Rows outside the bounds are read too, by the first and last part."""
    options = {"url": url, "dbtable": table}
    if user:
        options |= {"user": user, "password": password or ""}
    if split_by:
        if bounds is None or parts is None:
            raise ValueError("split_by needs bounds and parts")
        options |= {
            "partitionColumn": split_by,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(parts),
        }
    return options


def read_table(spark: SparkSession, table: str, **jdbc) -> DataFrame:
    """A catalog table or view by name; over JDBC when connection settings are given."""
    if not jdbc:
        return spark.table(table)
    return spark.read.format("jdbc").options(**jdbc_options(table=table, **jdbc)).load()


def query(spark: SparkSession, text: str, **args) -> DataFrame:
    """SQL text with named parameters."""
    return spark.sql(text, args=args or None)
