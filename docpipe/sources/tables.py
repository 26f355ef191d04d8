"""Catalog tables as DataFrames."""

from pyspark.sql import DataFrame, SparkSession


class MissingTable(Exception):
    """A table that a job cannot do without does not exist."""


def read_table(spark: SparkSession, name: str, *columns: str) -> DataFrame:
    """The table, cut to the named columns. A missing table is an error."""
    if not spark.catalog.tableExists(name):
        raise MissingTable(name)
    table = spark.table(name)
    return table.select(*columns) if columns else table


def optional_table(spark: SparkSession, name: str, *columns: str) -> DataFrame | None:
    """The table, or None when there is no such table."""
    return read_table(spark, name, *columns) if spark.catalog.tableExists(name) else None


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a scan of too few splits; a scan of many splits stays as it is."""
    context = getattr(df.sparkSession, "sparkContext", None)
    if context is None:  # a remote session does not tell
        return df
    cores = context.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
