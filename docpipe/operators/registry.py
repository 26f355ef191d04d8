"""The table of known documents, and which files it does not know yet."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.functions.text import norm_path
from docpipe.operators import tables


def unused(df: DataFrame, name: str) -> str:
    """`name`, or with underscores after it, so that `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(left: DataFrame, key: Column, known: DataFrame) -> DataFrame:
    """Rows of `left` whose key is not in the one column of `known`; a NULL key never matches.

    A row without a key gets a number of its own to join by, so that many of them are
    spread over the tasks. Repeated keys on the right shrink to one before the shuffle.
    """
    own = F.concat(F.lit("\0"), F.monotonically_increasing_id())
    name = unused(left, "known")
    known = known.toDF(name).distinct()
    return left.withColumn(name, F.coalesce(key, own)).join(known, name, "left_anti").drop(name)


def register(new_files: DataFrame, table: str) -> None:
    """Append one row per file: path without `dbfs:`, file id, load time, and metadata if given."""
    rows = new_files.withColumns(
        {"doc_path": norm_path(F.col("doc_path")), "updated": F.current_timestamp()}
    )
    tables.append(rows, table)


def pending(source: DataFrame, parsed: DataFrame) -> DataFrame:
    """Registered documents that are not parsed yet. Paths are compared without `dbfs:`."""
    return without(source, norm_path(F.col("doc_path")), parsed.select(norm_path(F.col("path"))))


def new_files(listing: DataFrame, source: DataFrame) -> DataFrame:
    """Listed files whose id is not registered."""
    return without(listing, F.col("source_file_id"), source.select("source_file_id"))


def exists_many(ids: DataFrame, source: DataFrame) -> DataFrame:
    """The ids with a column `exists`: is the id registered?"""
    # One row per id before the join, so that a repeated id does not multiply rows.
    known = source.groupBy("source_file_id").agg(F.count(F.lit(1)).alias("n"))
    return ids.join(known, "source_file_id", "left").withColumn(
        "exists", F.coalesce(F.col("n"), F.lit(0)) > 0
    ).drop("n")


def one_per_path(source: DataFrame, normal: bool = False) -> DataFrame:
    """The latest registration of each path without `dbfs:`, as (doc_path, title, authors).

    With `normal` all paths are known to be without it, so buckets by path are used as they lie.
    """
    latest = F.max(F.struct("updated", "source_file_id", "title", "authors")).alias("r")
    path = F.col("doc_path") if normal else norm_path(F.col("doc_path"))
    path = path.alias("doc_path")
    return source.groupBy(path).agg(latest).select("doc_path", "r.title", "r.authors")
