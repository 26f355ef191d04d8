"""Create, append to, replace and empty tables."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    fmt: str = "parquet",
    key: str | None = None,
    buckets: int | None = None,
) -> None:
    """Create the table, and its database, unless they exist. With a key it is bucketed by it."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    layout = ""
    if key:
        layout = f"CLUSTERED BY (`{key}`) INTO {buckets or default_buckets(spark)} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} {layout}")


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_key(spark: SparkSession, name: str) -> str | None:
    """The column that the table is bucketed by."""
    found = [c.name for c in spark.catalog.listColumns(name) if c.isBucket]
    return found[0] if len(found) == 1 else None


def buckets_of(spark: SparkSession, name: str) -> int:
    described = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    return int(described.data_type)


def append(df: DataFrame, name: str, placed: bool = False) -> None:
    """Append by column name; columns the query lacks are NULL.

    Rows for a bucketed table are brought together by bucket first, so that a task writes the files
    of its own buckets only; `placed` says that they are together already.
    """
    spark = df.sparkSession
    rows = df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spark.table(name).schema.fields
        ]
    )
    key = bucket_key(spark, name)
    if key and not placed:
        rows = rows.repartition(buckets_of(spark, name), key)
    rows.write.insertInto(name)


def reset(spark: SparkSession, *names: str) -> list[str]:
    """Empty the tables that exist and return their names."""
    present = [n for n in names if spark.catalog.tableExists(n)]
    for name in present:
        spark.sql(f"TRUNCATE TABLE {name}")
    return present


# Plans on stored buckets: a join on the bucket's key and another column needs no shuffle, and a
# bucketed table is read by bucket even where only a write behind it profits.
BY_BUCKET = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


def own_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster and tables with the caller's settings, and those of BY_BUCKET.

    The caller's own settings stay as they are while others may plan with them.
    """
    own = spark.newSession()
    for row in spark.sql("SET").collect():
        if own.conf.isModifiable(row.key):
            own.conf.set(row.key, row.value)
    for setting, value in BY_BUCKET.items():
        own.conf.set(setting, value)
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return own


# A snapshot's table has the name that readers use, this, and a random end.
INFIX = "__snapshot_"


def facts(spark: SparkSession, name: str) -> dict[str, str]:
    """What `publish` noted with the current snapshot; nothing if there is none."""
    if not spark.catalog.tableExists(name):
        return {}
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def publish(
    df: DataFrame,
    name: str,
    key: str,
    buckets: int,
    check: Callable[[DataFrame], None] | None = None,
    digest: tuple[str, ...] = (),
    **notes: str | int,
) -> None:
    """Write the rows as a table of sorted buckets; then make `name` show it, in one statement.

    `name` is a view, so there is no moment at which readers find nothing: a run that dies or
    whose rows do not pass the check leaves the snapshot before. That one stays for queries that
    still read it; older ones, and what dead runs left, are dropped. With `digest` the snapshot
    has a small table of one digest of these columns for each bucket (see `digests`).
    """
    spark = df.sparkSession
    new = new_snapshot(name)
    rows = df.repartition(buckets, key)
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(new)
    written = spark.table(new)
    if check:
        check(written)
    if digest:
        _digests(written, key, buckets, digest).coalesce(1).write.saveAsTable(f"{new}_digests")
    show(spark, name, new, bucket_key=key, buckets=buckets, **notes)


def new_snapshot(name: str) -> str:
    return f"{name}{INFIX}{uuid.uuid4().hex[:12]}"


def show(spark: SparkSession, name: str, new: str, **notes: str | int) -> None:
    """Make the view `name` show the table `new`, with the notes, and drop what is older than the
    snapshot before. Tables whose names begin with a snapshot's go with it."""
    before = facts(spark, name).get("snapshot")
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in {"snapshot": new, **notes}.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({properties}) AS SELECT * FROM {new}")
    database, _, short = name.rpartition(".")
    stay = tuple(t.rpartition(".")[2].lower() for t in (new, before) if t)
    for table in spark.catalog.listTables(database or None, f"{short}{INFIX}*"):
        if not table.name.lower().startswith(stay):
            spark.sql(f"DROP TABLE IF EXISTS {database + '.' if database else ''}{table.name}")


def _digests(rows: DataFrame, key: str, buckets: int, columns: tuple[str, ...]) -> DataFrame:
    """(bucket, n, digest): how many rows a bucket has, and the sum of their hashes."""
    bucket = F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")
    summed = F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).alias("digest")
    return rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), summed)


def digests(spark: SparkSession, name: str) -> DataFrame:
    """The digests that were written with the snapshot."""
    return spark.table(f"{facts(spark, name)['snapshot']}_digests")


def differing_buckets(spark: SparkSession, one: str, other: str) -> list[int]:
    """The buckets whose digests differ; no row of either table is read. At most one per bucket."""
    a, b = (digests(spark, name) for name in (one, other))
    unlike = a.exceptAll(b).unionByName(b.exceptAll(a)).select("bucket").distinct()
    return sorted(r.bucket for r in unlike.collect())


def of_buckets(spark: SparkSession, name: str, wanted: list[int]) -> DataFrame:
    """The rows of some buckets of a snapshot. Files of the others are not opened."""
    held = facts(spark, name)
    rows = spark.table(held["snapshot"])
    if len(wanted) == int(held["buckets"]):
        return rows
    # the name of a bucket's file ends in _<bucket>.c<number>
    bucket = F.regexp_extract("_metadata.file_name", r"_(\d+)(?:\.c\d+)?\.", 1).cast("int")
    return rows.where(bucket.isin(wanted))
