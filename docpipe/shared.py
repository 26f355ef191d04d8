"""The folder that all executors see, for checkpoints and written tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a temporary folder only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    # a remote session has no context, and no folder of its own
    sc = getattr(spark, "sparkContext", None)
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="docpipe-")
    return _local_roots[sc.applicationId]


def new_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared root that nothing has used before."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def new_database(spark: SparkSession, name: str) -> str:
    """Create an empty database below the shared root and return its name."""
    database = f"{name}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_root(spark)}/{database}'")
    return database


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, computed once and kept as files below the shared root.

    Files survive lost executors, and Spark knows their size when it plans what follows.
    """
    return written_at(df, name)[0]


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As `written`, and the folder, for the caller to `remove` when nothing reads it any more."""
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared root that nothing reads any more."""
    if not path.startswith(f"{shared_root(spark)}/"):
        raise ValueError(f"{path} is not below the shared root")
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:  # a remote session: the folder stays for the cluster's own cleaning
        return
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    target.getFileSystem(conf).delete(target, True)
