"""Triggered runs: each takes what arrived since the last one and stops.

Every run needs its own checkpoint folder, on storage that all executors see. Each micro-batch is
written as a folder of its own, named by checkpoint and batch number: a batch that Spark hands over
again replaces what a dead run left of it.
"""

import uuid
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docpipe import schemas
from docpipe.operators import chunks, embed, parse, tables
from docpipe.operators.index import CONTENT, content_hash

if TYPE_CHECKING:
    import pandas as pd

# Chunks of a stream say when their document was parsed, and whether a later version lacks them.
STREAM_CHUNKS = T.StructType(
    [
        *schemas.CHUNKS.fields,
        schemas.PARSED_DOCS["processed"],
        T.StructField("deleted", T.BooleanType()),
    ]
)

# What `sync_index` writes.
STREAM_INDEX = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("vec", T.ArrayType(T.IntegerType())),
        T.StructField("hash", T.LongType()),
        schemas.PARSED_DOCS["processed"],
        T.StructField("deleted", T.BooleanType()),
    ]
)

# Files that one micro-batch reads.
BATCH_FILES = 100_000

# Spark's file source passes over files much older than the newest it has seen. A file may come
# late with any date, so there is no limit here.
ANY_AGE = "36500d"

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """A random name kept in the checkpoint folder: batch numbers start again in a new one."""
    path = f"{checkpoint}/docpipe-id"
    name = F.lit(uuid.uuid4().hex).alias("id")
    spark.range(1, numPartitions=1).select(name).write.mode("ignore").parquet(path)
    return spark.read.schema("id string").parquet(path).first().id


def _append_new(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    change: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Write each batch below `out`. What reads a folder takes all files below it."""
    name = checkpoint_id(rows.sparkSession, checkpoint)

    # A scan of small files has a task for every few of them, and each would write a file that the
    # next stream has to find and open. As many tasks as a shuffle has take them together.
    tasks = tables.default_buckets(rows.sparkSession)

    def write(batch: DataFrame, number: int) -> None:
        change(batch).coalesce(tasks).write.mode("overwrite").parquet(f"{out}/{name}-{number}")

    (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_batches(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches so far."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)


def _stream_batches(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", ANY_AGE)
        .option("maxFilesPerTrigger", BATCH_FILES)
        .parquet(folder)
    )


def parse_new_files(
    spark: SparkSession,
    root: str,
    out: str,
    checkpoint: str,
    glob: str | None = None,
    max_files: int = BATCH_FILES,
) -> None:
    """Parse the files that are new below the root and add them to the folder `out`."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(schemas.FILES)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", ANY_AGE)
        .option("maxFilesPerTrigger", max_files)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    _append_new(parse.to_parsed_docs(reader.load(root)), out, checkpoint)


class Versions(StatefulProcessor):
    """State of each document: when its latest version was parsed, and the ids of its chunks.

    A newer version gives its chunks, and a deletion for each id that it has no more. An older one
    that comes late gives nothing.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "at long, ids array<string>")

    def handleInputRows(self, key, rows, timerValues) -> "Iterator[pd.DataFrame]":
        import pandas as pd  # in the tasks only

        parts = pd.concat(list(rows), ignore_index=True)
        at = int(parts["at"].max())
        before, ids = self.held.get() if self.held.exists() else (None, [])
        if before is not None and at < before:
            return
        now = parts[(parts["at"] == at) & parts["id"].notna()].drop_duplicates("id")
        self.held.update((at, list(now["id"])))
        gone = sorted(set(ids) - set(now["id"]))
        stamp = parts.loc[parts["at"] == at, "processed"].iloc[0]
        lost = pd.DataFrame({"id": gone, "doc_path": key[0], "processed": stamp, "deleted": True})
        both = pd.concat([now.assign(deleted=False), lost] if gone else [now.assign(deleted=False)])
        both["element_ix"] = both["element_ix"].astype("Int32")
        yield both[STREAM_CHUNKS.names]

    def close(self) -> None:
        pass


def chunk_new_docs(
    spark: SparkSession, parsed: str, out: str, checkpoint: str, source: DataFrame | None = None
) -> None:
    """Add the chunks of the documents that are new in the folder `parsed`, and deletions.

    A document that comes again is a new version of it: see `Versions`.
    """
    own = tables.own_session(spark)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    docs = _stream_batches(own, parsed, schemas.PARSED_DOCS)
    rows = chunks.build(docs, source, keep=("processed",), outer=True)
    rows = rows.withColumn("at", F.coalesce(F.unix_micros("processed"), F.lit(0)))
    versions = rows.groupBy("doc_path").transformWithStateInPandas(
        statefulProcessor=Versions(),
        outputStructType=STREAM_CHUNKS,
        outputMode="append",
        timeMode="None",
    )
    _append_new(versions, out, checkpoint)


def latest_by_id(rows: DataFrame) -> DataFrame:
    """One row per id, that of the document parsed last; deleted ones too."""
    others = [c for c in rows.columns if c not in ("id", "processed", "deleted")]
    version = F.struct("processed", (~F.col("deleted")).alias("there"), F.struct(*others).alias("c"))
    return (
        rows.groupBy("id")
        .agg(F.max(version).alias("r"))
        .select("id", "r.processed", (~F.col("r.there")).alias("deleted"), "r.c.*")
    )


def sync_index(
    spark: SparkSession, chunk_dir: str, index_dir: str, checkpoint: str, dim: int = embed.DIM
) -> None:
    """Add the vectors of what is new in `chunk_dir`, and its deletions, to the folder `index_dir`.

    A stream that starts anew adds the same rows again, which changes nothing: `read_index` takes
    the latest of each id, and of the latest versions all are alike.
    """

    def embedded(rows: DataFrame) -> DataFrame:
        words = embed.buckets(F.coalesce("text", F.lit("")), dim)
        there = ~F.col("deleted")
        return rows.select(
            "id",
            F.when(there, words).cast(STREAM_INDEX["vec"].dataType).alias("vec"),
            F.when(there, content_hash(*CONTENT)).alias("hash"),
            "processed",
            "deleted",
        )

    _append_new(_stream_batches(spark, chunk_dir, STREAM_CHUNKS), index_dir, checkpoint, embedded)


def read_index(spark: SparkSession, index_dir: str, dim: int = embed.DIM) -> DataFrame:
    """(id, vec, hash, processed): the latest version of each chunk that its document still has."""
    rows = latest_by_id(read_batches(spark, index_dir, STREAM_INDEX)).where("NOT deleted")
    return rows.select("id", "vec", "hash", "processed").withMetadata("vec", {"dim": dim})
