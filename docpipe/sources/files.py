"""Files as rows."""

import re
import warnings
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Schemes that tasks open by themselves. Files of others are read by Spark from lists of paths.
OPENED = r"^(file:|/|s3://|s3a://|s3n://|gs://)"

# Bytes of content that a task holds before it hands them on; a larger file is handed on alone.
HELD_BYTES = 32 << 20

# Paths that are looked up at a time.
LOOKED_UP = 1_000


def scan_files(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """One row per file below the given folders or paths, with its bytes in `content`.

    A query that does not select `content` does not read it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths)


def discover(
    spark: SparkSession,
    roots: str | list[str],
    glob: str | None = None,
    known: DataFrame | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Files below the roots, subfolders included, that are not in `known` (`doc_path`).

    Known files leave before the cut to `max_files`, so every run gets on to new ones.
    """
    files = scan_files(spark, roots, glob).select("path", "modificationTime", "length")
    if known is not None:
        files = files.join(
            known.select(F.col("doc_path").alias("path")), "path", "left_anti"
        )
    if max_files:
        files = files.orderBy("path").limit(max_files)
    return files


def path_batches(paths: DataFrame, size: int) -> Iterator[list[str]]:
    """The one path column in lists of at most `size`.

    Spark plans a file scan from a list of paths on the driver. Lists of bounded size
    keep that list small however many files wait; paths come in partitions of about that size.
    """
    parts = max(1, -(-paths.count() // size))
    rows = paths.repartition(parts).toLocalIterator()
    while batch := [r[0] for r in islice(rows, size)]:
        yield batch


def scan_present(spark: SparkSession, paths: list[str]) -> Iterator[DataFrame]:
    """The files of these names that exist, mostly as one table; a missing one is warned of.

    Spark refuses a list with a path that is not there. Such a list is halved until the path
    stands alone. A file that goes while it is read is passed over.
    """
    try:
        yield scan_exactly(spark, paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        if len(paths) == 1:
            warnings.warn(f"file is gone: {paths[0]}", stacklevel=2)
            return
        for half in (paths[: len(paths) // 2], paths[len(paths) // 2 :]):
            yield from scan_present(spark, half)


def scan_exactly(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files of these names, where `*`, `[` and the like are plain characters."""
    exact = [re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths]
    reader = spark.read.format("binaryFile").option("ignoreMissingFiles", "true")
    return reader.option("recursiveFileLookup", "true").load(exact)


def opened_by_tasks(path: Column) -> Column:
    return path.rlike(OPENED)


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and its name there. All characters of the name count as they are."""
    found = re.match(r"(s3|s3a|s3n|gs)://([^/]+)/(.*)", path, re.S)
    if found is None:
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    scheme, bucket, name = found.groups()
    root = f"{'s3' if scheme.startswith('s3') else scheme}://{bucket}/"
    store, base = fs.FileSystem.from_uri(root)
    return store, f"{base.rstrip('/')}/{name}"


FOUND = "path string, length bigint, error string"


def look_up(paths: DataFrame) -> DataFrame:
    """(path, length, error) for the one column of paths: `error` where there is no such file.

    Files are asked for in the tasks; the driver holds no path.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, LOOKED_UP):
                names = batch.column(0).slice(first, LOOKED_UP).to_pylist()
                yield pa.RecordBatch.from_pylist([one(name) for name in names], schema)

    def one(path: str) -> dict:
        store, name = locate(path)
        info = store.get_file_info(name)
        error = None if info.is_file else "file is gone"
        return {"path": path, "length": info.size if info.is_file else None, "error": error}

    schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("error", pa.string())])
    return paths.toDF("path").mapInArrow(run, FOUND)


def read_listed(paths: DataFrame, copy_to: str | None = None) -> DataFrame:
    """`paths` with the `content` of the file at `path`, or the `error` that opening it gave.

    Each task opens the files of its own rows and holds HELD_BYTES of them at a time. With
    `copy_to` the bytes are also written to the path in that column; a task that runs again
    writes the same file again.
    """
    names = paths.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, contents, errors = 0, 0, [], []
            for k, path in enumerate(batch.column("path").to_pylist()):
                content, error = read(path, batch.column(copy_to)[k].as_py() if copy_to else None)
                contents.append(content)
                errors.append(error)
                held += len(content or b"")
                if held >= HELD_BYTES:
                    yield rows(batch.slice(first, len(contents)), contents, errors)
                    first, held, contents, errors = k + 1, 0, [], []
            yield rows(batch.slice(first), contents, errors)

    def read(path: str, target: str | None) -> tuple[bytes | None, str | None]:
        try:
            store, name = locate(path)
            with store.open_input_stream(name) as stream:
                content = stream.read()
        except FileNotFoundError:
            return None, "file is gone"
        if target is not None:
            store, name = locate(target)
            store.create_dir(name.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(name) as stream:
                stream.write(content)
        return content, None

    def rows(part: pa.RecordBatch, contents: list, errors: list) -> pa.RecordBatch:
        columns = [*part.columns, pa.array(contents, pa.binary()), pa.array(errors, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[*names, "content", "error"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in paths.schema.fields)
    return paths.mapInArrow(run, f"{schema}, content binary, error string")
