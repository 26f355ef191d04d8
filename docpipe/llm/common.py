"""What the operators share: tables, batch-wise new columns, words and rolling hashes of bytes."""

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.shared import new_dir, remove

#: Bytes of text that one NumPy step handles, so that its arrays stay small whatever the batch holds.
STEP_BYTES = 1 << 20

#: A word is a run of anything but these.
BLANKS = " \t\n\r\x0b\x0c"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or with underscores after it, so that `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Hand memory that a task has used back to the system.

    Spark's Python workers live on for later tasks, and with them what they hold: garbage in
    cycles, which every closure sent by value leaves, and free memory of the allocators.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def collect_on_executors(spark: SparkSession) -> None:
    """A full garbage collection in the JVM of every executor, by short tasks, two for each core."""
    tasks = 2 * spark.sparkContext.defaultParallelism
    collected = F.java_method(F.lit("java.lang.System"), F.lit("gc"))
    spark.range(0, tasks, 1, tasks).select(collected).write.format("noop").mode("overwrite").save()


def settle(spark: SparkSession) -> None:
    """Between two large pieces of work: free what the first one left on the driver and the executors.

    Spark drops shuffles, broadcasts and plans of done work when the driver's JVM collects its
    garbage, and a full collection makes a JVM's heap smaller again. Else an executor's heap would
    stay as large as it ever was, beside what its Python workers hold.
    """
    give_back()
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        jvm.System.gc()
        # in local mode the driver's JVM is the only one
        if not spark.sparkContext.master.startswith("local["):
            collect_on_executors(spark)


def attach(
    df: DataFrame,
    inputs: dict[str, Column],
    fields: list[T.StructField],
    compute: Callable[[], Callable[[pa.RecordBatch], list]],
) -> DataFrame:
    """`df` with the columns `fields`, which `compute()(inputs of a batch)` returns in order.

    A column of `df` that has the name of a new one, in any letter case, is replaced. `compute`
    runs once in each task, so it may load models or keep caches.
    """
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    schema = T.StructType(kept + fields)
    names, wanted, n_kept = schema.names, list(inputs), len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, batch, rest, ins, out = compute(), None, None, None, None
        for batch in batches:
            rest, ins = batch.columns[:n_kept], batch.columns[n_kept:]
            out = step(pa.RecordBatch.from_arrays(ins, names=wanted))
            yield pa.RecordBatch.from_arrays(
                rest + [a if isinstance(a, pa.Array) else pa.array(a) for a in out],
                names=names,
            )
        del step, batch, rest, ins, out
        give_back()

    quoted = [F.col(f"`{f.name.replace('`', '``')}`") for f in kept]
    prepared = df.select(*quoted, *[c.alias(fresh(df, f"in_{k}")) for k, c in inputs.items()])
    return prepared.mapInArrow(run, schema)


def emit(
    df: DataFrame, schema: str, compute: Callable[[], Callable[[pa.RecordBatch], Iterator[dict]]]
) -> DataFrame:
    """Other rows than those of `df`: `compute()(batch)` yields column dictionaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, batch, columns = compute(), None, None
        for batch in batches:
            for columns in step(batch):
                yield pa.RecordBatch.from_pydict(columns)
        del step, batch, columns
        give_back()

    return df.mapInArrow(run, schema)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a column without nulls, and where each starts (one more)."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    _, starts, data = texts.buffers()
    at = np.frombuffer(starts, kind, len(texts) + 1, texts.offset * kind().nbytes).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, at


def steps(starts: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `limit` bytes; a longer text is a run of its own."""
    first, rows = 0, len(starts) - 1
    while first < rows:
        last = int(np.searchsorted(starts, starts[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def words_of(text: str) -> list[bytes]:
    """The words, as UTF-8: bytes.split() cuts at just the blanks above."""
    return text.encode().split()


class WordHashes(dict):
    """Word to 64-bit hash; forgets all words when there are too many."""

    def __init__(self, most: int = 300_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number mixed so that all its bits depend on all of the input's."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of `size` words; fewer words are one run; no words have none."""
    if not len(words):
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - size + 1 + k])
    return out


class Rolling:
    """Hashes of any substring of a byte array, from sums of powers modulo 2**64."""

    BASE = 0xD1342543DE82EF95
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self, seed: int = 0):
        self.seed = np.uint64(seed)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> "Rolling":
        n = len(data)
        if len(self.powers) <= n:
            size = n + 1
            self.powers = np.full(size, self.BASE, np.uint64)
            self.inverses = np.full(size, self.INVERSE, np.uint64)
            self.powers[0] = self.inverses[0] = 1
            np.cumprod(self.powers, out=self.powers)
            np.cumprod(self.inverses, out=self.inverses)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=self.sums[1:])
        return self

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        value = (self.sums[stop] - self.sums[start]) * self.inverses[start]
        return mixed(value ^ self.seed)

    def grams(self, size: int) -> np.ndarray:
        """The hash at each place that has `size` bytes from there on."""
        n = len(self.sums) - size
        if n <= 0:
            return np.empty(0, np.uint64)
        return mixed(((self.sums[size:] - self.sums[:n]) * self.inverses[:n]) ^ self.seed)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows as files below the shared root; shuffle files of the work go when it is done.

    Lineage ends here: what follows reads files that survive lost executors.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        path = new_dir(df.sparkSession, name)
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Remove the files of tables that `kept` wrote, once all that reads them is kept itself."""
    for df in tables:
        remove(df.sparkSession, df.kept_at)
