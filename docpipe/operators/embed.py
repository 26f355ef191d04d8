"""Text → vector by feature hashing (Weinberger et al. 2009).

A text is kept as the list of the buckets of its words, one entry per word. Counting the
entries gives its vector. Other vectors can be used instead as ARRAY<FLOAT> columns.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the hash: words are runs of letters and numbers, and the bucket comes
# from the first four hex digits of the MD5 of the lower-case word.
NO_WORD = r"[^\p{L}\p{N}]+"
WORD_CHAR = r"[\p{L}\p{N}]"
HASH_DIGITS = 4
DIM = 256


def buckets(text: Column, dim: int = DIM) -> Column:
    """Bucket of each word of the text, as ARRAY<INT>."""
    words = F.filter(F.split(F.lower(text), NO_WORD), lambda w: w != "")
    return F.transform(
        words,
        lambda w: F.conv(F.substr(F.md5(w.cast("binary")), F.lit(1), F.lit(HASH_DIGITS)), 16, 10)
        .cast("int")
        % dim,
    )


def hashed(df: DataFrame, key: str, text: str, dim: int = DIM) -> DataFrame:
    """(key, vec) of the rows whose text has a word."""
    # Tested on the text: a test of `vec` would be pushed below the projection and hash
    # every word twice.
    return df.where(F.col(text).rlike(WORD_CHAR)).select(
        key, buckets(F.col(text), dim).alias("vec")
    )


def counts(column: pa.Array, dim: int) -> np.ndarray:
    """Bucket lists → matrix of counts, one row per list."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    rows = np.repeat(np.arange(len(column)), lengths)
    values = np.asarray(column.flatten())
    if len(values) and not 0 <= values.min() <= values.max() < dim:
        raise ValueError(f"bucket {values.max()} in vectors of {dim} buckets")
    return np.bincount(rows * dim + values, minlength=len(column) * dim).reshape(-1, dim)


def _dense(column: pa.Array) -> np.ndarray:
    """Float lists of one length → matrix, with zeros for NULL."""
    flat = np.asarray(column.flatten(), dtype=np.float64)
    there = np.asarray(column.is_valid())
    lengths = np.unique(np.asarray(column.value_lengths().drop_null()))
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {lengths.tolist()}")
    width = len(flat) // max(1, there.sum())
    matrix = np.zeros((len(column), width))
    matrix[there] = flat.reshape(there.sum(), width)
    return matrix


class Vectors:
    """An Arrow column of vectors as a matrix, with norms and a float32 unit copy."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, dim: int | None):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        # Whole numbers from 0; a search keeps its own form of the rows in `packed`.
        self.counted, self.packed = bool(dim), None
        if dim:
            self.exact = counts(column, dim).astype(np.float64)
        else:
            self.exact = _dense(column)
        self.norm2 = (self.exact * self.exact).sum(axis=1)
        self.usable = self.norm2 > 0
        safe = np.sqrt(np.where(self.usable, self.norm2, 1.0))
        self.unit = (self.exact / safe[:, None]).astype(np.float32)

    def __len__(self) -> int:
        return len(self.exact)


def hashed_counts(df: DataFrame, key: str, text: str, dim: int = DIM) -> DataFrame:
    """One row per key and bucket: how many words fell in it, and the squared norm.

    Counting is a matter of one row, so it runs per Arrow batch without a shuffle.
    """
    vectors = hashed(df, key, text, dim)
    key_type = vectors.schema[key].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = counts(batch.column("vec"), dim)
            row, bucket = np.nonzero(matrix)
            n = matrix[row, bucket]
            norm2 = (matrix * matrix).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(pa.array(row)),
                    pa.array(bucket.astype(np.int32)),
                    pa.array(n.astype(np.int64)),
                    pa.array(norm2[row].astype(np.int64)),
                ],
                names=[key, "bucket", "n", "norm2"],
            )

    return vectors.mapInArrow(count, f"{key} {key_type}, bucket int, n bigint, norm2 bigint")


def unit_vectors(df: DataFrame, key: str, dim: int | None = DIM) -> DataFrame:
    """(key, vec, unit): `vec`, as for `Vectors`, with its unit vector as ARRAY<FLOAT>."""
    key_type, vec_type = (df.schema[c].dataType.simpleString() for c in (key, "vec"))

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = Vectors(batch.column("vec"), dim).unit
            offsets = pa.array(np.arange(len(unit) + 1, dtype=np.int32) * unit.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key),
                    batch.column("vec"),
                    pa.ListArray.from_arrays(offsets, pa.array(unit.ravel())),
                ],
                names=[key, "vec", "unit"],
            )

    schema = f"{key} {key_type}, vec {vec_type}, unit array<float>"
    return df.select(key, "vec").where(F.col("vec").isNotNull()).mapInArrow(scale, schema)
