"""Table schemas of the document store."""

from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())

# A file as Spark's binaryFile source gives it.
FILES = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType()),
    ]
)

# One row per registered document. `updated` is the load time.
SOURCE_DOCS = T.StructType(
    [
        T.StructField("doc_path", T.StringType()),
        T.StructField("source_file_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("authors", _STRINGS),
        T.StructField("summary", T.StringType()),
        T.StructField("published", T.TimestampType()),
        T.StructField("updated", T.TimestampType()),
        T.StructField("links", _STRINGS),
        T.StructField("categories", _STRINGS),
    ]
)

# The same columns keyed by a catalogue id.
CATALOGUE = T.StructType([T.StructField("id", T.StringType()), *SOURCE_DOCS.fields[1:]])

# What a source of files lists: its own id of each file, the file's name there, and where to read it.
LISTING = T.StructType(
    [
        T.StructField("file_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)

# Files that a run did not find.
MISSING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("seen", T.TimestampType()),
    ]
)

# `parsed_content` is JSON text of the shape PARSED_CONTENT.
PARSED_DOCS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("parsed_content", T.StringType()),
        T.StructField("processed", T.TimestampType()),
    ]
)

ELEMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)

PARSED_CONTENT = T.StructType(
    [
        T.StructField(
            "document",
            T.StructType([T.StructField("elements", T.ArrayType(ELEMENT))]),
        )
    ]
)

# Options to read it with: by default a text of over 20 million characters makes the JSON
# bad, and the document would be lost.
JSON_OPTIONS = {"maxStringLen": str(2**31 - 1)}

CHUNKS = T.StructType(
    [
        T.StructField("doc_path", T.StringType()),
        T.StructField("chunk_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("authors", T.StringType()),
        T.StructField("element_ix", T.IntegerType()),
    ]
)
