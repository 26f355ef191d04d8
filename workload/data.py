"""Tables that the queries run on, derived from whole given tables by content rules."""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.operators import parse
from docpipe.sources.files import OPENED, locate
from docpipe.sources.tables import spread


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", "page_id", "url", "html")


def text_path(doc_id: str = "doc_id") -> F.Column:
    return F.concat(F.lit("/docs/"), F.col(doc_id), F.lit(".txt"))


def line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of each document as a chunk; source as title, language as author."""
    return (
        documents(spark, sf_dir)
        .select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("ix", "text"))
        .select(
            text_path().alias("doc_path"),
            F.concat_ws("_", "doc_id", "ix").alias("id"),
            "text",
            F.col("source").alias("title"),
            F.col("lang").alias("authors"),
        )
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users said in the conversations."""
    return (
        spark.read.parquet(f"{sf_dir}/conversations.parquet")
        .where("role = 'user'")
        .select(F.concat_ws("_", "conv_id", "turn").alias("qid"), F.col("text").alias("question"))
    )


def source_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry: labelled documents. Toxic ones have no authors."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source")
    return labels.join(docs, "doc_id").select(
        text_path().alias("doc_path"),
        F.concat(F.lit("f"), "doc_id").alias("source_file_id"),
        F.col("source").alias("title"),
        F.when(F.col("toxic") == 0, F.array("lang", "source")).alias("authors"),
        F.lit(None).cast("timestamp").alias("updated"),
    )


def parsed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as parsed JSON, a line an element. A line with ` | ` is a table row."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            i.cast("string").alias("id"),
            F.when(line.contains(" | "), "table").otherwise("text").alias("type"),
            line.alias("content"),
        ),
    )
    return documents(spark, sf_dir).select(
        F.concat(F.lit("dbfs:"), text_path()).alias("path"),
        parse.to_json(lines).alias("parsed_content"),
        F.current_timestamp().alias("processed"),
    )


def hyphenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with line breaks put behind words of five and more letters."""
    return documents(spark, sf_dir).select(
        "doc_id", F.regexp_replace("text", "([a-z]{5}) ", "$1-\n").alias("t")
    )


def old_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First snapshot: the lines of all documents."""
    return line_chunks(spark, sf_dir)


def new_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second snapshot: toxic documents gone, digits masked, pages added."""
    toxic = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").select("doc_id")
    kept = (
        line_chunks(spark, sf_dir)
        .withColumn("doc_id", F.substring_index("id", "_", 1).cast("bigint"))
        .join(toxic, "doc_id", "left_anti")
        .withColumn("text", F.regexp_replace("text", "[0-9]", "#"))
        .select("doc_path", "id", "text", "title", "authors")
    )
    added = (
        pages(spark, sf_dir)
        .select("page_id", "url", F.explode(parse.html_elements(F.col("html"))).alias("e"))
        .select(
            F.concat(F.lit("/pages/"), "page_id").alias("doc_path"),
            F.concat(F.lit("p"), "page_id", F.lit("_"), "e.id").alias("id"),
            F.col("e.content").alias("text"),
            F.col("url").alias("title"),
            F.lit(None).cast("string").alias("authors"),
        )
    )
    return kept.unionByName(added)


def stage_pages(rows: DataFrame, folder: str) -> None:
    """Write each page as a file of its own, whose name carries its id. The tasks write the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = locate(folder)
        for batch in batches:
            if batch.num_rows:
                store.create_dir(root, recursive=True)
            for page, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                name = f"{root}/page={page}.txt"
                with store.open_output_stream(name) as stream:
                    stream.write(f"{html}\n".encode())
            yield batch.select(["page_id"])

    if re.match(OPENED, folder):
        rows.select("page_id", "html").mapInArrow(run, "page_id bigint").write.format("noop").mode("overwrite").save()
        return
    rows.select(F.col("page_id").alias("page"), F.col("html").alias("value")).write.mode(
        "append"
    ).partitionBy("page").text(folder)


def page_of(path: str = "path") -> F.Column:
    """The page id in the path of a staged file."""
    return F.regexp_extract(path, r"/page=(\d+)[/.]", 1).cast("bigint")
