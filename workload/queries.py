"""The registered queries. Each runs over whole given tables."""

from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe import schemas
from docpipe.functions import sql as sql_functions
from docpipe.functions import text as text_functions
from docpipe.operators import (
    cells,
    chunks,
    embed,
    index,
    metadata,
    parse,
    rag,
    registry,
    search,
    tables,
)
from docpipe.plans import jobs
from docpipe.shared import new_database, new_dir, written
from docpipe.sources.files import discover, scan_files
from docpipe.sources.tables import optional_table, read_table
from docpipe.streaming import runs
from workload import data

GLOB = "*.txt"


# Sources


def scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_dir(spark, "pages")
    data.stage_pages(data.pages(spark, sf_dir), folder)
    return scan_files(spark, folder, GLOB).select(
        data.page_of().alias("page_id"), "length", F.md5("content").alias("content_md5")
    )


def discover_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages come from two folders; those of the first are known."""
    pages = data.pages(spark, sf_dir)
    first, second = new_dir(spark, "pages"), new_dir(spark, "pages")
    data.stage_pages(pages.where("url LIKE 'http://%'"), first)
    data.stage_pages(pages.where("url NOT LIKE 'http://%'"), second)
    known = scan_files(spark, first, GLOB).select(F.col("path").alias("doc_path"))
    return discover(spark, [first, second], GLOB, known).select(
        data.page_of().alias("page_id"), "length"
    )


def optional_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry is read if it is there; chunks are built with and without one."""
    db = new_database(spark, "optional")
    name = f"{db}.source_docs"
    parsed = data.parsed_docs(spark, sf_dir)

    def titled(label: str) -> DataFrame:
        built = chunks.build(parsed, optional_table(spark, name))
        return built.select(
            F.lit(label).alias("registry"), "id", F.col("title").isNotNull().alias("titled")
        )

    without = titled("absent")
    tables.ensure(spark, name, schemas.SOURCE_DOCS)
    tables.append(data.source_docs(spark, sf_dir), name)
    return without.unionByName(titled("present"))


# Scalar functions


def safe_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses with their slashes and dots made quotes, as file names."""
    quoted = F.translate("url", "/.", "\"'")
    return data.pages(spark, sf_dir).select(
        "page_id", text_functions.safe_name(quoted).alias("name")
    )


def norm_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix in front for https, at the end for http."""
    path = F.when(F.col("url").startswith("https"), F.concat(F.lit("dbfs:"), "url")).otherwise(
        F.concat("url", F.lit("dbfs:"))
    )
    return data.pages(spark, sf_dir).select(
        "page_id", text_functions.norm_path(path).alias("doc_path")
    )


def author_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.source_docs(spark, sf_dir).select(
        "source_file_id", text_functions.join_authors(F.col("authors")).alias("authors")
    )


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.hyphenated(spark, sf_dir).select(
        "doc_id", text_functions.clean_text(F.col("t")).alias("text")
    )


def clean_text_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql_functions.register(spark)
    return data.hyphenated(spark, sf_dir).selectExpr("doc_id", "clean_chunk(t) AS text")


# Parsing


def html_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        data.pages(spark, sf_dir)
        .select("page_id", F.explode(parse.html_elements(F.col("html"))).alias("e"))
        .select("page_id", "e.id", "e.type", "e.content")
    )


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.pages(spark, sf_dir).select(
        "page_id", parse.to_markdown(parse.html_elements(F.col("html"))).alias("markdown")
    )


def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.extract(data.pages(spark, sf_dir)).select(
        "page_id", "title", "summary", F.array_join("links", " ").alias("links")
    )


# Chunks


def build_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.build(data.parsed_docs(spark, sf_dir), data.source_docs(spark, sf_dir))


def chunks_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql_functions.register(spark)
    return spark.sql(
        """
        SELECT path, e.chunk_id, clean_chunk(e.content) AS text
        FROM (SELECT path, chunk_list(parsed_content) AS found FROM {parsed})
            LATERAL VIEW explode(found) AS e
        """,
        parsed=data.parsed_docs(spark, sf_dir),
    )


# Registry


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are registered; those with a label are parsed."""
    registered = data.documents(spark, sf_dir).select(data.text_path().alias("doc_path"))
    parsed = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        F.concat(F.lit("dbfs:"), data.text_path()).alias("path")
    )
    return registry.pending(registered, parsed)


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.documents(spark, sf_dir).select(
        F.concat(F.lit("f"), "doc_id").alias("source_file_id")
    )


def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.new_files(_listing(spark, sf_dir), data.source_docs(spark, sf_dir))


def exists_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.exists_many(_listing(spark, sf_dir), data.source_docs(spark, sf_dir))


# Tables and jobs


def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest job: a first folder, then both folders, then nothing new."""
    pages = data.pages(spark, sf_dir)
    folder = new_dir(spark, "pages")
    table = f"{new_database(spark, 'ingest')}.source_docs"
    data.stage_pages(pages.where("url LIKE 'http://%'"), folder)
    jobs.ingest(spark, folder, table, GLOB, read_metadata=True)
    data.stage_pages(pages.where("url NOT LIKE 'http://%'"), folder)
    jobs.ingest(spark, folder, table, GLOB, read_metadata=True)
    jobs.ingest(spark, folder, table, GLOB, read_metadata=True)
    return _registry(spark, table).select(
        data.page_of("doc_path").alias("page_id"), data.page_of("file_id").alias("file_page"), *REGISTERED
    )


REGISTERED = ("title", "summary", "links", "not_known", "dated")


def _registry(spark: SparkSession, table: str) -> DataFrame:
    """The registry with all its columns in a form to compare: pages name no authors, dates or subjects."""
    unknown = [F.col(c).isNull() for c in ("authors", "published", "categories")]
    return read_table(spark, table).select(
        "doc_path",
        F.col("source_file_id").alias("file_id"),
        "title",
        "summary",
        F.array_join("links", " ").alias("links"),
        (unknown[0] & unknown[1] & unknown[2]).alias("not_known"),
        F.col("updated").isNotNull().alias("dated"),
    )


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest job on a listing of ids and names, in which quotes stand for slashes and dots.

    First the pages of http://, then all of them, then nothing new.
    """
    pages = data.pages(spark, sf_dir)
    folder, copies = new_dir(spark, "pages"), new_dir(spark, "copies")
    table = f"{new_database(spark, 'listing')}.source_docs"
    data.stage_pages(pages, folder)
    files = scan_files(spark, folder, GLOB).select(data.page_of().alias("page_id"), "path")
    listing = files.join(pages, "page_id").select(
        F.concat(F.lit("f"), F.lpad("page_id", 9, "0")).alias("file_id"),
        F.translate("url", "/.", "\"'").alias("name"),
        "path",
        "url",
    )
    for some in (listing.where("url LIKE 'http://%'"), listing, listing):
        jobs.ingest_listing(spark, some.drop("url"), copies, table)
    return _registry(spark, table).select(
        "file_id", F.substring_index("doc_path", "/", -1).alias("name"), *REGISTERED
    )


def _parsed_pages(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    db = new_database(spark, "parse")
    source, parsed = f"{db}.source_docs", f"{db}.parsed_docs"
    folder = new_dir(spark, "pages")
    data.stage_pages(data.pages(spark, sf_dir), folder)
    jobs.ingest(spark, folder, source, GLOB, read_metadata=True)
    jobs.parse_pending(spark, source, parsed)
    return db, source, parsed


def parsed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parse job run twice, and its rows appended once more, hold each document once."""
    _, source, parsed = _parsed_pages(spark, sf_dir)
    jobs.parse_pending(spark, source, parsed)
    parse.append_parsed(read_table(spark, parsed), parsed)
    found = F.from_json("parsed_content", schemas.PARSED_CONTENT, schemas.JSON_OPTIONS)["document"]["elements"]
    fields = F.transform(found, lambda e: F.concat_ws("|", e["id"], e["type"], e["content"]))
    return read_table(spark, parsed).select(
        data.page_of().alias("page_id"),
        F.array_join(fields, "\n").alias("elements"),
        F.col("processed").isNotNull().alias("dated"),
    )


def reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after both tables are emptied; a third table does not exist."""
    db = new_database(spark, "reset")
    names = ("source_docs", "parsed_docs")
    tables.ensure(spark, f"{db}.source_docs", schemas.SOURCE_DOCS)
    tables.ensure(spark, f"{db}.parsed_docs", schemas.PARSED_DOCS)
    tables.append(data.source_docs(spark, sf_dir), f"{db}.source_docs")
    tables.append(data.parsed_docs(spark, sf_dir), f"{db}.parsed_docs")

    def rows(column: str) -> DataFrame:
        one, other = (
            spark.table(f"{db}.{n}").agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias(column)) for n in names
        )
        return one.unionByName(other)

    before = written(rows("before"), "counts")
    tables.reset(spark, *[f"{db}.{n}" for n in names], f"{db}.absent")
    return before.join(rows("after"), "table")


def page_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to index in three jobs, and what the index holds."""
    db, source, parsed = _parsed_pages(spark, sf_dir)
    idx = index.VectorIndex(spark, f"{db}.index")
    jobs.index_chunks(spark, parsed, source, f"{db}.chunks", idx)
    held = read_table(spark, f"{db}.chunks", "id", "doc_path", "chunk_id", "text", "title")
    return idx.read().join(held, [*index.KEY]).select(
        data.page_of("doc_path").alias("page_id"),
        "chunk_id",
        "text",
        "title",
        F.size("vec").alias("n_words"),
    )


# Index


def _with_hash(rows: DataFrame) -> DataFrame:
    return rows.withColumn("hash", index.content_hash("text", "title", "authors"))


def changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.changes(
        _with_hash(data.old_chunks(spark, sf_dir)), _with_hash(data.new_chunks(spark, sf_dir))
    )


def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines keyed by their own text: repeated lines break the key, and so do empty ones."""
    keyed = data.line_chunks(spark, sf_dir).select(
        F.md5(F.nullif("text", F.lit("")).cast("binary")).alias("id")
    )
    return index.key_violations(keyed)


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.hashed_counts(data.line_chunks(spark, sf_dir), "id", "text")


def _words() -> F.Column:
    """A vector as text: its buckets in order."""
    return F.array_join(F.array_sort("vec"), " ").alias("words")


def _synced(spark: SparkSession, sf_dir: str) -> index.VectorIndex:
    """An index that followed the chunk table from the first snapshot to the second."""
    db = new_database(spark, "sync")
    idx = index.VectorIndex(spark, f"{db}.index")
    for snapshot in (data.old_chunks, data.new_chunks):
        chunks.save(snapshot(spark, sf_dir), f"{db}.chunks", idx.buckets)
        idx.sync(f"{db}.chunks")
    return idx


def synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synced(spark, sf_dir).read().select("id", _words())


# Search


def _vectors(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vectors.select(F.col("vec_id").alias(key), F.col("embedding").alias("vec"))


def knn_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of each given vector, itself among them."""
    return search.top_k(
        _vectors(spark, sf_dir, "qid"), _vectors(spark, sf_dir, "id"), k=5, dim=None
    )


def _held_cells(spark: SparkSession, vectors: DataFrame, centers: np.ndarray, dim: int | None) -> cells.Cells:
    held = cells.Cells(spark, f"{new_database(spark, 'cells')}.cells", dim)
    held.build(vectors, centers)
    return held


def top_k_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells probed, which makes the search exact."""
    vectors = _vectors(spark, sf_dir, "id")
    held = _held_cells(spark, vectors, cells.learn_centers(vectors, 16), None)
    return search.top_k_cells(_vectors(spark, sf_dir, "qid"), held.read(), held.centers(), nprobe=16)


def top_k_probed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four of ten cells probed. Their centers are the mean directions of the labels."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label"
    )
    held = _held_cells(spark, vectors.drop("label"), cells.mean_centers(vectors, "label"), None)
    return search.top_k_cells(_vectors(spark, sf_dir, "qid"), held.read(), held.centers(), nprobe=4)


def cells_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search in the cells of the first snapshot's index, after they followed it to the second."""
    db = new_database(spark, "follow")
    idx = index.VectorIndex(spark, f"{db}.index")
    held = cells.Cells(spark, f"{db}.cells", idx.dim)
    for number, snapshot in enumerate((data.old_chunks, data.new_chunks)):
        chunks.save(snapshot(spark, sf_dir), f"{db}.chunks", idx.buckets)
        idx.sync(f"{db}.chunks")
        rows = idx.read().select("id", "vec", "hash")
        if number:
            held.follow(rows)
        else:
            held.build(rows, cells.learn_centers(rows, 16, idx.dim))
    return search.top_k_cells(_asked(spark, sf_dir), held.read(), held.centers(), 16, dim=idx.dim)


def probe_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the five best lines for each question, the share found with one, two and three of four
    cells. The centers are the mean directions of the languages."""
    lines = data.line_chunks(spark, sf_dir)
    vectors = written(embed.hashed(lines, "id", "text"), "vectors")
    grouped = vectors.join(lines.select("id", "authors"), "id")
    held = _held_cells(spark, vectors, cells.mean_centers(grouped, "authors", embed.DIM), embed.DIM)
    asked = _asked(spark, sf_dir)
    # one search in all cells, which is exact; fewer cells find the best of the hits in those
    centers = held.centers()
    hits = written(search.cell_hits(asked, held.read(), centers, len(centers), dim=embed.DIM), "cell-hits")
    exact = written(search.k_best(hits).select("qid", "id"), "exact")
    out = None
    for nprobe in (1, 2, 3):
        near = search.k_best(hits.where(F.col("place") <= nprobe)).select("qid", "id")
        counted = exact.join(near.withColumn("found", F.lit(1)), ["qid", "id"], "left").agg(
            F.lit(nprobe).alias("nprobe"), F.count("found").alias("found"), F.count(F.lit(1)).alias("wanted")
        )
        out = counted if out is None else out.unionByName(counted)
    return out.withColumn("recall", F.round(F.col("found") / F.col("wanted"), 6))


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.hashed(data.questions(spark, sf_dir), "qid", "question")


def _hits(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    rows = embed.hashed(data.line_chunks(spark, sf_dir), "id", "text")
    return search.top_k(_asked(spark, sf_dir), rows, k=5, **options)


def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = written(_hits(spark, sf_dir), "hits")
    return search.with_columns(hits, data.line_chunks(spark, sf_dir))


def top_k_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way for more questions than a broadcast may hold."""
    return _hits(spark, sf_dir, broadcast_values=0)


def top_k_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search in English and German lines only."""
    lines = search.apply_filters(data.line_chunks(spark, sf_dir), {"authors": ["en", "de"]})
    hits = search.top_k(_asked(spark, sf_dir), embed.hashed(lines, "id", "text"), k=5)
    return search.with_columns(written(hits, "hits"), lines)


def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rag.context(top_k(spark, sf_dir))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rag.prompts(data.questions(spark, sf_dir), top_k(spark, sf_dir))


def indexed_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The question job on a stored index."""
    db = new_database(spark, "answers")
    idx = index.VectorIndex(spark, f"{db}.index")
    chunks.save(data.line_chunks(spark, sf_dir), f"{db}.chunks", idx.buckets)
    lines = spark.table(f"{db}.chunks")
    idx.sync(f"{db}.chunks")
    return jobs.answer_prompts(
        data.questions(spark, sf_dir), idx.read(), lines, filters={"authors": ["en", "de"]}
    ).select("qid", "prompt")


def cell_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The question job on text vectors in cells, all of them probed."""
    lines = data.line_chunks(spark, sf_dir)
    # written: learning centers reads the vectors again and again
    vectors = written(embed.hashed(lines, "id", "text"), "vectors")
    held = _held_cells(spark, vectors, cells.learn_centers(vectors, 16, embed.DIM), embed.DIM)
    return jobs.answer_prompts(
        data.questions(spark, sf_dir), held.read(), lines, centers=held.centers(), nprobe=16
    ).select("qid", "prompt")


# Streams


def _stream_pages(spark: SparkSession, sf_dir: str, run) -> None:
    """Call `run(folder)` after each of three arrivals, the last of which brings nothing."""
    pages = data.pages(spark, sf_dir)
    folder = new_dir(spark, "pages")
    data.stage_pages(pages.where("url LIKE 'http://%'"), folder)
    run(folder)
    data.stage_pages(pages.where("url NOT LIKE 'http://%'"), folder)
    run(folder)
    run(folder)


def stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_dir(spark, "stream")
    _stream_pages(
        spark,
        sf_dir,
        lambda folder: runs.parse_new_files(
            spark, folder, f"{work}/parsed", f"{work}/parse-log", GLOB
        ),
    )
    parsed = runs.read_batches(spark, f"{work}/parsed", schemas.PARSED_DOCS)
    return parsed.select(
        data.page_of().alias("page_id"),
        F.inline(F.from_json("parsed_content", schemas.PARSED_CONTENT, schemas.JSON_OPTIONS)["document"]["elements"]),
    )


def stream_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to index by three chained streams.

    Then the pages of http:// come again with their first element alone, and the chunks are read
    once more by a stream that starts anew.
    """
    work = new_dir(spark, "stream")

    def follow(log: str = "sync-log") -> None:
        runs.chunk_new_docs(spark, f"{work}/parsed", f"{work}/chunks", f"{work}/chunk-log")
        runs.sync_index(spark, f"{work}/chunks", f"{work}/index", f"{work}/{log}")

    def run(folder: str) -> None:
        runs.parse_new_files(spark, folder, f"{work}/parsed", f"{work}/parse-log", GLOB)
        follow()

    _stream_pages(spark, sf_dir, run)
    parsed = runs.read_batches(spark, f"{work}/parsed", schemas.PARSED_DOCS)
    http = data.pages(spark, sf_dir).where("url LIKE 'http://%'").select("page_id")
    first = F.slice(
        F.from_json("parsed_content", schemas.PARSED_CONTENT, schemas.JSON_OPTIONS)["document"]["elements"], 1, 1
    )
    shorter = parsed.withColumn("page_id", data.page_of()).join(http, "page_id", "left_semi")
    shorter = shorter.select("path", parse.to_json(first).alias("parsed_content"), F.current_timestamp().alias("processed"))
    shorter.write.parquet(f"{work}/parsed/shorter")
    follow()
    follow("sync-log-2")
    return runs.read_index(spark, f"{work}/index").select(
        data.page_of("id").alias("page_id"),
        F.substring_index("id", "_", -1).alias("chunk_id"),
        _words(),
    )


@cache
def all_queries() -> dict:
    return {
        "q_scan_files": scan,
        "q_discover": discover_new,
        "q_optional_table": optional_tables,
        "q_safe_name": safe_name,
        "q_norm_path": norm_path,
        "q_author_names": author_names,
        "q_clean_text": clean_text,
        "q_clean_text_sql": clean_text_sql,
        "q_html_elements": html_elements,
        "q_markdown": markdown,
        "q_metadata": page_metadata,
        "q_chunks": build_chunks,
        "q_chunks_sql": chunks_sql,
        "q_pending": pending,
        "q_new_files": new_files,
        "q_exists": exists_many,
        "q_registered": registered,
        "q_listed": listed,
        "q_parsed_twice": parsed_twice,
        "q_reset": reset,
        "q_page_index": page_index,
        "q_changes": changed,
        "q_key_violations": key_violations,
        "q_embed": embedded,
        "q_sync": synced,
        "q_knn_embeddings": knn_embeddings,
        "q_top_k": top_k,
        "q_top_k_blocks": top_k_blocks,
        "q_top_k_filtered": top_k_filtered,
        "q_top_k_cells": top_k_cells,
        "q_top_k_probed": top_k_probed,
        "q_cells_followed": cells_followed,
        "q_probe_recall": probe_recall,
        "q_context": contexts,
        "q_prompts": prompts,
        "q_indexed_prompts": indexed_prompts,
        "q_cell_prompts": cell_prompts,
        "q_stream_parse": stream_parse,
        "q_stream_sync": stream_sync,
    }
