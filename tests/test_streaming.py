import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docpipe import schemas
from docpipe.operators import parse as parse_operator
from docpipe.streaming import runs


@pytest.fixture
def work(tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    return tmp_path


def parse(spark, work):
    runs.parse_new_files(
        spark, f"{work}/in", f"{work}/parsed", f"{work}/log1", "*.html", max_files=1
    )
    return runs.read_batches(spark, f"{work}/parsed", schemas.PARSED_DOCS)


def follow(spark, work, log="log3"):
    """The chunks of all parsed documents into the index, and its rows."""
    runs.chunk_new_docs(spark, f"{work}/parsed", f"{work}/chunks", f"{work}/log2")
    runs.sync_index(spark, f"{work}/chunks", f"{work}/index", f"{work}/{log}")
    rows = runs.read_index(spark, f"{work}/index").collect()
    return {(r.id.rsplit("/", 1)[1], tuple(r.vec)) for r in rows}


def sizes(state):
    return {(name, len(vec)) for name, vec in state}


def parsed_version(spark, work, path, texts, day, name):
    """A version of a document, parsed on some day, as another writer adds it."""
    elements = F.array(*[
        F.struct(F.lit(str(i)).alias("id"), F.lit("text").alias("type"), F.lit(t).alias("content"))
        for i, t in enumerate(texts)
    ]) if texts else F.from_json(F.lit("[]"), "array<struct<id:string,type:string,content:string>>")
    row = spark.range(1).select(
        F.lit(path).alias("path"),
        parse_operator.to_json(elements).alias("parsed_content"),
        F.lit(datetime(2024, 1, day)).alias("processed"),
    )
    row.write.parquet(f"{work}/parsed/{name}")


def test_each_run_takes_only_new_files(spark, work):
    (work / "in/a.html").write_text("<p>one</p>")
    (work / "in/skip.txt").write_text("<p>no</p>")
    assert parse(spark, work).count() == 1
    (work / "in/deep/b.html").write_text("<p>two</p>")
    (work / "in/c.html").write_text("<p>three</p>")
    assert parse(spark, work).count() == 3
    assert parse(spark, work).count() == 3


def test_index_follows_the_files(spark, work):
    (work / "in/a.html").write_text("<h1>x</h1><p>one</p><p>two words</p>")
    parse(spark, work)
    assert sizes(follow(spark, work)) == {("a.html_1", 1), ("a.html_2", 2)}
    (work / "in/b.html").write_text("<p>three words here</p>")
    parse(spark, work)
    state = follow(spark, work)
    assert sizes(state) == {("a.html_1", 1), ("a.html_2", 2), ("b.html_0", 3)}
    batches = len(list((work / "index").iterdir()))
    assert follow(spark, work) == state
    assert len(list((work / "index").iterdir())) == batches
    # A stream that lost its log hands over old batches again.
    assert follow(spark, work, "log4") == state


def test_a_shorter_version_deletes_chunks(spark, work):
    parsed_version(spark, work, "/d/a", ["one", "two", "three"], 1, "v1")
    parsed_version(spark, work, "/d/b", ["other"], 1, "w1")
    assert sizes(follow(spark, work)) == {("a_0", 1), ("a_1", 1), ("a_2", 1), ("b_0", 1)}
    parsed_version(spark, work, "/d/a", ["one", "two more"], 3, "v3")
    state = follow(spark, work)
    assert sizes(state) == {("a_0", 1), ("a_1", 2), ("b_0", 1)}
    # a version from between comes late, and all batches come again
    parsed_version(spark, work, "/d/a", ["late"] * 5, 2, "v2")
    assert follow(spark, work) == state
    assert follow(spark, work, "log4") == state
    # nothing is left, then it grows again
    parsed_version(spark, work, "/d/a", [], 4, "v4")
    assert sizes(follow(spark, work)) == {("b_0", 1)}
    parsed_version(spark, work, "/d/a", ["back"], 5, "v5")
    assert sizes(follow(spark, work)) == {("a_0", 1), ("b_0", 1)}


def test_versions_of_one_batch(spark, work):
    for day, texts in ((1, ["a", "b", "c"]), (3, ["z"]), (2, ["x", "y"])):
        parsed_version(spark, work, "/d/a", texts, day, f"v{day}")
    state = follow(spark, work)
    assert sizes(state) == {("a_0", 1)}
    assert follow(spark, work) == state


def test_latest_version_of_a_chunk_wins(spark):
    def row(id_, text, day, deleted=False):
        return ("/a", "1", text, id_, "t", None, 0, datetime(2024, 1, day), deleted)

    df = spark.createDataFrame(
        [row("a", "old", 1), row("a", "new", 2), row("b", "only", 1), row("c", "x", 1), row("c", None, 2, True)],
        runs.STREAM_CHUNKS,
    )
    got = {tuple(r) for r in runs.latest_by_id(df).select("id", "text", "title", "deleted").collect()}
    assert got == {("a", "new", "t", False), ("b", "only", "t", False), ("c", None, "t", True)}


def test_stream_joins_the_registry(spark, work):
    (work / "in/a.html").write_text("<p>one</p>")
    path = parse(spark, work).first().path
    source = spark.createDataFrame(
        [(path, "f", "Title", ["A"], None, None, None, None, None)], schemas.SOURCE_DOCS
    )
    runs.chunk_new_docs(spark, f"{work}/parsed", f"{work}/chunks", f"{work}/log2", source)
    row = runs.read_batches(spark, f"{work}/chunks", runs.STREAM_CHUNKS).first()
    assert (row.title, row.authors, row.text) == ("Title", "A", "one")


def test_files_with_old_dates_are_read(spark, work):
    (work / "in/a.html").write_text("<p>one</p>")
    assert parse(spark, work).count() == 1
    late = work / "in/late.html"
    late.write_text("<p>late</p>")
    month_ago = late.stat().st_mtime - 30 * 86_400
    os.utime(late, (month_ago, month_ago))
    assert parse(spark, work).count() == 2


def test_new_checkpoint_takes_new_and_old_files(spark, work):
    (work / "in/a.html").write_text("<p>one</p>")
    parse(spark, work)
    assert {n for n, _ in follow(spark, work, "log3")} == {"a.html_0"}
    (work / "in/b.html").write_text("<p>two</p>")
    parse(spark, work)
    assert {n for n, _ in follow(spark, work, "log4")} == {"a.html_0", "b.html_0"}


def test_a_batch_of_small_files_is_a_few_files(spark, work):
    """Not one for each task of the scan."""
    for i in range(9):
        (work / "in" / f"p{i}.html").write_text(f"<p>page {i}</p>")
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 40)
    try:
        runs.parse_new_files(spark, f"{work}/in", f"{work}/parsed", f"{work}/log1", "*.html")
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    written = list((work / "parsed").rglob("*.parquet"))
    assert 0 < len(written) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert runs.read_batches(spark, f"{work}/parsed", schemas.PARSED_DOCS).count() == 9
