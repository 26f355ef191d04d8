import os

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from docpipe import schemas
from docpipe.operators import chunks, embed, tables
from docpipe.operators.index import VectorIndex
from docpipe.plans import jobs
from docpipe.shared import shared_root
from docpipe.sources import files as sources_files
from docpipe.sources.files import discover, path_batches, scan_files
from docpipe.sources.tables import MissingTable, optional_table, read_table


def write(folder, name, body):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body)


@pytest.fixture
def files(tmp_path):
    for i in range(4):
        write(tmp_path, f"sub{i}/p{i}.html", f"<title>T{i}</title><p>page {i} words</p>")
    write(tmp_path, "top [1] {a}*?.html", "<title>Odd</title><p>odd name</p>")
    write(tmp_path, "notes.txt", "not a page")
    return tmp_path


def names(df, column="doc_path"):
    return sorted(r[0].rsplit("/", 1)[1] for r in df.select(column).collect())


def test_scan_and_discover(spark, files):
    found = discover(spark, str(files), "*.html")
    assert names(found, "path") == ["p0.html", "p1.html", "p2.html", "p3.html", "top [1] {a}*?.html"]
    assert names(scan_files(spark, [f"{files}/sub1", f"{files}/sub2"]), "path") == ["p1.html", "p2.html"]
    # The listing does not read the files.
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()


def test_discover_cuts_after_known_files_left(spark, files):
    known = discover(spark, str(files), "*.html", max_files=2).select(
        F.col("path").alias("doc_path")
    )
    left = discover(spark, str(files), "*.html", known, max_files=2)
    assert names(left, "path") == ["p2.html", "p3.html"]
    assert discover(spark, str(files), "*.html", known, max_files=0).count() == 3


def test_path_batches(spark):
    batches = list(path_batches(spark.range(10).select(F.col("id").cast("string")), 4))
    assert [len(b) for b in batches] == [4, 4, 2]
    assert sorted(sum(batches, [])) == [str(i) for i in range(10)]


def test_ingest_gets_past_the_limit_and_reruns_add_nothing(spark, db, files):
    table = f"{db}.source_docs"
    for n in (2, 4, 5, 5):
        jobs.ingest(spark, str(files), table, "*.html", max_files=2)
        assert spark.table(table).count() == n
    assert spark.table(table).where("title IS NOT NULL").isEmpty()


def test_ingest_with_metadata(spark, db, files):
    table = f"{db}.source_docs"
    jobs.ingest(spark, str(files), table, "*.html", read_metadata=True)
    rows = {r.title: r.summary for r in spark.table(table).collect()}
    assert rows["Odd"] == "odd name" and rows["T3"] == "page 3 words" and len(rows) == 5


def test_files_to_prompts(spark, db, files, monkeypatch):
    monkeypatch.setattr(jobs, "BATCH_FILES", 2)
    source, parsed, chunk_table = (f"{db}.{t}" for t in ("source_docs", "parsed_docs", "chunks"))
    index = VectorIndex(spark, f"{db}.idx")
    for _ in range(2):
        jobs.ingest(spark, str(files), source, "*.html", read_metadata=True)
        jobs.parse_pending(spark, source, parsed)
        jobs.index_chunks(spark, parsed, source, chunk_table, index)
        assert spark.table(parsed).count() == 5
        assert spark.table(chunk_table).count() == 5
        assert index.read().count() == 5
    write(files, "late.html", "<p>a late page of words</p>")
    jobs.ingest(spark, str(files), source, "*.html", read_metadata=True)
    jobs.parse_pending(spark, source, parsed)
    jobs.index_chunks(spark, parsed, source, chunk_table, index)
    assert index.read().count() == 6

    asked = spark.createDataFrame(
        [("q1", "odd name"), ("q2", "late"), ("q3", "...")], "qid string, question string"
    )
    answers = jobs.answer_prompts(asked, index.read(), spark.table(chunk_table), k=1).collect()
    assert {(r.qid, r.context) for r in answers} == {
        ("q1", "odd name"),
        ("q2", "a late page of words"),
    }
    # written to a folder, nothing else is left on shared storage
    root = shared_root(spark)
    before = set(os.listdir(root))
    out = jobs.answer_prompts(asked, index.read(), spark.table(chunk_table), k=1, out=f"{files}/answers")
    assert sorted(out.collect()) == sorted(answers) and set(os.listdir(root)) == before
    only = jobs.answer_prompts(
        asked, index.read(), spark.table(chunk_table), k=1, filters={"title": ["T1"]}
    )
    assert {r.context for r in only.collect()} == {"page 1 words"}


def test_no_text_is_shuffled_from_parsed_documents_to_chunks(spark, db, files):
    source, parsed = f"{db}.source_docs", f"{db}.parsed_docs"
    jobs.ingest(spark, str(files), source, "*.html", read_metadata=True)
    jobs.parse_pending(spark, source, parsed)
    own = tables.own_session(spark)
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = chunks.build_stored(own, parsed, source)
    plan = plan_of(rows.repartition(tables.buckets_of(spark, parsed), "doc_path"))
    assert "Exchange" not in plan and "parsed_content" in plan and "Join" in plan
    # a table of another kind is still joined, by its paths without `dbfs:`
    spark.table(parsed).withColumn("path", F.concat(F.lit("dbfs:"), "path")).write.saveAsTable(f"{db}.plain")
    assert chunks.build_stored(own, f"{db}.plain", source).where("title IS NULL").isEmpty()


def test_catalogue_by_file_id(spark, db, files):
    source, parsed, catalogue = (f"{db}.{t}" for t in ("source_docs", "parsed_docs", "catalogue"))
    jobs.prepare(spark, source, parsed, catalogue)
    assert all(spark.table(t).isEmpty() for t in (source, parsed, catalogue))
    pages = [("i1", "a.html", f"{files}/sub0/p0.html"), ("i2", "b.html", f"{files}/sub1/p1.html")]
    for n in (1, 2, 2):
        jobs.ingest_listing(spark, listing(spark, *pages[:n]), f"{files}/copies", source)
        jobs.fill_catalogue(spark, source, catalogue)
        assert {r.id: r.title for r in spark.table(catalogue).collect()} == {f"i{k + 1}": f"T{k}" for k in range(n)}
        assert spark.table(catalogue).count() == n


def test_missing_tables(spark, db):
    with pytest.raises(MissingTable):
        read_table(spark, f"{db}.absent")
    assert optional_table(spark, f"{db}.absent") is None
    with pytest.raises(MissingTable):
        jobs.index_chunks(
            spark, f"{db}.absent", f"{db}.none", f"{db}.chunks", VectorIndex(spark, f"{db}.i")
        )
    assert not spark.catalog.tableExists(f"{db}.chunks")
    with pytest.raises(MissingTable):
        jobs.parse_pending(spark, f"{db}.absent", f"{db}.parsed")


def test_chunks_without_registry(spark, db, files):
    source, parsed = f"{db}.source_docs", f"{db}.parsed_docs"
    jobs.ingest(spark, str(files), source, "*.html")
    jobs.parse_pending(spark, source, parsed)
    index = VectorIndex(spark, f"{db}.idx", dim=embed.DIM)
    jobs.index_chunks(spark, parsed, f"{db}.no_registry", f"{db}.chunks", index)
    assert spark.table(f"{db}.chunks").where("title IS NULL AND authors IS NULL").count() == 5


def test_a_missing_file_is_passed_over_and_reported(spark, db, files):
    source, parsed, missing = (f"{db}.{t}" for t in ("source_docs", "parsed_docs", "missing"))
    jobs.ingest(spark, str(files), source, "*.html")
    (files / "sub1/p1.html").unlink()
    jobs.parse_pending(spark, source, parsed, missing)
    assert spark.table(parsed).count() == 4
    assert [(r.path.rsplit("/", 1)[1], r.error) for r in spark.table(missing).collect()] == [
        ("p1.html", "file is gone")
    ]
    write(files, "sub1/p1.html", "<p>back</p>")
    jobs.parse_pending(spark, source, parsed, missing)
    assert spark.table(parsed).count() == 5 and spark.table(missing).count() == 1


def test_files_are_read_where_their_bucket_is_written(spark, db, files, monkeypatch):
    source, parsed = f"{db}.source_docs", f"{db}.parsed_docs"
    monkeypatch.setattr(jobs, "path_batches", lambda paths, size: iter(() if paths.isEmpty() else (1 / 0,)))
    jobs.ingest(spark, str(files), source, "*.html", read_metadata=True)
    jobs.parse_pending(spark, source, parsed)
    bucket = F.pmod(F.hash("path"), F.lit(tables.buckets_of(spark, parsed)))
    placed = spark.table(parsed).select(bucket.alias("b"), F.input_file_name().alias("f")).distinct()
    rows = placed.withColumn("named", F.regexp_extract("f", r"_(\d+)\.c\d+", 1).cast("int")).collect()
    assert rows and all(r.b == r.named for r in rows)
    assert len({r.f for r in rows}) == len({r.b for r in rows})


def test_files_of_other_stores_are_read_by_spark(spark, db, files, monkeypatch):
    source, parsed = f"{db}.source_docs", f"{db}.parsed_docs"
    monkeypatch.setattr(jobs, "opened_by_tasks", lambda path: F.lit(False))
    jobs.ingest(spark, str(files), source, "*.html", read_metadata=True)
    jobs.parse_pending(spark, source, parsed)
    assert spark.table(parsed).count() == 5
    assert spark.table(source).where("title = 'Odd'").count() == 1


def test_read_listed_hands_on_a_few_at_a_time(spark, files, monkeypatch):
    monkeypatch.setattr(sources_files, "HELD_BYTES", 50)
    paths = [f"file:{files}/sub{i}/p{i}.html" for i in range(4)] + [f"{files}/none", f"file://{files}/notes.txt"]
    df = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], "path string, n int").coalesce(1)
    got = {r.n: (r.content, r.error) for r in sources_files.read_listed(df).collect()}
    assert got[0] == (b"<title>T0</title><p>page 0 words</p>", None)
    assert got[4] == (None, "file is gone") and got[5] == (b"not a page", None) and len(got) == 6


def listing(spark, *rows):
    return spark.createDataFrame(rows, schemas.LISTING)


def test_ingest_of_a_listing(spark, db, files, tmp_path):
    source, folder = f"{db}.source_docs", f"{tmp_path}/copies"
    first = [
        ("i1", "a 'quoted' \"name\".html", f"{files}/sub0/p0.html"),
        ("i2", "same.html", f"{files}/sub1/p1.html"),
        ("i3", "same.html", f"{files}/sub2/p2.html"),
        ("i4", "in/a/folder.html", f"{files}/sub3/p3.html"),
        ("i5", "gone.html", f"{files}/none.html"),
        (None, "no id.html", f"{files}/sub0/p0.html"),
    ]
    jobs.ingest_listing(spark, listing(spark, *first), folder, source, max_files=2)
    assert {r.source_file_id for r in spark.table(source).collect()} == {"i1", "i2"}
    for _ in range(2):
        jobs.ingest_listing(spark, listing(spark, *first, first[0]), folder, source)
    rows = {r.source_file_id: (r.doc_path.rsplit("/", 1)[1], r.title) for r in spark.table(source).collect()}
    assert rows == {
        "i1": ("a quoted name.html", "T0"),
        "i2": ("same.html", "T1"),
        "i3": ("i3-same.html", "T2"),
        "i4": ("in_a_folder.html", "T3"),
    }
    assert spark.table(source).count() == 4
    # the copies are what is parsed
    jobs.parse_pending(spark, source, f"{db}.parsed_docs")
    assert spark.table(f"{db}.parsed_docs").count() == 4
    # it comes back under its id, though its name is new
    write(files, "none.html", "<title>Back</title>")
    jobs.ingest_listing(spark, listing(spark, ("i5", "same.html", f"{files}/none.html")), folder, source)
    assert spark.table(source).where("title = 'Back'").first().doc_path.endswith("/i5-same.html")


def test_another_dimension_raises(spark, db):
    idx = VectorIndex(spark, f"{db}.idx", dim=512)
    schema = "doc_path string, id string, text string, title string, authors string"
    chunks.save(spark.createDataFrame([("d", "a", "x", "t", "w")], schema), f"{db}.chunks", idx.buckets)
    idx.sync(f"{db}.chunks")
    asked = spark.createDataFrame([("q", "x")], "qid string, question string")
    table = spark.table(f"{db}.chunks")
    with pytest.raises(ValueError, match="512"):
        jobs.answer_prompts(asked, idx.read(), table, dim=256)
    assert [r.context for r in jobs.answer_prompts(asked, idx.read(), table).collect()] == ["x"]


def test_listed_files_are_read_by_as_many_tasks_as_a_shuffle_has(spark, files, db, monkeypatch):
    """Not by one for every few files, as a listing has."""
    dealt = []
    read = jobs.read_listed
    monkeypatch.setattr(
        jobs, "read_listed", lambda paths, **more: dealt.append(paths.rdd.getNumPartitions()) or read(paths, **more)
    )
    table = f"{db}.source_docs"
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 40)
    try:
        jobs.ingest(spark, str(files), table, "*.html", read_metadata=True)
        jobs.ingest(spark, str(files), table, "*.html", read_metadata=True)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert dealt == [tables.default_buckets(spark)] * 2
    known = {r.doc_path.rsplit("/", 1)[-1] for r in spark.table(table).collect()}
    assert known == {f.name for f in files.rglob("*.html")}
