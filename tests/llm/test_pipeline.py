import random

import corpus_pipeline
from docpipe.llm.common import kept, settle

WORDS = [f"w{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]


def test_stages(spark, make_docs, sf_dir):
    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choices(WORDS, k=n))
    toxic = [" ".join(f"vile nasty {w} rotten" for w in prose(9).split()) for _ in range(60)]
    clean = [prose(60) for _ in range(150)]
    base = prose(120)
    near = [base, base, base.upper(), base.replace(base.split()[60], "other", 1)]
    item = prose(30)
    leaky = [f"{prose(10)} {item} {prose(10)}"]
    secret = [f"{prose(30)} token=abcdef123456 {prose(5)}"]
    odd = [None, ""]
    texts = toxic + clean + near + leaky + secret + odd
    docs = make_docs(texts)
    marks = [(k, 1, int(k < 60)) for k in range(210)]
    folder = sf_dir(
        documents=docs,
        labels=spark.createDataFrame(marks, "doc_id long, quality int, toxic int"),
        benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"),
    )
    table, left = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        table = kept(stage(spark, table, folder), "stage")
        left[name] = {r.doc_id for r in table.collect()}
        assert set(docs.columns) <= set(table.columns)
    names = [n for n, _ in corpus_pipeline.STAGES]
    everything = set(range(60, len(texts)))
    assert left[names[0]] == everything
    everything -= {211, 212, 213}
    assert left[names[1]] == everything
    everything -= {214}
    assert left[names[2]] == left[names[3]] == left[names[4]] == everything
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(rows) == everything
    assert rows[215].text == secret[0].replace("token=abcdef123456", "[SECRET]")
    assert rows[60].text == clean[0] and rows[216].text is None
    assert all(r.rate >= 0 for r in rows.values())


def test_no_documents(spark, make_docs, sf_dir):
    folder = sf_dir(
        documents=make_docs([]),
        labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
        benchmark=spark.createDataFrame([], "item_id long, text string"),
    )
    assert corpus_pipeline.run(spark, folder).collect() == []


def collections(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(bean.getCollectionCount() for bean in beans)


def test_executors_collect_garbage_between_stages(spark, monkeypatch):
    before = collections(spark)
    settle(spark)
    alone = collections(spark) - before
    # here the executors' JVM is the driver's too
    monkeypatch.setattr(spark.sparkContext, "master", "local-cluster[1,4,1024]")
    before = collections(spark)
    settle(spark)
    assert collections(spark) - before > alone >= 1
