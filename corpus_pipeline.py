"""The corpus pipeline: five stages over the whole documents table, each written and read again."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.llm import decontaminate, mixing, parity_join, secrets, toxicity
from docpipe.llm.common import fresh, kept, settle, table

#: Near copies share this percentage of their shingles of so many words.
SHINGLE, PERCENT = 5, 80


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier, learnt from the labels, scores below a half."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    name = fresh(docs, "score")
    return toxicity.score(docs, model, name=name).where(F.col(name) < 0.5).drop(name)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similar shingles join, the one with the least doc_id."""
    return parity_join.one_of_each(docs, SHINGLE, PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the rate at which each is to be used."""
    labelled = mixing.labelled_domains(docs, table(spark, sf_dir, "labels"))
    return mixing.mix(docs, labelled, mixing.TARGETS)


STAGES = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
]

#: SQL can't express a learnt classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; what each returns is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = kept(docs, "pipeline-stage")
            settle(spark)
    return docs
