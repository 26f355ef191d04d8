import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Extra columns named like those that operators add or use inside.
CLASHES = (
    "score spans leaks removed kept rate copies domain n_tokens n_bytes over_limit host PATH verdict "
    "n_words nearest ka kb n g s keys short root least node __copies __id"
).split()


@pytest.fixture
def make_docs(spark):
    def make(texts, ids=None, clash=False, langs=None):
        ids = range(len(texts)) if ids is None else ids
        langs = langs or ["en"] * len(texts)
        rows = [
            (i, t, lang, "src0", None if t is None else len(t))
            for i, t, lang in zip(ids, texts, langs, strict=True)
        ]
        docs = spark.createDataFrame(rows, DOC_SCHEMA)
        if clash:
            docs = docs.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHES])
        return docs

    return make


@pytest.fixture
def sf_dir(tmp_path):
    """Write tables as the queries read them."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
