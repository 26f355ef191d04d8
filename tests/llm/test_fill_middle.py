"""Operator 12 against plain regular expressions and exact round trips."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from docpipe.llm import fill_middle as fm

TEXT = st.text(st.sampled_from("abZ z19\n<P>SM中é😀"), max_size=60)


def units(text):
    return re.findall(r"[A-Za-z]+|[^A-Za-z]", text)


@settings(max_examples=150, deadline=None, derandomize=True)
@given(st.lists(TEXT, min_size=1, max_size=8))
def test_cuts_equal_those_of_lists(texts):
    for doc_id, (text, row) in enumerate(zip(texts, fm.formed(list(range(len(texts))), texts), strict=True)):
        n, form, prefix, middle, output = row
        own = units(text)
        assert n == len(own)
        h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
        h = [int(h[k : k + 8], 16) for k in (0, 8, 16, 24)]
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        if not text or any(m in text for m in fm.MARKS) or h[2] % 100 >= 90:
            assert (form, prefix, middle, output) == ("plain", None, None, text)
        else:
            parts = "".join(own[:a]), "".join(own[a:b]), "".join(own[b:])
            assert (prefix, middle) == (len(parts[0]), len(parts[1]))
            spm = h[3] % 100 < 20
            want = "<S>{2}<P>{0}<M>{1}" if spm else "<P>{0}<S>{2}<M>{1}"
            assert (form, output) == ("spm" if spm else "psm", want.format(*parts))
        assert fm.restored(output, form) == text


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 7), max_size=300))
def test_ranks_equal_counts(numbers):
    numbers = np.array(numbers, np.uint8)
    matrix = fm.WaveletMatrix(numbers, 3)
    places = np.arange(len(numbers) + 1)
    for c in range(8):
        want = np.concatenate([[0], np.cumsum(numbers == c)])
        assert (matrix.rank(c, places) == want).all()


def test_marks_at_the_cuts_are_told_apart():
    for text in ("<<", "<S", "a<", "P><S", "<P", "M><"):
        for one in range(len(text) + 1):
            for two in range(one, len(text) + 1):
                for form in ("psm", "spm"):
                    assert fm.restored(fm.joined(text, form, one, two), form) == text


def test_rows_of_every_kind(spark, make_docs, sf_dir):
    long = "word 12, " * 400_000
    texts = [None, "", " ", "abc", "a b", "<P>", long, "same text", "same text"]
    docs = make_docs(texts, ids=[1, 2, 3, None, 5, 6, 7, 8, 8], clash=True)
    rows = fm.query(spark, sf_dir(documents=docs)).collect()
    assert len(rows) == len(texts)
    sha = [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
    assert sorted(r.restored_sha256 for r in rows) == sorted(sha)
    by_text = {r.restored_sha256: r for r in rows}
    assert by_text[sha[0]].form == "plain" and by_text[sha[5]].form == "plain"
    assert by_text[sha[6]].n == len(units(long)) and by_text[sha[3]].n == 1
    same = [r for r in rows if r.doc_id == 8]
    assert len(same) == 2 and same[0] == same[1]


def test_own_columns_do_not_clash_and_empty_tables_stay_empty(spark, make_docs):
    docs = make_docs(["one two"]).selectExpr("*", "'x' AS FIM_text")
    names = {}
    out = fm.fill_middle(docs, names)
    assert names["fim_text"] == "fim_text_"
    row = out.first()
    assert row["FIM_text"] == "x" and fm.restored(row["fim_text_"], row["fim_form"]) == "one two"
    assert fm.fill_middle(make_docs([])).collect() == []
