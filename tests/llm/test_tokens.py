import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from docpipe.llm import tokens

PATH = public_tokenizers.path(tokens.MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ENCODER = tokens.Encoder(PATH)


@settings(max_examples=200, deadline=None)
@given(
    st.one_of(st.text(max_size=300), st.text("ab \n▁é日<s>/", max_size=300), st.text(" ", max_size=200)),
    st.integers(8, 64), st.integers(1, 16),
)
def test_chunks_give_the_library_s_count(text, chunk, overlap):
    assert tokens.count(text, ENCODER, chunk, overlap) == len(LIBRARY.encode(text))


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9_000, " " * 9_000, "é" * 9_000, "x\n" * 6_000, "ha ho " * 4_000])
def test_runs_without_a_boundary(text):
    assert tokens.count(text, ENCODER, 512, 16) == len(LIBRARY.encode(text))


TEXTS = [None, "", " ", "</s><s> [INST]", "▁a▁", "日本語\0x", "word " * 5_000, "z" * 30_000]


def test_query(spark, make_docs, sf_dir):
    ids = [*range(len(TEXTS)), None, 6]
    got = tokens.query(spark, sf_dir(documents=make_docs([*TEXTS, "a", TEXTS[6]], ids, clash=True))).collect()
    assert len(got) == len(ids)
    for r in got:
        text = (TEXTS[r.doc_id] if r.doc_id is not None else "a") or ""
        n = len(LIBRARY.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)
    assert tokens.count_tokens(make_docs([]), PATH).collect() == []
