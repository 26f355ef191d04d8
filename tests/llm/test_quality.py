import random

import numpy as np

from docpipe.llm import quality as q

RNG = random.Random(3)
EN = "the of and to in a is that it for was on".split() + [f"w{chr(97 + i)}{chr(97 + j)}ord" for i in range(9) for j in range(9)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(EN) for _ in range(n)) + "."


def brute(text):
    words, now = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            if now:
                words.append(now)
            now = ""
        else:
            now += c
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


TEXTS = [
    None, "", "   \n\t", "one two three", "a b c a b c", "a b c d\na b c d\n \n \n", "x\u00a0y\u2028z \x1c w",
    "same same same same same same", prose(80), prose(80) + "\n" + "#$% <> |" * 5, "go on " * 60,
    "\n".join(["line of text"] * 20), prose(30_000), "é ü 日本 " * 40,
]


def test_counts_equal_brute_force(spark, make_docs, sf_dir):
    ids = [*range(len(TEXTS)), None, 8]
    folder = sf_dir(documents=make_docs([*TEXTS, TEXTS[8], TEXTS[8]], ids, clash=True))
    got = q.query(spark, folder).collect()
    assert len(got) == len(ids)
    by_id = {r.doc_id: r for r in got}
    for k, text in enumerate(TEXTS):
        r = by_id[k]
        if text is None or len(text) < 100_000:
            want = brute(text or "")
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, k
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert by_id[12].n_words == 30_000


def test_distance_tells_prose_from_symbols(spark, make_docs):
    good = [prose(200) for _ in range(30)]
    bad = [" ".join(f"{RNG.random():.9f}|#$" for _ in range(200)) for _ in range(4)]
    got = {r.doc_id: r for r in q.measure(make_docs(good + bad)).collect()}
    assert all(got[k].kept for k in range(30))
    assert not any(got[k].kept for k in range(30, 34))
    assert got[0].nearest == "en" and 0 <= got[0].char_distance < got[30].char_distance <= 1


def test_distance_is_the_plain_formula():
    p, r = np.array([2, 0, 6]), np.array([[0.25, 0.25, 0.5]])
    a, m = p / 8, (p / 8 + r[0]) / 2
    plain = sum(x * np.log2(x / y) for x, y in zip(a, m, strict=True) if x) / 2
    plain += sum(x * np.log2(x / y) for x, y in zip(r[0], m, strict=True) if x) / 2
    assert np.isclose(q.distance(p, r)[0], np.sqrt(plain))
    assert q.distance(np.array([1, 1, 2]), r)[0] < 1e-6


def test_no_reference(spark, make_docs):
    rows = q.measure(make_docs([prose(80), None], langs=[None, "xx"])).collect()
    assert [(r.kept, r.nearest) for r in sorted(rows, key=lambda r: r.doc_id)] == [(True, None), (False, None)]
    assert q.measure(make_docs([])).collect() == []
