import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from docpipe.llm import decontaminate as dc
from docpipe.llm.common import Rolling, shingle_hashes

WORD = re.compile("[0-9a-z_\u00c0-\u1fff\u2040-\U0010ffff]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


WORDS = [f"w{k}" for k in range(300)]
LETTERS = dc.Letters()


def corpus(seed=1):
    rng = random.Random(seed)
    prose = lambda n: rng.choices(WORDS, k=n)
    items = [prose(rng.randint(15, 60)) for _ in range(12)] + [["a1", "b1", "c1"], ["solo"], items_short(rng)]
    docs = []
    for k in range(60):
        words = prose(rng.randint(5, 200))
        if k % 3 == 0:
            item = list(rng.choice(items))
            for _ in range(k % 2 * rng.randint(0, 3)):  # some are changed, past the limit or not
                item[rng.choice((0, 1, -1, len(item) // 2))] = "other"
            at = rng.randrange(len(words))
            words[at:at] = item
        docs.append(" ".join(words))
    return docs, [" ".join(i) for i in items]


def items_short(rng):
    return rng.choices(WORDS, k=5)


def brute(text, items):
    """All windows of each item's size, weighted Jaccard of bags of shingles."""
    def bag(words, size):
        return Counter(tuple(words[k : k + size]) for k in range(len(words) - size + 1))

    split = [WORD.findall(lower(t)) for t in items]
    weight = Counter()
    for words in split:
        if words:
            weight.update(set(bag(words, min(5, len(words)))))
    words = WORD.findall(lower(text))
    found = {}
    for number, item in enumerate(split):
        size = min(5, len(item))
        if not item:
            continue
        want = bag(item, size)
        for k in range(len(words) - len(item) + 1):
            have = bag(words[k : k + len(item)], size)
            names = set(want) | set(have)
            w = {n: 1 / max(1, weight[n]) for n in names}
            likeness = sum(min(want[n], have[n]) * w[n] for n in names) / sum(max(want[n], have[n]) * w[n] for n in names)
            if likeness >= 0.8 and likeness > found.get(number, (0, 0))[0] + 1e-12:
                found[number] = (likeness, k)
    return {n: (k, len(split[n]), round(v, 9)) for n, (v, k) in found.items()}


@pytest.mark.parametrize("block", [50_000, 4])
def test_equals_all_windows(spark, make_docs, block):
    texts, items = corpus()
    texts += [None, "", "solo", "W1", texts[0]]
    items += [None, "", "!!", items[0]]
    bench = spark.createDataFrame(list(enumerate(items)) + [(None, items[1])], "item_id long, text string")
    got = dc.find_leaks(make_docs(texts, clash=True), bench, block).collect()
    assert len(got) == len(texts)
    some = 0
    for r in got:
        want = brute(texts[r.doc_id], items)
        # weights are those of the items of a block, so only one block has the very numbers
        if block > 100:
            assert {x.item_id: (x.start, x.n_words, round(x.similarity, 9)) for x in r.leaks} == want
        exact = {n for n, x in want.items() if x[2] == 1}
        assert exact <= {x.item_id for x in r.leaks}
        some += len(want)
    assert some > 12


def test_query_and_stage(spark, make_docs, sf_dir):
    item = " ".join(WORDS[:30])
    docs = make_docs([f"x {item} y", "clean " + " ".join(WORDS[60:120]), None, item.upper() + "!"], [4, 5, 6, None], clash=True)
    bench = spark.createDataFrame([(1, item)], "item_id int, text string")
    got = dc.query(spark, sf_dir(documents=docs, benchmark=bench)).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.start, r.n_words, r.similarity) for r in got) == [(0, 1, 0, 30, 1.0), (4, 1, 1, 30, 1.0)]
    left = dc.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [5, 6]
    assert dc.decontaminate(docs, bench.limit(0)).count() == 4
    assert dc.decontaminate(make_docs([]), bench).collect() == []


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**64, 300, dtype=np.uint64)
    index = dc.HammingIndex(prints, 23)
    for k in range(200):
        value = prints[k % 300]
        for bit in rng.choice(64, rng.integers(0, 26), replace=False):
            value ^= np.uint64(1) << np.uint64(bit)
        want = np.flatnonzero(np.bitwise_count(prints ^ value) <= 23)
        assert index.within(value).tolist() == want.tolist()


@given(st.lists(st.text("aB_1 \u00a0\u00b7\u00e9\u2019\u2028\u2603\U0001f600-", max_size=12), max_size=5))
def test_words(texts):
    raw = [t.encode() for t in texts]
    starts = np.cumsum([0] + [len(r) for r in raw])
    words, owner = dc.split_words(Rolling(), np.frombuffer(b"".join(raw), np.uint8), starts)
    want = [(k, w) for k, t in enumerate(texts) for w in WORD.findall(lower(t))]
    assert owner.tolist() == [k for k, _ in want]
    names = {}
    for h, (_, w) in zip(words.tolist(), want, strict=True):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_fingerprints_of_windows_are_those_of_the_shingles():
    shingles = shingle_hashes(dc.words_of("a b c d e f g h i j k l m", Rolling()), 5)
    weights = np.linspace(0.1, 1, len(shingles))
    runs = dc.fingerprints(shingles, weights, 4)
    for k in range(len(shingles) - 3):
        assert runs[k] == dc.fingerprints(shingles[k : k + 4], weights[k : k + 4], 4)[0]


@given(st.lists(st.text("aB_1 \u00a0\u00aa\u00b2\u00b5\u00b7\u00bd\u00c9\u00e9\u00d7\u0130\u0301\u032a\u03a3\u03c3\u1e9e\u20ac\u212a\u2019\u2028\u2603\u3000\u3001\u4e2d\U00010400\U0001f600-", max_size=12), max_size=5))
def test_words_by_unicode(texts):
    raw = [t.encode() for t in texts]
    starts = np.cumsum([0] + [len(r) for r in raw])
    folded = LETTERS.fold(np.frombuffer(b"".join(raw), np.uint8), starts)
    words, owner = dc.split_words(Rolling(), *folded)
    want = [(k, w) for k, t in enumerate(texts) for w in re.findall(r"\w+", t.lower())]
    assert owner.tolist() == [k for k, _ in want]
    names = {}
    for h, (_, w) in zip(words.tolist(), want, strict=True):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_words_of_every_character():
    texts = [chr(c) + "x" + chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    raw = "\n".join(texts).encode()
    words = dc.split_words(Rolling(), *LETTERS.fold(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))[0]
    want = re.findall(r"\w+", "\n".join(texts).lower())
    assert len(words) == len(want) and len(set(words.tolist())) == len(set(want))


def test_items_in_other_case_and_between_marks(spark, make_docs):
    item = "Überall grüne Ängste, Élan École Ñandú Čapek Straße Σοφία ΛΟΓΟΣ " + " ".join(WORDS[:30])
    texts = [item.lower(), item.upper().replace("STRASSE", "Straße"), item.replace(" ", "\u3000"), item.replace(" ", " \u20ac\U0001f600"), item.replace(" ", "\u3001")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = dc.find_leaks(make_docs(texts), bench).collect()
    assert [[(x.item_id, x.similarity) for x in r.leaks] for r in got] == [[(1, 1.0)]] * len(texts)


def weighted(text, items):
    """As `brute`, with weights by different texts of items, and the mean of the item's for shingles it has not."""
    def bag(words, size):
        return Counter(tuple(words[k : k + size]) for k in range(len(words) - size + 1))

    split = [re.findall(r"\w+", (t or "").lower()) for t in items]
    weight = Counter()
    for words in {tuple(s) for s in split if s}:
        weight.update(set(bag(words, min(5, len(words)))))
    words = re.findall(r"\w+", (text or "").lower())
    found = {}
    for number, item in enumerate(split):
        size, want = min(5, len(item)), bag(item, min(5, len(item)))
        mean = sum(n / weight[x] for x, n in want.items()) / max(1, want.total())
        for k in range(len(words) - len(item) + 1 if item else 0):
            have = bag(words[k : k + len(item)], size)
            w = {x: 1 / weight[x] if x in want else mean for x in set(want) | set(have)}
            likeness = sum(min(want[x], have[x]) * w[x] for x in w) / sum(max(want[x], have[x]) * w[x] for x in w)
            if likeness >= 0.8 and likeness > found.get(number, (0, 0))[0] + 1e-12:
                found[number] = (likeness, k)
    return {n: (k, len(split[n]), round(v, 9)) for n, (v, k) in found.items()}


def test_repeats_templates_and_blocks(spark, make_docs):
    rng = random.Random(5)
    prose = lambda n: rng.choices(WORDS, k=n)
    frame = prose(48)
    items = [prose(60)] * 2 + [prose(200)] * 10 + [prose(6) + frame + prose(6) for _ in range(5)]
    items += [prose(rng.randint(20, 50)) for _ in range(3)]
    texts, firsts = [], [k for k, item in enumerate(items) if item not in items[:k]]
    for item in (items[k] for k in firsts):
        for places in ((), (len(item) // 2,), (0, len(item) // 2), (3, 15)):
            text = list(item)
            for place in places:
                text[place] = "other"
            texts.append(" ".join(prose(rng.randint(0, 9)) + text + prose(rng.randint(0, 9))))
    items = [" ".join(i) for i in items]
    items[1] = items[1].upper()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = [weighted(t, items) for t in texts]
    for block in (50_000, 7):
        rows = dc.find_leaks(make_docs(texts), bench, block).collect()
        got = {r.doc_id: {x.item_id: (x.start, x.n_words, round(x.similarity, 9)) for x in r.leaks} for r in rows}
        assert [got[k] for k in range(len(texts))] == want
    # one word replaced in the middle of 60 or 200; shorter items may fall under the limit
    assert [k for place, k in enumerate(firsts) if k < 17 and k not in got[4 * place + 1]] == []


def test_documents_shorter_than_the_item(spark, make_docs):
    words = [f"v{k}" for k in range(40)]
    texts = [" ".join(words[a:b]) for a, b in ((0, 39), (1, 40), (3, 38), (0, 20), (0, 4), (0, 0))]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "u0 u1 u2 u3 u4 u5")], "item_id long, text string")
    rows = sorted(dc.find_leaks(make_docs(texts), bench).collect(), key=lambda r: r.doc_id)
    got = [[(x.start, x.n_words, round(x.similarity, 9)) for x in r.leaks if x.item_id == 1] for r in rows]
    assert got == [[(0, 39, round(35 / 36, 9))], [(0, 39, round(35 / 36, 9))], [(0, 35, round(31 / 36, 9))], [], [], []]
    assert {x.item_id for r in rows for x in r.leaks} == {1}
