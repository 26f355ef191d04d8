"""Operator 11 against a plain tree of lists."""

import hashlib

import numpy as np
import pytest

from docpipe.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(leaves):
    """The root, and for each leaf its siblings and the fold from another leaf."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([H(*row[k : k + 8]) for k in range(0, len(row), 8)])

    def siblings(i):
        out = []
        for row in levels[:-1]:
            first = i - i % 8
            out.append((row[first:i], row[i + 1 : first + 8]))
            i //= 8
        return out

    return levels[-1][0], siblings


def coded(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def test_addresses_fill_each_tree_once():
    for levels in range(1, 6):
        at = np.concatenate([merkle.address(levels, d, np.arange(8**d)) for d in range(levels)])
        assert sorted(at) == list(range(merkle.tree_size(levels)))
    # half the levels first: root and its children, then whole trees of three levels
    assert list(merkle.address(5, 1, np.arange(8))) == list(range(1, 9))
    assert list(merkle.address(5, 2, np.arange(3))) == [9, 9 + 73, 9 + 146]


@pytest.mark.parametrize("count", [1, 2, 7, 8, 9, 64, 65, 513, 4096])
def test_blocks_and_paths(count):
    leaves = [H(str(i)) for i in range(count)]
    raw = np.frombuffer(bytes.fromhex("".join(leaves)), np.uint8).reshape(-1, 32)
    levels = merkle.levels_for(count)
    nodes = merkle.laid_out(raw, levels)
    root, siblings = plain(leaves)
    assert nodes[0].tobytes().hex() == root
    proofs, turns = merkle.paths_of(nodes, count, levels, b"", b"")
    for i in {0, count // 2, count - 1}:
        want = siblings(i)
        assert proofs[i].hex() == "".join("".join(a + b) for a, b in want)
        assert list(turns[i]) == [n for a, b in want for n in (len(a), len(b))]
        assert merkle.folded(raw[i].tobytes(), proofs[i], turns[i]).hex() == root


def brute(rows):
    """The query's rows for (doc_id, text, lang, source, n_chars)."""
    import zlib

    groups = {}
    for doc_id, text, lang, source, n in rows:
        leaf = H(coded(doc_id, source, lang, n, text))
        now = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            now = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        key = (doc_id is not None, doc_id or 0, leaf)
        groups.setdefault(lang, []).append((key, doc_id, leaf, H(coded(doc_id, source, lang, n, now))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain([r[2] for r in sorted(groups[g])]) for g in names}
    root, over = plain([trees[g][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for i, (_, doc_id, leaf, now) in enumerate(sorted(groups[g])):
            path = trees[g][1](i) + over(place)
            for left, right in path:
                now = H(*left, now, *right)
            proof = H(*[s for left, right in path for s in left + right])
            out.append((doc_id, leaf, trees[g][0], root, proof, now, now == root))
    return sorted(out, key=repr)


def got(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("height", [1, 4])
def test_equals_a_plain_tree(spark, make_docs, sf_dir, monkeypatch, height):
    """Also with blocks of eight leaves, so that there are several tiers, over many languages too."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "BLOCK", 8**height)
    texts = [f"Text number {i}" for i in range(300)] + [None, "", "Zz" * 200_000, "Same", "Same", "No Id"]
    ids = [*range(300), 300, 301, 302, 303, 303, None]
    langs = [None if i % 50 == 0 else f"l{i % 20}" if i % 3 == 0 else "é" for i in range(len(texts))]
    docs = make_docs(texts, ids=ids, langs=langs, clash=True)
    want = brute([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()])
    assert got(merkle.query(spark, sf_dir(documents=docs))) == want
    assert {r[-1] for r in want} == {True, False}


def test_one_row_and_none(spark, make_docs, sf_dir):
    docs = make_docs(["Only"], ids=[7])
    want = brute([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()])
    assert got(merkle.query(spark, sf_dir(documents=docs))) == want
    built = merkle.documents_manifest(make_docs([]))
    assert built.root is None and merkle.proofs(built, merkle.PAYLOAD).collect() == []
