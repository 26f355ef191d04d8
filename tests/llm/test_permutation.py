"""Operator 13 against all inner products."""

import os

import numpy as np
import pytest

from docpipe.llm import permutation as pm

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int, v string, pivots int, rank int"


def brute(rows, k, every):
    """query_id → [(vec_id, score)], nearest first, of the usable rows."""
    good = {}
    for vec_id, vector in rows:
        if vec_id is None or not vector or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            continue
        good[vec_id] = np.array(vector, np.float64)
    ids = np.array(sorted(good))
    table = np.stack([good[i] for i in ids])
    out = {}
    for q in ids[ids % every == 0]:
        score = pm.products(good[q], table)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 1, 1) for i, v in rows], SCHEMA)


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in want])


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_recall_on_the_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got, want = found(pm.query(spark, SF_DIR)), brute(rows, 20, 20)
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.97


def test_lengths_matter(spark):
    """Largest inner product, not angle: some vectors are much longer."""
    random = np.random.default_rng(5)
    table = random.normal(size=(3000, 16)) * random.lognormal(0, 0.7, size=(3000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(table)]
    index = pm.Index(vectors(spark, rows))
    got = found(index.search(index.rows.where("vec_id % 100 = 0"), 10))
    assert recall(got, brute(rows, 10, 100)) >= 0.95


def test_a_hot_group_is_searched_whole(spark):
    """A third of the rows is one vector, another third nearly one; ties go to the smaller id."""
    random = np.random.default_rng(6)
    base, other = random.normal(size=(2, 24))
    near = other + random.normal(size=(1000, 24)) * 0.01
    rest = random.normal(size=(1000, 24))
    table = [base] * 1000 + list(near) + list(rest)
    rows = [(int(i), v.tolist()) for i, v in zip(random.permutation(3000), table, strict=True)]
    index = pm.Index(vectors(spark, rows))
    got, want = found(index.search(index.rows.where("vec_id % 60 = 0"), 20)), brute(rows, 20, 60)
    same = {i for i, _ in rows[:1000]}
    assert all(got[q] == want[q] for q in want if q in same)
    assert recall(got, want) >= 0.95


def test_rows_of_every_kind(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0]), (20, [1.0, 2.0]), (3, [2.0, 1.0]), (-20, [1.0]), (None, [1.0, 1.0]), (40, None),
        (60, []), (80, [0.0, 0.0]), (100, [1.0, None]), (120, [nan, 1.0]), (140, [inf, 1.0]), (4, [-1.0, -1.0]),
        (3, [2.0, 1.0]),
    ]
    index = pm.Index(vectors(spark, rows))
    got = found(index.search(index.rows.where("vec_id % 20 = 0"), 20))
    assert got == {
        0: [(20, 5.0), (3, 4.0), (-20, 1.0), (4, -3.0)],
        20: [(0, 5.0), (3, 4.0), (-20, 1.0), (4, -3.0)],
        -20: [(3, 2.0), (0, 1.0), (20, 1.0), (4, -1.0)],
    }


def test_empty_tables_and_one_row(spark):
    for rows in ([], [(1, None)], [(20, [1.0, 2.0])]):
        index = pm.Index(vectors(spark, rows))
        assert index.search(index.rows.where("vec_id % 20 = 0"), 20).collect() == []


def test_posted_distances_are_footrules():
    random = np.random.default_rng(7)
    orders = np.stack([random.permutation(40)[:12] for _ in range(200)]).astype(np.int16)
    posted = pm.Posted(orders, 40)
    for q in range(5):
        want = pm.footrules(np.repeat(orders[q : q + 1], 200, axis=0), orders, 40)
        assert (posted.distances(orders[q]) == want).all()


def test_blocks_and_passes_give_the_same_rows(spark, monkeypatch):
    random = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(random.normal(size=(400, 8)))]
    for name, size in (("BLOCK_ROWS", 90), ("BLOCK_QUERIES", 7), ("FEW", 4), ("POSTED", 16)):
        monkeypatch.setattr(pm, name, size)
    index = pm.Index(vectors(spark, rows))
    got = found(index.search(index.rows.where("vec_id % 20 = 0"), 5))
    want = brute(rows, 5, 20)
    assert got.keys() == want.keys() and recall(got, want) >= 0.95
