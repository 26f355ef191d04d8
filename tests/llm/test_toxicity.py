import random
import zlib

import numpy as np
import pytest

from docpipe.llm import toxicity as tx

WORDS = [f"w{a}{b}x" for a in "abcdefgh" for b in "abcdefgh"]
BAD = ["nasty", "vile", "rotten"]


def corpus(n=600, seed=5):
    rng = random.Random(seed)
    texts, toxic = [], []
    for k in range(n):
        words = rng.choices(WORDS, k=rng.randint(20, 80))
        bad = k % 6 == 0
        if bad:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(BAD).upper() + ",")
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, toxic


def tables(spark, make_docs, extra=(), clash=False):
    texts, toxic = corpus()
    docs = make_docs([*texts, *extra], clash=clash)
    labels = spark.createDataFrame([(k, 1, t) for k, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    return docs, labels, toxic


def test_held_out_accuracy(spark, make_docs, sf_dir):
    docs, labels, toxic = tables(spark, make_docs, [None, "", "vile nasty rotten " * 20_000], clash=True)
    got = {r.doc_id: r for r in tx.query(spark, sf_dir(documents=docs, labels=labels)).collect()}
    assert len(got) == len(toxic) + 3
    for k, r in got.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    wrong = [k for k, t in enumerate(toxic) if got[k].held_out and got[k].predicted != t]
    assert len(wrong) <= 0.03 * sum(r.held_out for r in got.values())
    assert got[len(toxic)].predicted == got[len(toxic) + 1].predicted == 0
    assert got[len(toxic) + 2].predicted == 1


def test_held_out_labels_are_not_used(spark, make_docs):
    docs, labels, _ = tables(spark, make_docs)
    flipped = labels.withColumn("toxic", tx.F.when(tx.held_out(tx.F.col("doc_id")), 1 - tx.F.col("toxic")).otherwise(tx.F.col("toxic")))
    one, other = tx.learn(docs, labels), tx.learn(docs, flipped)
    assert one.bias == other.bias and np.array_equal(one.weights, other.weights)


def test_risk_corrects_for_hidden_positives():
    rng = np.random.default_rng(0)
    positive = [np.array([1, 2]) for _ in range(200)]
    unlabelled = [np.array([1, 2]) if k < 150 else np.array([int(rng.integers(3, 50))]) for k in range(600)]
    model = tx.fit(positive, [np.sort(x) for x in unlabelled], prior=0.25)
    assert model.score(np.array([1, 2])) > 0.9
    assert model.score(np.array([7])) < 0.3


@pytest.mark.parametrize("toxic", [[], [0, 0]])
def test_nothing_to_learn(spark, make_docs, toxic):
    docs = make_docs(["a b", None])
    labels = spark.createDataFrame([(k, 1, t) for k, t in enumerate(toxic)] + [(None, 0, 1), (1, 0, None)], "doc_id long, quality int, toxic int")
    assert {r.score < 0.5 for r in tx.score(docs, tx.learn(docs, labels)).collect()} == {True}
    empty = make_docs([])
    assert tx.score(empty, tx.learn(empty, labels.limit(0))).collect() == []


def plain_parts(theta, positive, unlabelled, prior):
    """prior * R_P(+), and R_U(-) - prior * R_P(-), document by document."""

    def z(words):
        return theta[-1] + sum(theta[w] for w in words)

    def mean(rows, sign):
        return sum(np.log(1 + np.exp(sign * z(r))) for r in rows) / len(rows)

    return prior * mean(positive, -1), mean(unlabelled, 1) - prior * mean(positive, 1)


def flat(rows):
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array(sum(rows, []), np.int64), len(rows)


@pytest.mark.parametrize("prior", [0.1, 0.6])
def test_slopes_are_those_of_the_plain_risk(prior):
    rng = random.Random(1)
    positive, unlabelled = ([rng.sample(range(6), rng.randint(0, 4)) for _ in range(n)] for n in (7, 11))
    seen = set()
    for scale in (0.3, 3.0):
        for _ in range(6):
            theta = np.array([rng.gauss(0, scale) for _ in range(7)])
            negative, slope = tx.slopes(theta, flat(positive), flat(unlabelled), prior)
            plus, want = plain_parts(theta, positive, unlabelled, prior)
            assert negative == pytest.approx(want)
            seen.add(want >= 0)

            def goal(t):
                a, b = plain_parts(t, positive, unlabelled, prior)
                return a + b if want >= 0 else -b

            for k in range(7):
                step = np.zeros(7)
                step[k] = 1e-5
                number = (goal(theta + step) - goal(theta - step)) / 2e-5
                assert slope[k] == pytest.approx(number, abs=1e-6)
    assert seen == ({True, False} if prior > 0.5 else seen)
