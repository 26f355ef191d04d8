import hashlib
import random

import duckdb

from docpipe.llm import chat_trees as ct

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(seed=1):
    rng = random.Random(seed)
    rows = []
    for conv in range(40):
        common = rng.choice((0, 1, 2, 5))
        length = rng.randint(1, 7)
        for turn in range(length):
            text = f"same {turn}" if turn < common else f"{rng.random()}\nx"
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", text))
    rows += [(50, t, r, x) for t, (r, x) in enumerate([("user", "same 0"), ("assistant", None), ("user", "<|end|>\n")])]
    rows += [(51, t, r, x) for t, (r, x) in enumerate([("user", "same 0"), ("assistant", ""), ("user", "<|end|>\n")])]
    rows += [(52, 0, "user", "same 0")]
    rows += [(53, 0, None, "<\\|<\\\\|<|text|>[INST][/INST]<s></s>\\"), (53, 1, "assistant", "<|<|turn|>[" + "y" * 200_000)]
    rows += [(54, 0, "a<|text|>b", "<"), (54, 0, "assistant", "tie"), (54, 0, "assistant", "tie")]
    return rows


def clashing(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "'x' AS conv", "2 AS size", "3 AS pos")


def test_query_equals_sql(spark, sf_dir):
    folder = sf_dir(conversations=clashing(spark, conversations()))
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    got = ct.query(spark, folder)
    want = duck.sql(ct.oracle())
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    # and one by hand
    own = next(r for r in got.collect() if r.conv_id == -7)
    text = "</s>[INST] ok [/INST]"
    assert own.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (own.n_turns, own.loss_chars) == (2, len(text))
    assert own.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_trees(spark):
    rows = conversations(2)
    nodes, paths = ct.build(clashing(spark, rows))
    nodes, paths = nodes.collect(), paths.collect()
    turns = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        turns.setdefault(f"={conv}", []).append((role or "", text or ""))
    # each beginning that conversations share is one node
    beginnings = {tuple(t[: k + 1]) for t in turns.values() for k in range(len(t))}
    assert len(nodes) == len(beginnings) == len({n.node for n in nodes})
    trees = {}
    for n in nodes:
        trees.setdefault(n.tree, []).append(n)
    for members in trees.values():
        members.sort(key=lambda n: n.start)
        # a tree's text has no gaps and no overlaps
        assert [n.start for n in members] == [0] + [n.end for n in members][:-1]
        stack = []
        for n in members:
            assert n.end - n.start == len(n.content)
            # depth-first: the parent is the last node that is less deep
            stack = stack[: n.pos]
            assert len(stack) == n.pos
            assert n.position == sum(len(a.content) for a in stack)
            covered = [k for s in n.attends for k in (s.start, s.end)]
            assert covered == sorted(set(covered))
            assert sum(s.end - s.start for s in n.attends) == n.position
            assert all(any(s.start <= a.start and a.end <= s.end for s in n.attends) for a in stack)
            for span in n.loss:
                assert n.start <= span.start <= span.end <= n.end
            stack.append(n)
    # a path leads through all turns of a conversation
    for conv, said in turns.items():
        mine = {p.segment for p in paths if p.conv == conv}
        assert sorted(n.pos for n in nodes if n.segment in mine) == list(range(len(said)))


def test_one_hot_beginning_and_empty(spark):
    rows = [(k, 0, "system", "be kind") for k in range(300)] + [(k, 1, "user", f"q{k % 7}") for k in range(300)]
    nodes, paths = ct.build(spark.createDataFrame(rows, SCHEMA))
    assert nodes.count() == 8
    assert paths.count() == 600
    assert [tuple(x) for x in nodes.where("pos = 1").select("attends").first().attends] == [(0, len("<|turn|>system<|text|>be kind<|end|>\n"))]
    empty, none = ct.build(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == none.collect() == []


def test_null_ids_are_one_conversation(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, None, "user", "a"), (1, 0, "assistant", "c")]
    got = {r.conv: r for r in ct.digests(ct.read_back(*ct.build(spark.createDataFrame(rows, SCHEMA)))).collect()}
    assert got["null"].n_turns == 2 and got["=1"].loss_sha256 == hashlib.sha256(b"c").hexdigest()
