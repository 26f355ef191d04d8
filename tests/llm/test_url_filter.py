import fnmatch
import random
import re

import duckdb
import numpy as np
import pytest

from docpipe.llm import url_filter as uf

URLS = [
    None, "", "no scheme", "://", "http://", "http://NET/", "http://net", "http://a.net/x?y#z",
    "http://example.net/en/1", "http://www.EXAMPLE.net/en/", "http://example.net/en", "https://example.com/de/1",
    "http://example.com/fr?/de/", "http://x.org/fr/#a", "http://xorg/fr/", "http://.net/", "http://a.net:80/",
    "http://a#net/", "http://a.example.net?/en/", "x://y://z.net/", "http://é.net/ü", "http://a.com/x.net/",
    "http://casino.com/", "http://a-win.info/login", "http://a.com/b/login/1", "http://a.com/ab/1000.html",
    "http://a.com/en/x", "http://a.com/a\0b", "http://\u0130.NET/", "http://a.net/" + "x" * 300_000,
]


def judged(spark, urls):
    rows = [(i, u) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string")


def test_rules(spark):
    got = {r.page_id: r for r in uf.judge(judged(spark, URLS)).collect()}
    assert len(got) == len(URLS)

    def of(url):
        r = got[URLS.index(url)]
        return r.host, r.path, r.rule, r.verdict

    assert of(None) == of("") == of("no scheme") == ("", "", None, "allow")
    assert of("http://NET/") == ("net", "/", "net/", "block")
    assert of("http://net") == ("net", "", None, "allow")
    assert of("http://a.net/x?y#z") == ("a.net", "/x", "net/", "block")
    assert of("http://www.EXAMPLE.net/en/") == ("www.example.net", "/en/", "example.net/en/", "allow")
    assert of("http://example.net/en")[2:] == ("net/", "block")
    assert of("http://example.com/fr?/de/") == ("example.com", "/fr", None, "allow")
    assert of("http://xorg/fr/")[2] is None
    assert of("http://a.com/x.net/")[2] is None
    assert of("http://casino.com/")[3] == "block"
    assert of("http://\u0130.NET/")[0] == "\u0130.net"


def test_query_equals_sql(spark, sf_dir):
    pages = judged(spark, [u for u in URLS if u is None or "\0" not in u]).selectExpr("*", "'<p>' AS html", "1 AS host")
    folder = sf_dir(pages=pages)
    got = uf.query(spark, folder)
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    want = duck.sql(uf.oracle())
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_automaton_equals_matching_by_pattern():
    rng = random.Random(1)
    patterns = [
        ("".join(rng.choices("ab*?.", k=rng.randint(0, 9))), "".join(rng.choices("ab*?/", k=rng.randint(0, 9))))
        for _ in range(60)
    ]
    pairs = [("".join(rng.choices("ab.", k=rng.randint(0, 8))), "".join(rng.choices("ab/c", k=rng.randint(0, 8)))) for _ in range(300)]
    arrays = [np.array([*map(ord, h), uf.BREAK, *map(ord, p)], np.uint32) for h, p in pairs]
    fits = uf.Automaton(patterns).fits(arrays)

    def regex(glob):
        return re.compile("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in glob) + r"\Z", re.S)

    for k, (h, p) in enumerate(patterns):
        rh, rp = regex(h), regex(p)
        want = [bool(rh.match(a) and rp.match(b)) for a, b in pairs]
        assert fits[:, k].tolist() == want, (h, p)
    assert uf.Automaton(patterns).fits([]).shape == (0, 60)
    assert fnmatch.fnmatchcase("ab", "a*")


def test_ties_and_repeats(spark):
    rules = (("allow", "b.net/"), ("block", "net/a/"))
    pages = judged(spark, ["http://b.net/a/", "http://b.net/a/"])
    pages = pages.unionByName(pages)
    assert [(r.rule, r.verdict) for r in uf.judge(pages, rules, ()).collect()] == [("net/a/", "block")] * 4


@pytest.mark.parametrize("clash", ["host", "Verdict", "rule"])
def test_empty_and_clashes(spark, clash):
    pages = judged(spark, []).selectExpr("*", f"1 AS {clash}")
    assert uf.judge(pages).collect() == []
    full = uf.judge(judged(spark, ["http://a.net/"]).selectExpr("*", f"1 AS {clash}"))
    assert [c.lower() for c in full.columns].count(clash.lower()) == 1
    assert full.select(clash).first()[0] in ("a.net", "block", "net/")
