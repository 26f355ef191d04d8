"""Operator 1: URLs judged by wildcard rules that run all at once, one bit per rule position."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.llm.common import attach, table

#: Stands between host and path. No text has this code point.
BREAK = 0x110000

#: The rules that the query applies to host and path: a host stands for its subdomains too.
HOST_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)


@dataclass(frozen=True)
class Glob:
    """A rule with wildcards: `*` is any run, `?` any one character, within host and path each."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host} {self.path}"


#: What the query asks of a URL that no host rule fits.
GLOBS = (
    Glob("block", "*casino*", "*"),
    Glob("block", "*-win.*", "*"),
    Glob("block", "*", "*/login*"),
    Glob("block", "*", "*/??/*000.html"),
    Glob("allow", "*", "/en/*"),
)


class Automaton:
    """Shift-And over many wildcard patterns, their positions packed into 64-bit words.

    A pattern of m symbols has m + 1 bits; bit j is set while its first j symbols fit what was
    read so far. A `*` after symbol j lets bit j stay set. All texts of a batch step together.
    """

    def __init__(self, patterns: list[tuple[str, str]]):
        parsed = []
        for host, path in patterns:
            symbols: list[int | None] = []
            loops = set()
            for part, more in ((host, [BREAK]), (path, [])):
                for c in part:
                    if c == "*":
                        loops.add(len(symbols))
                    else:
                        symbols.append(None if c == "?" else ord(c))
                symbols += more
            parsed.append((symbols, loops))
        self.alphabet = np.array(
            sorted({c for s, _ in parsed for c in s if c is not None}), np.uint32
        )
        bits = sum(len(s) + 1 for s, _ in parsed)
        width = max(1, -(-bits // 64))
        self.reads = np.zeros((len(self.alphabet) + 1, width), np.uint64)
        self.stays, self.starts = np.zeros(width, np.uint64), np.zeros(width, np.uint64)
        self.ends, at = [], 0
        breaks = np.searchsorted(self.alphabet, BREAK)

        def bit(mask: np.ndarray, place: int) -> None:
            mask[place // 64] |= np.uint64(1) << np.uint64(place % 64)

        for symbols, loops in parsed:
            bit(self.starts, at)
            for j in loops:
                bit(self.stays, at + j)
            for j, c in enumerate(symbols, 1):
                if c is None:
                    for k in range(len(self.reads)):
                        if k != breaks:
                            bit(self.reads[k], at + j)
                else:
                    bit(self.reads[np.searchsorted(self.alphabet, c)], at + j)
            self.ends.append(at + len(symbols))
            at += len(symbols) + 1
        self.breaks = breaks

    def fits(self, texts: list[np.ndarray]) -> np.ndarray:
        """For arrays of code points: which text (row) fits which pattern (column)."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        flat = np.concatenate([*(texts[i] for i in order), np.empty(0, np.uint32)])
        place = np.searchsorted(self.alphabet, flat)
        place[place == len(self.alphabet)] = 0
        kinds = np.where(self.alphabet[place] == flat, place, len(self.alphabet))
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        state = np.repeat(self.starts[None, :], len(texts), axis=0)
        active = len(texts)
        for t in range(int(lengths[0]) if len(lengths) else 0):
            while active and lengths[active - 1] <= t:
                active -= 1
            kind = kinds[begins[:active] + t]
            now = state[:active]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            # a run of any characters never goes over the break
            stays = np.where((kind == self.breaks)[:, None], np.uint64(0), self.stays)
            state[:active] = (moved & self.reads[kind]) | (now & stays)
        out = np.empty((len(texts), len(self.ends)), bool)
        for k, end in enumerate(self.ends):
            out[order, k] = (state[:, end // 64] >> np.uint64(end % 64)) & np.uint64(1)
        return out


def host_and_path(url: str | None) -> tuple[str, str]:
    """The host with A-Z in lower case, and the path; both empty for null or without `://`."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    cut = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return host.encode().lower().decode(), rest[:cut]


def judge(
    pages: DataFrame,
    host_rules: tuple = HOST_RULES,
    globs: tuple = GLOBS,
    url: str = "url",
) -> DataFrame:
    """`pages` with `host`, `path`, `rule`, `verdict` and `pattern`.

    A host rule (`host/path`) fits its host and all subdomains if the path starts with its path;
    the longest wins, and of equally long ones the one that blocks. Where none fits, `rule` is
    null and the globs decide: an allowing one wins over blocking ones, the first that fits is
    named in `pattern`, and without any the verdict is allow. Null and broken URLs have an empty host
    and path and are judged alike. Rows come back once each, repeated ones too; columns of `pages`
    with the names of the new ones are replaced. An empty table stays empty.
    """
    ranked = sorted(host_rules, key=lambda r: (-len(r[1]), r[0] != "block"))
    globs = sorted(globs, key=lambda g: g.verdict != "allow")
    patterns = []
    for _, rule in ranked:
        host, _, path = rule.partition("/")
        patterns.append((f"*.{host}", f"/{path}*"))
    patterns += [(f".{g.host}", g.path) for g in globs]

    def compute():
        automaton = Automaton(patterns)
        names = [r[1] for r in ranked] + [None] * len(globs) + [None]
        verdicts = [r[0] for r in ranked] + [g.verdict for g in globs] + ["allow"]
        which = [None] * len(ranked) + [g.name for g in globs] + [None]

        def code_points(host: str, path: str) -> np.ndarray:
            raw = ("." + host + "\0" + path).encode("utf-32-le", "surrogatepass")
            out = np.frombuffer(raw, np.uint32).copy()
            out[len(host) + 1] = BREAK
            return out

        def step(batch: pa.RecordBatch) -> list:
            parts = [host_and_path(u) for u in batch.column(0).to_pylist()]
            fits = automaton.fits([code_points(*p) for p in parts])
            fits = np.column_stack([fits, np.ones(len(parts), bool)])
            first = fits.argmax(axis=1)
            text = pa.string()
            return [
                pa.array([p[0] for p in parts], text),
                pa.array([p[1] for p in parts], text),
                pa.array([names[k] for k in first], text),
                pa.array([verdicts[k] for k in first], text),
                pa.array([which[k] for k in first], text),
            ]

        return step

    fields = [T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "verdict", "pattern")]
    return attach(pages, {"url": F.col(url).cast("string")}, fields, compute)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


def _glob_sql(glob: Glob) -> str:
    def like(text: str) -> str:
        return text.replace("_", r"\_").replace("*", "%").replace("?", "_")

    return f"host LIKE '{like(glob.host)}' ESCAPE '\\' AND path LIKE '{like(glob.path)}' ESCAPE '\\'"


def oracle() -> str:
    """The same in DuckDB, rule by rule."""
    ranked = sorted(HOST_RULES, key=lambda r: -len(r[1]))
    globs = sorted(GLOBS, key=lambda g: g.verdict != "allow")
    rules, verdicts = [], []
    for verdict, rule in ranked:
        host, _, path = rule.partition("/")
        fits = f"('.' || host) LIKE '%.{host}' AND starts_with(path, '/{path}')"
        rules.append(f"WHEN {fits} THEN '{rule}'")
        verdicts.append(f"WHEN rule = '{rule}' THEN '{verdict}'")
    which = [f"WHEN {_glob_sql(g)} THEN '{g.name}'" for g in globs]
    verdicts += [f"WHEN pattern = '{g.name}' THEN '{g.verdict}'" for g in globs]
    return f"""
    WITH cut AS (
      SELECT page_id,
        CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3 :] ELSE '' END AS rest
      FROM pages),
    parts AS (
      SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path
      FROM cut),
    ruled AS (SELECT *, CASE {' '.join(rules)} END AS rule FROM parts),
    globbed AS (
      SELECT *, CASE WHEN rule IS NOT NULL THEN NULL {' '.join(which)} END AS pattern FROM ruled)
    SELECT page_id, host, path, rule, CASE {' '.join(verdicts)} ELSE 'allow' END AS verdict, pattern
    FROM globbed"""
