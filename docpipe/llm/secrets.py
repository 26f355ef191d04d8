"""Operator 10: secrets found by regular expressions behind a trigram index of each block of texts."""

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.llm.common import attach, fresh, steps, table, text_bytes, text_of

#: A literal with more spellings than this is cut in two.
MOST_SPELLINGS = 64


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, left to right without overlaps, with `least` characters in `group`."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = re.finditer(self.pattern, text, re.ASCII)
        return [m.span() for m in found if len(m[self.group]) >= self.least]


ASSIGNED = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
BASE_RULES = (
    Rule("assign", ASSIGNED, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    # only at the begin of a token, so that "eyJeyJ..." is not tried again from each place
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("url_login", r"://[A-Za-z0-9._-]{1,64}:[^\x00-\x20/@:]{3,128}@"),
)
RULES = BASE_RULES + MORE_RULES
KINDS = [r.kind for r in RULES]

#: A query: a trigram, ("and", queries), ("or", queries); no condition is ("and", ()).
ALL = ("and", ())


def _both(parts: list) -> tuple:
    parts = [p for p in dict.fromkeys(parts) if p != ALL]
    return parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _either(parts: list) -> tuple:
    parts = list(dict.fromkeys(parts))
    if ALL in parts:
        return ALL
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _spelled(words: set[bytes]) -> tuple:
    """One of the words is there: all trigrams of one of them are."""
    return _either([_both([w[i : i + 3] for i in range(len(w) - 2)]) for w in sorted(words)])


def _walk(nodes) -> tuple[set[bytes] | None, tuple]:
    """All that the nodes can spell in lower case, if that is little, and what they surely hold."""
    run: set[bytes] = {b""}
    whole, needs = True, []
    for op, arg in nodes:
        spells, inner = None, ALL
        if op is sre.LITERAL:
            spells = {chr(arg).lower().encode()} if arg < 128 else None
        elif op is sre.IN and all(k is sre.LITERAL and c < 128 for k, c in arg):
            spells = {chr(c).lower().encode() for _, c in arg}
        elif op is sre.SUBPATTERN:
            spells, inner = _walk(arg[3])
        elif op is sre.BRANCH:
            branches = [_walk(b) for b in arg[1]]
            if all(s is not None for s, _ in branches):
                spells = set().union(*(s for s, _ in branches))
            inner = _either([q for _, q in branches])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            least, most, body = arg
            some, within = _walk(body)
            if (least, most) == (0, 1) and some is not None:
                spells = some | {b""}
            elif least:
                inner = within
        elif op is sre.AT:
            continue
        if spells is not None and len(run) * len(spells) <= MOST_SPELLINGS:
            run = {a + b for a in run for b in spells}
            continue
        whole = False
        needs += [_spelled(run), inner if spells is None else _spelled(spells)]
        run = {b""}
    needs.append(_spelled(run))
    return (run if whole else None), _both(needs)


def trigram_query(pattern: str) -> tuple:
    """What trigrams, of ASCII-lower-cased bytes, any match of the pattern must have in the text."""
    return _walk(_parser.parse(pattern, re.ASCII))[1]


def trigrams(query) -> set[bytes]:
    return {query} if isinstance(query, bytes) else set().union(*map(trigrams, query[1]))


_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


class Index:
    """The postings of the wanted trigrams over a block of texts: the rows that have each."""

    def __init__(self, wanted: set[bytes]):
        self.wanted = sorted(wanted)
        codes = np.array([int.from_bytes(t, "big") for t in self.wanted], np.int64)
        self.numbers = np.zeros(1 << 24, np.uint8 if len(codes) < 255 else np.uint16)
        self.numbers[codes] = np.arange(1, len(codes) + 1)

    def load(self, raw: np.ndarray, starts: np.ndarray) -> "Index":
        low = _LOWER[raw[starts[0] : starts[-1]]]
        codes = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:] if len(low) > 2 else low[:0]
        numbers = self.numbers[codes]
        at = np.flatnonzero(numbers)
        # texts of no length make equal starts; the last of those has the byte
        rows = np.searchsorted(starts - starts[0], at, "right") - 1
        inside = at + 3 <= starts[rows + 1] - starts[0]
        rows, found = rows[inside], numbers[at[inside]]
        self.rows = len(starts) - 1
        self.postings = {
            t: np.unique(rows[found == k]) for k, t in enumerate(self.wanted, 1)
        }
        return self

    def candidates(self, query) -> np.ndarray:
        if isinstance(query, bytes):
            return self.postings[query]
        rows = [self.candidates(q) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(rows))
        out = np.arange(self.rows) if not rows else rows[0]
        for other in rows[1:]:
            out = np.intersect1d(out, other, assume_unique=True)
        return out


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)
_SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
)


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", name: str = "spans"
) -> DataFrame:
    """`docs` with `spans`, or another `name`: kind, start and end (code points, end exclusive), by start, then rule.

    Each rule's regular expression gives a Boolean query over trigrams that a match can't do
    without. Every block of about a megabyte of texts is indexed for the trigrams of all queries;
    a rule then reads the texts that its query leaves, and all texts if it has no such trigram.
    Texts are read whole; null is empty and has no spans. Spans of different rules may overlap.
    Repeated rows each keep theirs; a column of `docs` with that name is replaced; empty tables stay empty.
    """
    queries = [trigram_query(r.pattern) for r in rules]

    def compute():
        index = Index(set().union(*map(trigrams, queries)))

        def step(batch: pa.RecordBatch) -> list:
            texts = batch.column(0)
            raw, starts = text_bytes(texts)
            out: list[list] = [[] for _ in range(len(texts))]
            for first, last in steps(starts):
                index.load(raw, starts[first : last + 1])
                read: dict[int, str] = {}
                for number, (rule, query) in enumerate(zip(rules, queries, strict=True)):
                    for row in index.candidates(query):
                        row = int(row)
                        if row not in read:
                            read[row] = texts[first + row].as_py()
                        spans = rule.spans(read[row])
                        out[first + row] += [(a, number, b) for a, b in spans]
            named = [
                [{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(spans)]
                for spans in out
            ]
            return [pa.array(named, _SPANS_ARROW)]

        return step

    return attach(docs, {"text": text_of(text)}, [T.StructField(name, SPANS)], compute)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with `mark` for each secret in `text`; overlapping spans become one mark.

    `n_chars`, where there is such a column, is the new length of texts that changed. Other texts,
    null ones too, and all other columns stay as they are.
    """
    content, spans = fresh(docs, "content"), fresh(docs, "found")
    found = scan(docs.withColumn(content, F.col("text").cast("string")), rules, content, spans)
    # pieces of text between spans: `at` is where the last span so far ended (1 based)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    whole = F.col(content)

    def add(state, span):
        joined = span["start"] < state["at"]
        kept = F.substring(whole, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.when(joined, state["out"]).otherwise(F.concat(state["out"], kept, F.lit(mark))).alias("out"),
            F.greatest(state["at"], span["end"]).alias("at"),
        )

    def end(state):
        return F.concat(state["out"], F.substring(whole, state["at"] + 1, F.length(whole)))

    cleaned = F.when(F.size(spans) > 0, F.aggregate(spans, start, add, end)).otherwise(whole)
    columns = []
    for name in docs.columns:
        if name.lower() == "text":
            columns.append(cleaned.alias(name))
        elif name.lower() == "n_chars":
            kind = docs.schema[name].dataType
            length = F.length(cleaned).cast(kind)
            columns.append(F.when(F.size(spans) > 0, length).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return found.select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in BASE_RULES]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(joined(of_base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
