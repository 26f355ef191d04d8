"""Operator 12: fill-in-the-middle, with both cuts found by rank queries on a wavelet matrix.

Units are runs of letters and single other characters. Each character gets a class that says
what it is and whether a unit begins with it; a wavelet matrix over the classes answers how many
characters of a class lie before a place. The sum of these ranks over the classes that begin a
unit is the number of units begun so far; a bisection on it finds where the k-th unit begins.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.llm.common import attach, fresh, steps, table, text_bytes, text_of

#: Marks of the parts, in the order prefix, suffix, middle. A text that holds one stays plain.
MARKS = ("<P>", "<S>", "<M>")
#: Per cent of the documents that stay plain, and of the others that begin with the suffix.
PLAIN, SUFFIX_FIRST = 10, 20

#: Classes of characters. A letter within a run is the only one that begins no unit.
INSIDE, LETTER, DIGIT, BLANK, MARK, WIDE = range(6)
BEGINS = (LETTER, DIGIT, BLANK, MARK, WIDE)


def classes_of(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The class of each code point; texts begin at `first`, and no run of letters goes over it."""
    folded = points | np.uint32(32)
    letter = (folded >= 97) & (folded <= 122)
    after = np.zeros(len(points), bool)
    after[1:] = letter[:-1]
    after[first[first < len(points)]] = False
    out = np.full(len(points), MARK, np.uint8)
    out[(points >= 48) & (points <= 57)] = DIGIT
    out[(points == 32) | ((points >= 9) & (points <= 13))] = BLANK
    out[points > 127] = WIDE
    out[letter] = LETTER
    out[letter & after] = INSIDE
    return out


class WaveletMatrix:
    """Ranks in a sequence of small numbers.

    Level by level, from the highest bit on, the numbers are parted stably into those with a 0
    and those with a 1; each level keeps its bits in 64-bit words, with the ones before each word.
    """

    def __init__(self, numbers: np.ndarray, bits: int):
        self.levels = []
        for shift in range(bits - 1, -1, -1):
            ones = (numbers >> shift & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(ones) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=before[1:])
            zeros = len(ones) - int(before[-1])
            self.levels.append((shift, words, before, zeros))
            numbers = np.concatenate([numbers[~ones], numbers[ones]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & low)

    def rank(self, number: int, at: np.ndarray) -> np.ndarray:
        """How often the number stands before each of the places."""
        begin, end = np.zeros_like(at), at
        for shift, words, before, zeros in self.levels:
            one, other = (self._ones(words, before, x) for x in (begin, end))
            if number >> shift & 1:
                begin, end = zeros + one, zeros + other
            else:
                begin, end = begin - one, end - other
        return end - begin


class Units:
    """The units of several texts that stand one after the other."""

    def __init__(self, points: np.ndarray, starts: np.ndarray):
        self.starts, self.length = starts, len(points)
        self.matrix = WaveletMatrix(classes_of(points, starts[:-1]), 3)
        # the units begun before each text, and all
        self.begun = self.before(starts)
        self.counts = np.diff(self.begun)

    def before(self, at: np.ndarray) -> np.ndarray:
        """Units that begin before each place."""
        return sum(self.matrix.rank(c, at) for c in BEGINS)

    def ends(self, k: np.ndarray) -> np.ndarray:
        """Where the first k units of each text end, from the begin of the text.

        That is the greatest place before which only k units of the text begin.
        """
        low, high = self.starts[:-1].copy(), self.starts[1:].copy()
        target = self.begun[:-1] + k
        while (open_ := low < high).any():
            middle = (low + high + 1) >> 1
            fits = self.before(middle) <= target
            low = np.where(open_ & fits, middle, low)
            high = np.where(open_ & ~fits, middle - 1, high)
        return low - self.starts[:-1]


def joined(text: str, form: str, one: int, two: int) -> str:
    """The document as its form says, cut at the two places."""
    prefix, middle, suffix = text[:one], text[one:two], text[two:]
    p, s, m = MARKS
    if form == "psm":
        return p + prefix + s + suffix + m + middle
    if form == "spm":
        return s + suffix + p + prefix + m + middle
    return text


def restored(output: str, form: str) -> str:
    """The text that `joined` was given; no part holds a mark, so each is found where it was put."""
    if form == "plain":
        return output
    marks = MARKS if form == "psm" else (MARKS[1], MARKS[0], MARKS[2])
    begins = [output.index(mark) for mark in marks]
    if begins[0] != 0 or begins != sorted(begins):
        raise ValueError("marks are not in order")
    parts = {
        mark: output[begin + len(mark) : end]
        for mark, begin, end in zip(marks, begins, [*begins[1:], len(output)], strict=True)
    }
    p, s, m = MARKS
    return parts[p] + parts[m] + parts[s]


def draws(doc_id: int | None) -> list[int]:
    """Four numbers below 2**32 that depend on the id alone; a null id is the empty text."""
    name = "" if doc_id is None else str(doc_id)
    hexed = hashlib.sha256(f"1:{name}".encode()).hexdigest()
    return [int(hexed[k : k + 8], 16) for k in (0, 8, 16, 24)]


FIELDS = {
    "fim_units": T.LongType(),
    "fim_form": T.StringType(),
    "fim_prefix": T.LongType(),
    "fim_middle": T.LongType(),
    "fim_text": T.StringType(),
}


def fill_middle(docs: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """`docs` with `fim_units`, `fim_form`, `fim_prefix`, `fim_middle` and `fim_text`.

    The form is `plain`, `psm` or `spm`; `fim_text` is the document in that form, `fim_prefix` and
    `fim_middle` the code points of these parts, null if plain. Form and cuts depend on `doc_id`
    and the number of units alone, so repeated rows give equal rows, and a null id is one like any
    other. A null text is empty, and empty texts are plain, as are those that hold a mark. A text
    of any length is handled whole, by itself if it is longer than a step. Other columns stay;
    where they have one of these names, the new column gets underscores behind it, which `names`
    (by reference) tells. An empty table stays empty.
    """
    own = {f: fresh(docs, f) for f in FIELDS}
    if names is not None:
        names.update(own)

    def compute():
        def step(batch: pa.RecordBatch) -> list:
            ids, texts = batch.column("id").to_pylist(), batch.column("text")
            _, at = text_bytes(texts)
            columns: list[list] = [[] for _ in FIELDS]
            for first, last in steps(at):
                rows = texts.slice(first, last - first).to_pylist()
                for row in formed(ids[first:last], rows):
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            wide = pa.large_string() if pa.types.is_large_string(texts.type) else pa.string()
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), wide)
            return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]

        return step

    fields = [T.StructField(own[f], kind) for f, kind in FIELDS.items()]
    return attach(docs, {"id": F.col("doc_id").cast("long"), "text": text_of()}, fields, compute)


def formed(ids: list[int | None], texts: list[str]):
    """The new columns' values, row by row."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    # surrogates cannot occur in UTF-8, so each code point is four bytes
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    units = Units(points, starts)
    drawn = [draws(i) for i in ids]
    h = np.array(drawn, np.int64).reshape(-1, 4)
    one, two = h[:, 0] % (units.counts + 1), h[:, 1] % (units.counts + 1)
    one, two = units.ends(np.minimum(one, two)), units.ends(np.maximum(one, two))
    for k, text in enumerate(texts):
        form = "spm" if h[k, 3] % 100 < SUFFIX_FIRST else "psm"
        if not text or h[k, 2] % 100 >= 100 - PLAIN or any(mark in text for mark in MARKS):
            form = "plain"
        a, b = int(one[k]), int(two[k])
        cuts = (None, None) if form == "plain" else (a, b - a)
        yield int(units.counts[k]), form, *cuts, joined(text, form, a, b)


def rebuilt(formed_docs: DataFrame, names: dict[str, str], name: str) -> DataFrame:
    """With the column `name`: the text, read back from `fim_text` and `fim_form` alone."""

    def compute():
        def step(batch: pa.RecordBatch) -> list:
            outputs = batch.column("output")
            rows = zip(outputs, batch.column("form"), strict=True)
            return [pa.array([restored(o.as_py(), f.as_py()) for o, f in rows], outputs.type)]

        return step

    inputs = {"output": F.col(names["fim_text"]), "form": F.col(names["fim_form"])}
    return attach(formed_docs, inputs, [T.StructField(name, T.StringType())], compute)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names: dict[str, str] = {}
    formed_docs = rebuilt(fill_middle(docs, names).drop("text"), names, "again")
    return formed_docs.select(
        "doc_id",
        F.col(names["fim_units"]).alias("n"),
        F.col(names["fim_form"]).alias("form"),
        F.col(names["fim_prefix"]).alias("prefix_chars"),
        F.col(names["fim_middle"]).alias("middle_chars"),
        F.sha2(F.col(names["fim_text"]).cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("again").cast("binary"), 256).alias("restored_sha256"),
    )


def oracle() -> str:
    """The same in DuckDB, with the units as lists."""
    p, s, m = MARKS
    group = "('0x' || substr(h, {}, 8))::BIGINT"
    h1, h2, h3, h4 = (group.format(k) for k in (1, 9, 17, 25))
    return rf"""
    WITH units AS (
      SELECT doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
        sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
      FROM documents),
    drawn AS (
      SELECT *, len(u) AS n, {h1} % (len(u) + 1) AS a, {h2} % (len(u) + 1) AS b,
        CASE WHEN t = '' OR contains(t, '{p}') OR contains(t, '{s}') OR contains(t, '{m}')
               OR {h3} % 100 >= {100 - PLAIN} THEN 'plain'
             WHEN {h4} % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
      FROM units),
    parts AS (
      SELECT *, array_to_string(u[1:least(a, b)], '') AS prefix,
        array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
        array_to_string(u[greatest(a, b) + 1:], '') AS suffix
      FROM drawn)
    SELECT doc_id, n, form,
      CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t
        WHEN 'psm' THEN '{p}' || prefix || '{s}' || suffix || '{m}' || middle
        ELSE '{s}' || suffix || '{p}' || prefix || '{m}' || middle END) AS output_sha256,
      sha256(t) AS restored_sha256
    FROM parts"""
