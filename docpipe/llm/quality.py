"""Operator 2: texts kept or rejected by counts and by their distance from what languages look like."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.llm.common import BLANKS, attach, emit, table, text_of, words_of

SYMBOLS = "#*$%&|<>"

#: Frequent words of each language that has a reference.
COMMON_WORDS = {
    "de": "der die das und in zu den mit von ist nicht ein eine auch auf für sich des dem er es an im",
    "en": "the of and to in a is that it for was on as with be by at from this have are not or",
    "es": "de la que el en y los se del las un por con no una su para es al lo como más pero",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce avec",
}
WORDS = sorted({w for text in COMMON_WORDS.values() for w in text.split()})

#: Texts shorter than this are not compared: their histograms say little.
LEAST_CHARS, LEAST_WORDS = 200, 50
#: The largest Jensen-Shannon distances (base 2, 0 to 1) from the nearest language.
MOST_CHARS, MOST_WORDS = 0.24, 0.4
#: What a document adds to a reference, shared out over its histogram.
UNIT = 1_000_000

# classes of bytes: lower case, upper case, digit, blank, line break, sentence mark, quote or
# dash, symbol, other ASCII, first byte of another character; 10 is not a character
_CLASSES = np.full(256, 8, np.uint8)
for _number, _set in enumerate(
    ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r\x0b\x0c",
     ".,;:!?", "\"'()-", SYMBOLS + "@=+~^_{}[]\\/`"]
):
    _CLASSES[[ord(c) for c in _set]] = _number
_CLASSES[0x80:0xC0] = 10
_CLASSES[0xC0:] = 9
N_CLASSES = 10


def char_histogram(text: bytes) -> np.ndarray:
    kinds = _CLASSES[np.frombuffer(text, np.uint8)]
    return np.bincount(kinds, minlength=N_CLASSES + 1)[:N_CLASSES]


_WORD_AT = {w.encode(): k for k, w in enumerate(WORDS)}
_MARKS = b".,;:!?\"'()"


def word_histogram(words: dict[bytes, int], counts: np.ndarray) -> np.ndarray:
    """Of the frequent words, ASCII letters in either case and marks stripped; last, all others."""
    out = np.zeros(len(WORDS) + 1, np.int64)
    for word, number in words.items():
        if len(word) < 12:
            at = _WORD_AT.get(word.lower().strip(_MARKS))
            if at is not None:
                out[at] += counts[number]
    out[-1] = counts.sum() - out.sum()
    return out


def numbered(words: list[bytes]) -> tuple[dict[bytes, int], np.ndarray]:
    """Words by number, and the number of each word of the text."""
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    return known, ids


def repeated_words(ids: np.ndarray) -> int:
    """How many words lie in a window of three words that is in the text twice or more."""
    if len(ids) < 4:
        return 0
    pairs = np.unique(ids[:-1] * (ids.max() + 1) + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * (ids.max() + 1) + ids[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    hit = counts[inverse] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : len(hit) + k] |= hit
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """How many lines with a word equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of one histogram from each row of `reference`."""
    p = counts / max(1, counts.sum())
    mean = (p + reference) / 2

    def divergence(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / mean), 0).sum(axis=1)

    return np.sqrt(np.maximum(0, (divergence(np.broadcast_to(p, mean.shape)) + divergence(reference)) / 2))


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """A row for each language of COMMON_WORDS that documents name: `lang`, `chars`, `words`.

    Each whole document of LEAST_WORDS words and LEAST_CHARS characters adds its two histograms
    with the same weight, so that no long document outweighs others; sums are of whole numbers
    and don't depend on order. Documents with null or another language add nothing.
    """

    def compute():
        def step(batch: pa.RecordBatch):
            sums: dict[str, np.ndarray] = {}
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(content)
                if len(words) < LEAST_WORDS:
                    continue
                chars = char_histogram(content.encode())
                if chars.sum() < LEAST_CHARS:
                    continue
                known, ids = numbered(words)
                common = word_histogram(known, np.bincount(ids))
                both = np.concatenate([chars * UNIT // chars.sum(), common * UNIT // common.sum()])
                sums[name] = sums.get(name, 0) + both
            rows = [(n, k, int(v)) for n, both in sums.items() for k, v in enumerate(both)]
            names, places, values = zip(*rows, strict=True) if rows else ((), (), ())
            yield {
                "lang": pa.array(names, pa.string()),
                "place": pa.array(places, pa.int32()),
                "value": pa.array(values, pa.int64()),
            }

        return step

    named = docs.select(F.col(lang).cast("string").alias("lang"), text_of(text).alias("text"))
    named = named.where(F.col("lang").isin(list(COMMON_WORDS)))
    parts = emit(named, "lang string, place int, value long", compute)
    return parts.groupBy("lang", "place").agg(F.sum("value").alias("value"))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """`docs` with the counts of MEASURES, `base_failed`, `nearest`, two distances and `kept`.

    Words are runs without blanks; a null text has none. A document fails the base rules with
    under 50 words or over half of its words in repeated windows of three. The others are
    compared, if they have LEAST_CHARS characters and LEAST_WORDS words, with each language's
    reference (learnt from all of `docs`): `nearest` is the language with the least sum of both
    distances (ties: the first by name), and the document is kept if neither is above its limit.
    Where a text is too short or there is no reference the distances are null and the base rules
    decide. The references are at most one row of fixed length per language of COMMON_WORDS.
    Repeated rows are measured each; columns with the new names are replaced; empty tables stay
    empty.
    """
    names = list(COMMON_WORDS)
    found = np.zeros((len(names), N_CLASSES + len(WORDS) + 1))
    for row in references(docs, text, lang).collect():
        found[names.index(row["lang"]), row["place"]] = row["value"]
    there = np.flatnonzero(found.sum(axis=1) > 0)
    nearest_names = [names[k] for k in there]
    chars_ref, words_ref = np.split(found[there], [N_CLASSES], axis=1)
    if len(there):
        chars_ref /= chars_ref.sum(axis=1, keepdims=True)
        words_ref /= words_ref.sum(axis=1, keepdims=True)

    def compute():
        def one(content: str) -> tuple:
            words = words_of(content)
            known, ids = numbered(words)
            repeats = repeated_words(ids)
            failed = len(words) < 50 or 100 * repeats > 50 * len(words)
            near = by_char = by_word = None
            if len(words) >= LEAST_WORDS and len(there):
                chars = char_histogram(content.encode())
                if chars.sum() >= LEAST_CHARS:
                    of_chars = distance(chars, chars_ref)
                    of_words = distance(word_histogram(known, np.bincount(ids)), words_ref)
                    k = int(np.argmin(np.round(of_chars + of_words, 9)))
                    near = nearest_names[k]
                    by_char, by_word = round(float(of_chars[k]), 6), round(float(of_words[k]), 6)
            return (
                len(words),
                len(content) - sum(map(content.count, BLANKS)),
                sum(map(content.count, SYMBOLS)),
                repeated_lines(content),
                repeats,
                failed,
                near,
                by_char,
                by_word,
                not failed and (near is None or by_char <= MOST_CHARS and by_word <= MOST_WORDS),
            )

        def step(batch: pa.RecordBatch) -> list:
            rows = [one(t.as_py()) for t in batch.column(0)]
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.string()] + [pa.float64()] * 2 + [pa.bool_()]
            return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]

        return step

    fields = [T.StructField(n, T.LongType()) for n in MEASURES]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("nearest", T.StringType())]
    fields += [T.StructField(n, T.DoubleType()) for n in ("char_distance", "word_distance")]
    fields += [T.StructField("kept", T.BooleanType())]
    return attach(docs, {"text": text_of(text)}, fields, compute)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = measure(table(spark, sf_dir, "documents"))
    more = ("base_failed", "nearest", "char_distance", "word_distance", "kept")
    return measured.select("doc_id", *MEASURES, *more)


def oracle() -> str:
    """The same in DuckDB. Histograms have a row for each place: classes, then frequent words."""
    low, up = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    classes = ["a-z", "A-Z", "0-9", r"\x20\x09", r"\x0A-\x0D", ".,;:!?", '"' + "''()-", r"#*$%&|<>@=+~^_{}\[\]\\/`"]
    counts = [f"len(regexp_replace(text, '[^{c}]', '', 'g'))" for c in classes]
    counts.append("len(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) - " + " - ".join(counts))
    counts.append("len(regexp_replace(text, '[\\x00-\\x7F]', '', 'g'))")
    words = ", ".join(f"('{w}', {N_CLASSES + k})" for k, w in enumerate(WORDS))
    last = N_CLASSES + len(WORDS)
    langs = ", ".join(f"'{x}'" for x in COMMON_WORDS)
    blanks = "".join(f"chr({ord(c)}) || " for c in BLANKS) + "''"
    return rf"""
    WITH docs AS (
      SELECT doc_id, lang, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    tokens AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM docs),
    windows AS (
      SELECT doc_id, i, w, lead(w) OVER d AS x, lead(w, 2) OVER d AS y FROM tokens
      WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
    twice AS (
      SELECT doc_id, i FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, x, y) AS n FROM windows WHERE y IS NOT NULL)
      WHERE n > 1),
    covered AS (
      SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(3) r(k) GROUP BY doc_id),
    split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
    dup AS (
      SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM split WHERE trim(line, {blanks}) <> '' GROUP BY doc_id),
    base AS (
      SELECT doc_id, lang, text, len(ws) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda w: len(w))), 0) AS BIGINT) AS word_chars,
        len(regexp_replace(text, '[^{SYMBOLS}]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM docs LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)),
    measured AS (
      SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        n_words >= {LEAST_WORDS} AND len(text) >= {LEAST_CHARS} AS compared FROM base),
    common(word, place) AS (VALUES {words}),
    known AS (
      SELECT doc_id, coalesce(place, {last}) AS place, count(*) AS n
      FROM tokens LEFT JOIN common
        ON strlen(w) < 12 AND word = trim(translate(w, '{up}', '{low}'), '.,;:!?"''()')
      GROUP BY ALL),
    classed AS (
      SELECT doc_id, unnest([{", ".join(counts)}]) AS n, unnest(range({N_CLASSES})) AS place
      FROM measured WHERE compared),
    every AS (
      SELECT doc_id, lang, place FROM measured, range({last + 1}) r(place) WHERE compared),
    filled AS (
      SELECT doc_id, lang, place, place < {N_CLASSES} AS is_char, CAST(coalesce(c.n, k.n, 0) AS BIGINT) AS n
      FROM every LEFT JOIN classed c USING (doc_id, place) LEFT JOIN known k USING (doc_id, place)),
    shares AS (
      SELECT *, sum(n) OVER (PARTITION BY doc_id, is_char) AS total FROM filled),
    sums AS (
      SELECT lang, place, is_char, CAST(sum(n * {UNIT} // CAST(total AS BIGINT)) AS DOUBLE) AS v
      FROM shares WHERE lang IN ({langs}) GROUP BY ALL),
    refs AS (
      SELECT lang AS near, place, v / sum(v) OVER (PARTITION BY lang, is_char) AS r FROM sums),
    terms AS (
      SELECT doc_id, near, is_char, n / total AS p, r, (n / total + r) / 2 AS m
      FROM shares JOIN refs USING (place)),
    distances AS (
      SELECT doc_id, near, is_char,
        sqrt(greatest(0, (sum(CASE WHEN p > 0 THEN p * log2(p / m) ELSE 0 END)
          + sum(CASE WHEN r > 0 THEN r * log2(r / m) ELSE 0 END)) / 2)) AS d
      FROM terms GROUP BY ALL),
    nearest AS (
      SELECT doc_id, near, max(d) FILTER (is_char) AS c, max(d) FILTER (NOT is_char) AS w
      FROM distances GROUP BY doc_id, near
      QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(c + w, 9), near) = 1)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      near AS nearest, round(c, 6) AS char_distance, round(w, 6) AS word_distance,
      NOT base_failed AND (near IS NULL OR (round(c, 6) <= {MOST_CHARS} AND round(w, 6) <= {MOST_WORDS})) AS kept
    FROM measured LEFT JOIN nearest USING (doc_id)"""
