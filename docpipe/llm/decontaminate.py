"""Operator 6: benchmark items found in documents by SimHash fingerprints of windows of their size.

A window of a document has as many words as the item, or is the whole of a shorter document. Its fingerprint is the sign of the sums that
its shingles add to 64 counters; fingerprints within RADIUS bits of the item's are found by an
index of their eight bytes, since one byte then differs in at most RADIUS // 8 bits; the windows
left are compared with the item by exact similarity of weighted shingles. Similarity is 0 without
a common shingle, so only windows around places that have a shingle of some item are looked at.

A shingle of an item weighs one over the number of different item texts of the whole benchmark that
have it, so repeats of a text take no weight from it. Shingles that the item has not weigh as much as
its own on the mean, so an edit of what many items share counts no more than elsewhere. Fingerprints
have no weights: they and the similarity to an item depend on nothing but the two texts and these
numbers, and not on the block that the item is in.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.llm.common import (
    STEP_BYTES,
    Rolling,
    attach,
    dropped,
    emit,
    fresh,
    kept,
    shingle_hashes,
    steps,
    table,
    text_bytes,
    text_of,
)

SHINGLE = 5
LEAST = 0.8
#: Bits in which fingerprints may differ. At similarity 0.8 about 10 do, at most 18 in trials.
RADIUS = 23
#: Items that one pass over the documents looks for; more items take more passes.
BLOCK = 50_000

# Bytes of words: ASCII letters, digits and underscores, and all of other characters.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_"]] = True
_IN_WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Letters:
    """Texts in lower case, with blanks for what is not in words of `\\w+`."""

    def __init__(self):
        points = np.arange(0x110000, dtype="<u4")
        points = points[(points < 0xD800) | (points > 0xDFFF)]
        self.word = np.zeros(0x110000, bool)
        for run in re.finditer(r"\w+", points.tobytes().decode("utf-32-le")):
            self.word[points[run.start() : run.end()]] = True

    def fold(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts, and where they start, of which `split_words` makes the words of `\\w+` of text.lower()."""
        if not (raw[starts[0] : starts[-1]] >= 0x80).any():
            return raw, starts
        texts = [raw[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
        texts = [t if t.isascii() else t.decode("utf-8", "replace").lower().encode() for t in texts]
        data = np.frombuffer(bytearray(b"".join(texts)), np.uint8)
        # a piece at a time, as in `split_words`
        for begin in range(0, len(data), STEP_BYTES):
            lead = np.flatnonzero(data[begin : begin + STEP_BYTES] >= 0xC0) + begin
            length = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
            for size in (2, 3, 4):
                at = lead[length == size]
                point = data[at].astype(np.uint32) & np.uint32(0x7F >> size)
                for k in range(1, size):
                    point = point << np.uint32(6) | (data[at + k] & np.uint8(0x3F))
                word = self.word[point]
                for k in range(size):
                    data[at[~word] + k] = 0x20
                # words may have some of U+0080 to U+00BF: those become marks that are blanks above
                data[at[word & (point < 0xC0)]] = 0xCC
        return data, np.cumsum([0, *map(len, texts)])


def split_words(rolling: Rolling, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of some texts, and the number of its text.

    Words are runs of ASCII letters (A-Z as a-z), digits, underscores and characters from U+00C0
    on without the marks from U+2000 to U+203F. `raw` is UTF-8, `starts` where texts start in it.
    Of texts that `Letters.fold` made, these are the words of `\\w+`.
    """
    data = _LOWER[raw[starts[0] : starts[-1]]]
    inside = _IN_WORD[data]
    # the first byte of U+0080 to U+00BF, then the first two of U+2000 to U+203F
    for place, length in ((np.flatnonzero(data == 0xC2), 2), (np.flatnonzero(data == 0xE2), 3)):
        if length == 3:
            place = place[data[place + 1] == 0x80]
        for k in range(length):
            inside[place + k] = False
    edge = np.zeros(len(data) + 1, bool)
    edge[starts - starts[0]] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(begin), np.uint64)
    # a piece at a time, so that a long text needs no long arrays of numbers
    cuts = np.searchsorted(begin, np.arange(0, len(data) + STEP_BYTES, STEP_BYTES))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a < b:
            rolling.load(data[begin[a] : end[b - 1]])
            hashes[a:b] = rolling.of(begin[a:b] - begin[a], end[a:b] - begin[a])
    return hashes, np.searchsorted(starts - starts[0], begin, "right") - 1


def words_of(text: str, rolling: Rolling, letters: Letters | None = None) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    return split_words(rolling, *(letters or Letters()).fold(raw, np.array([0, len(raw)])))[0]


def fingerprints(shingles: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """The SimHash of each run of `size` shingles."""
    shifts = np.arange(64, dtype=np.uint64)
    signs = ((shingles[:, None] >> shifts) & np.uint64(1)).astype(np.float32) * 2 - 1
    sums = np.zeros((len(shingles) + 1, 64))
    np.cumsum(signs * weights[:, None], axis=0, out=sums[1:])
    # sums of the same shingles must not differ by rounding
    positive = np.round(sums[size:] - sums[:-size], 6) > 0
    return (positive.astype(np.uint64) << shifts).sum(axis=1, dtype=np.uint64)


class HammingIndex:
    """Fingerprints by the values of their eight bytes."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        self.cut = prints.astype("<u8").view(np.uint8).reshape(-1, 8)
        self.found: dict[tuple[int, int], np.ndarray] = {}

    def near(self, place: int, value: int) -> np.ndarray:
        """The items whose byte there differs from `value` in few enough bits; kept for next time."""
        key = (place, value)
        if key not in self.found:
            differ = np.bitwise_count(self.cut[:, place] ^ np.uint8(value))
            self.found[key] = np.flatnonzero(differ <= self.radius // 8)
        return self.found[key]

    def within(self, value: np.uint64) -> np.ndarray:
        """The numbers of all fingerprints within the radius."""
        cut = np.array([value], "<u8").view(np.uint8)
        some = np.unique(np.concatenate([self.near(k, int(b)) for k, b in enumerate(cut)]))
        return some[np.bitwise_count(self.prints[some] ^ value) <= self.radius]


class Items:
    """A block of benchmark items, by their number of words."""

    def __init__(self, items: list[tuple[int, str]], shared: dict[int, int], letters: Letters):
        rolling = Rolling()
        self.sizes: dict[int, list] = {}
        sets = []
        for item_id, text in items:
            words = words_of(text, rolling, letters)
            if len(words):
                sets.append((item_id, len(words), shingle_hashes(words, SHINGLE)))
        together = [np.unique(s) for _, _, s in sets] or [np.empty(0, np.uint64)]
        # a shingle of many items says less: it weighs one over their number
        self.known = np.unique(np.concatenate(together))
        self.weight = 1 / np.array([shared.get(s, 1) for s in self.known.tolist()], float)
        self.owners: dict[int, set[int]] = {}
        for item_id, size, shingles in sets:
            self.sizes.setdefault(size, []).append((item_id, shingles))
            for s in shingles:
                self.owners.setdefault(int(s), set()).add(size)
        self.index = {}
        for size, members in self.sizes.items():
            prints = [fingerprints(s, np.ones(len(s)), len(s))[0] for _, s in members]
            self.index[size] = HammingIndex(np.array(prints, np.uint64))
        #: Shingles of short items are shorter.
        self.lengths = sorted({min(size, SHINGLE) for size in self.sizes})
        # a table of bits tells most other shingles at once
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.known & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def places(self, shingles: np.ndarray) -> np.ndarray:
        """Where a shingle of any item stands."""
        at = np.flatnonzero(self.bits[(shingles & np.uint64((1 << 22) - 1)).astype(np.int64)])
        return at[np.isin(shingles[at], self.known)]

    def touched(self, words: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The texts that have a shingle of any item; `owner` is the text of each word."""
        rows = [np.empty(0, np.int64)]
        for length in self.lengths:
            if len(words) >= length:
                at = self.places(shingle_hashes(words, length))
                rows.append(owner[at[owner[at] == owner[at + length - 1]]])
        return np.unique(np.concatenate(rows))

    def similarity(self, a: np.ndarray, b: np.ndarray) -> float:
        """Weighted Jaccard of two bags of shingles, those of a window and of an item."""
        names, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
        in_a = np.bincount(inverse[: len(a)], minlength=len(names))
        in_b = np.bincount(inverse[len(a) :], minlength=len(names))
        own = in_b > 0
        weights = np.empty(len(names))
        weights[own] = self.weight[np.searchsorted(self.known, names[own])]
        weights[~own] = (weights[own] * in_b[own]).sum() / len(b)
        likeness = (np.minimum(in_a, in_b) * weights).sum() / (np.maximum(in_a, in_b) * weights).sum()
        # equal ones must not differ by rounding
        return round(float(likeness), 12)

    def leaks(self, words: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """Item, first word, number of words and similarity of the best window of each item found."""
        for length in self.lengths:
            if len(words) < length:
                continue
            shingles = shingle_hashes(words, length)
            places = self.places(shingles)
            by_size: dict[int, set[int]] = {}
            for place in places:
                for size in self.owners[int(shingles[place])]:
                    if min(size, SHINGLE) == length:
                        # a text with fewer words than the item is one window
                        n_words = min(size, len(words))
                        first = max(0, int(place) - n_words + length)
                        last = min(int(place), len(words) - n_words)
                        by_size.setdefault(size, set()).update(range(first, last + 1))
            for size, begins in by_size.items():
                n_words = min(size, len(words))
                yield from self._windows(shingles, size, n_words, n_words - length + 1, sorted(begins))

    def _windows(self, shingles: np.ndarray, size: int, n_words: int, span: int, begins: list[int]):
        best: dict[int, tuple[float, int]] = {}
        index, members = self.index[size], self.sizes[size]
        begins = np.array(begins)
        # runs of windows that overlap share their sums
        for run in np.split(begins, np.flatnonzero(np.diff(begins) > 1) + 1):
            part = shingles[run[0] : run[-1] + span]
            for begin, value in zip(run, fingerprints(part, np.ones(len(part)), span), strict=True):
                for k in index.within(value):
                    likeness = self.similarity(shingles[begin : begin + span], members[k][1])
                    if likeness >= LEAST and likeness > best.get(k, (0.0, 0))[0]:
                        best[k] = (likeness, int(begin))
        for k, (likeness, begin) in best.items():
            yield members[k][0], begin, n_words, likeness


LEAKS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
)
_LEAKS_ARROW = pa.list_(
    pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64())])
)


def _shared(items: DataFrame, own: Column) -> DataFrame:
    """Shingles of more than one item text: the number `n` of those texts, and the blocks `parts` that have it."""

    def compute():
        rolling, letters = Rolling(), Letters()

        def step(batch: pa.RecordBatch) -> Iterator[dict]:
            for part, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text, rolling, letters)
                names = np.unique(shingle_hashes(words, SHINGLE)).view(np.int64)
                item = np.full(len(names), xxhash.xxh3_64_intdigest(words.tobytes()), np.uint64)
                yield {
                    "part": np.full(len(names), part, np.int32),
                    "item": item.view(np.int64),
                    "shingle": names,
                }

        return step

    rows = emit(items.select(own.cast("int"), "text"), "part int, item long, shingle long", compute)
    counts = rows.groupBy("shingle").agg(F.count_distinct("item").alias("n"), F.collect_set("part").alias("parts"))
    return counts.where(F.col("n") > 1)


def _with_block(docs: DataFrame, items: list[tuple[int, str]], shared: dict[int, int], name: str) -> DataFrame:
    def compute():
        rolling, letters = Rolling(), Letters()
        block = Items(items, shared, letters)

        def step(batch: pa.RecordBatch) -> list:
            raw, starts = text_bytes(batch.column(0))
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for first, last in steps(starts):
                words, owner = split_words(rolling, *letters.fold(raw, starts[first : last + 1]))
                for row in block.touched(words, owner):
                    own = slice(*np.searchsorted(owner, [row, row + 1]))
                    found = sorted(block.leaks(words[own]))
                    out[first + row] = [
                        dict(zip(("item_id", "start", "n_words", "similarity"), x, strict=True)) for x in found
                    ]
            return [pa.array(out, _LEAKS_ARROW)]

        return step

    return attach(docs, {"text": text_of()}, [T.StructField(name, LEAKS)], compute)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, block: int = BLOCK, name: str = "leaks"
) -> DataFrame:
    """`docs` with `leaks`, or another `name`: for each benchmark item found its best window and similarity.

    Words are `\\w+` in lower case, by Unicode; shingles have five words, and a shorter item is one shingle. An
    item is found if a window of its number of words, or a document with fewer words, has a fingerprint within RADIUS bits and a
    weighted Jaccard similarity of LEAST or more. Ties go to the first window. Texts are read
    whole; null texts and items, and those without words, match nothing; nor do items with null
    ids. An item that is there twice is found twice. Items are broadcast in blocks of about `block`
    rows, chosen by hash, each with a pass of its own; blocks do not change what is found. A column of `docs` with that
    name is replaced;
    an empty table stays empty, and an empty benchmark finds nothing.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    items = items.where(F.col("item_id").isNotNull() & (F.col("text") != ""))
    blocks = max(1, -(-items.count() // block))
    own = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    names = [fresh(docs, f"part{k}") for k in range(blocks)]
    counts = kept(_shared(items, own), "shared-shingles")
    for k, part in enumerate(names):
        rows = items.where(own == k).collect() if blocks > 1 else items.collect()
        some = counts.where(F.array_contains("parts", k)).select("shingle", "n").collect()
        shared = {r["shingle"] % (1 << 64): r["n"] for r in some}
        docs = _with_block(docs, sorted((r["item_id"], r["text"]) for r in rows), shared, part)
    dropped(counts)
    rest = [c for c in docs.columns if c not in names and c.lower() != name.lower()]
    return docs.select(*[F.col(f"`{c}`") for c in rest], F.array_sort(F.concat(*names)).alias(name))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found, with the columns they had."""
    name = fresh(docs, "found")
    return find_leaks(docs, benchmark, name=name).where(F.size(name) == 0).drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and item found in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", "leak.item_id", "leak.start", "leak.n_words", F.round("leak.similarity", 6).alias("similarity")
    )
