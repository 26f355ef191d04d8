"""Operator 9: long repeated substrings found by a prefix-free parse of all texts, and removed.

A parse cuts the windows of `length` bytes of every text into phrases. The trigger of a window is
the place in it whose rolling hash is least, so equal windows have equal triggers wherever they
are, and neighbouring windows mostly share one; the windows with one trigger make a phrase, whose
bytes reach from the first window's start to the last one's end. Phrases overlap by length - 1
bytes, so every window lies in just one phrase, and the suffixes that matter, those of the corpus
cut to `length` bytes, are those of the dictionary of different phrases, each as often as the
parse has its phrase. What is asked of their order is only which of them are equal, and equal ones
have equal triggers. So the order is kept as its classes, by hash: phrases are grouped by trigger;
a phrase that occurs twice repeats as a whole, and where one trigger has different phrases, the
dictionary's windows are compared one by one. Most triggers of a corpus occur once and end there.
"""

import functools

import numpy as np
import pyarrow as pa
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
    steps,
    table,
    text_bytes,
    text_of,
)

LENGTH = 200
#: Bytes that a trigger's hash covers. More tell more, and make more phrases.
TRIGGER = 56

#: Windows that are compared together before they are compared one by one.
TOGETHER = 8
#: Phrases that share a trigger are compared in so many turns, so that what is written stays small.
TURNS = 2

KEY = ["ka", "kb"]


def _shape(n: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """A number of windows, and how far before the trigger the first starts, as one number."""
    return (n << 16) | lead


def keys(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    digest = F.sha2(text, 256)
    part = [F.conv(F.substring(digest, k, 16), 16, -10).cast("long") for k in (1, 17)]
    return [p.alias(k) for p, k in zip(part, KEY, strict=True)]


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """What to hash at once: rows of small texts, or a piece of a long one.

    Each is its first byte and where its texts start (one more), all in bytes of the batch; pieces
    overlap by length - 1 bytes, so each window is in one.
    """
    out = []
    for first, last in steps(starts):
        begin, end = int(starts[first]), int(starts[last])
        if end - begin <= 2 * STEP_BYTES:
            out.append((first, starts[first : last + 1]))
            continue
        for at in range(begin, max(begin + 1, end - length + 1), STEP_BYTES):
            out.append((first, np.array([at, min(end, at + STEP_BYTES + length - 1)])))
    return out


def phrases(rolling: Rolling, data: np.ndarray, starts: np.ndarray, length: int, trigger: int):
    """The phrases of texts that stand one after the other in `data`.

    Arrays: number of the text, trigger's hash, phrase's hash, first window's start within `data`,
    number of windows, bytes from there to the trigger.
    """
    rolling.load(data)
    grams = rolling.grams(trigger)
    width = length - trigger + 1  # triggers that a window may have
    none = np.empty(0, np.int64)
    if len(grams) < width:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    places = np.arange(len(grams), dtype=np.uint64)
    bits = np.uint64(max(1, int(len(grams) - 1).bit_length()))
    # the least hash, and of equal ones the first place
    least = ((grams >> bits) << bits) | places
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    ends = starts[1:] - starts[0]
    begin = np.arange(len(least))
    text = np.searchsorted(ends, begin, "right")
    inside = begin + length <= ends[text]
    begin, text, least = begin[inside], text[inside], least[inside]
    if not len(begin):
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    new = np.ones(len(begin), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(begin)))
    at = begin[first]
    place = (least[first] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return text[first], grams[place], rolling.of(at, at + sizes - 1 + length), at, sizes, place - at


def parse(docs: DataFrame, length: int, trigger: int) -> DataFrame:
    """All phrases of all texts: the text's key, `g` (trigger), `s` (phrase), `at`, `shape`."""

    def compute():
        rolling = Rolling()

        def step(batch: pa.RecordBatch):
            raw, starts = text_bytes(batch.column("text"))
            ka, kb = (batch.column(k).to_numpy() for k in KEY)
            for row, bounds in _runs(starts, length):
                data = raw[bounds[0] : bounds[-1]]
                text, g, s, at, n, lead = phrases(rolling, data, bounds, length, trigger)
                rows = row + text
                yield {
                    "ka": ka[rows],
                    "kb": kb[rows],
                    "g": g.view(np.int64),
                    "s": s.view(np.int64),
                    "at": at + bounds[0] - starts[rows],
                    "shape": _shape(n, lead),
                }

        return step

    texts = docs.select(*keys(F.col("text")), "text").where(F.octet_length("text") >= length)
    return emit(texts, "ka long, kb long, g long, s long, at long, shape long", compute)


def _cuts(docs: DataFrame, parts: DataFrame, length: int, trigger: int, together: int) -> DataFrame:
    """Phrases cut into runs of at most `together` windows, at places that the trigger tells.

    `parts` (text's key, `g`, `s`, `at`, `shape`, `alone`) may be phrases or such runs. Rows are the
    same for each run, with `j` (which run it is, seen from the trigger), `outer`, the hash of all
    its bytes, null where the phrase ends within the run, and `core`, that of the bytes that all
    windows of the run have, whether the phrase has them or not.
    """
    lists = parts.groupBy(*KEY).agg(F.collect_list(F.struct("g", "s", "at", "shape", "alone")).alias("parts"))

    def compute():
        rolling, seen = Rolling(0x5851F42D4C957F2D), set()

        def hashes(text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
            out = np.empty(len(start), np.uint64)
            # a piece of the text at a time, so that a long one needs no long arrays
            for low in range(0, len(text), STEP_BYTES):
                here = (start >= low) & (start < low + STEP_BYTES)
                if here.any():
                    rolling.load(text[low : low + STEP_BYTES + length + together])
                    out[here] = rolling.of(start[here] - low, stop[here] - low)
            return out

        def step(batch: pa.RecordBatch):
            ka, kb = (batch.column(k).to_numpy() for k in KEY)
            for row in range(batch.num_rows):
                # copies of a text would come with the same rows: a task makes them once
                if (own := (int(ka[row]), int(kb[row]))) in seen:
                    continue
                seen.add(own)
                text = np.frombuffer(batch.column("text")[row].as_py().encode(), np.uint8)
                fields = batch.column("parts")[row].values
                g, s, at, shape, alone = (
                    fields.field(k).to_numpy(zero_copy_only=False)
                    for k in ("g", "s", "at", "shape", "alone")
                )
                # phrases and runs of one text start at different places, but may be listed again
                once = np.unique(at, return_index=True)[1]
                g, s, at, shape, alone = (x[once] for x in (g, s, at, shape, alone))
                n, lead = shape >> 16, shape & 0xFFFF
                # the first window is `lead` before the trigger, the last lead - n + 1
                low, high = (lead - n + 1) // together, lead // together
                runs = high - low + 1
                owner = np.repeat(np.arange(len(n)), runs)
                j = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs) + low[owner]
                most = np.minimum(lead[owner], (j + 1) * together - 1)
                least = np.maximum((lead - n + 1)[owner], j * together)
                place = (at + lead)[owner]
                whole = most - least + 1 == together
                begin = place - most
                last = np.minimum((j + 1) * together - 1, length - trigger)
                core = hashes(text, place - j * together, place - last + length)
                outer = hashes(text, begin, place - least + length)
                yield {
                    "ka": np.full(len(owner), ka[row]),
                    "kb": np.full(len(owner), kb[row]),
                    "g": g[owner],
                    "s": s[owner],
                    "at": begin,
                    "shape": _shape(most - least + 1, most),
                    "alone": pa.array(alone[owner]),
                    "j": j,
                    "outer": pa.array(outer.view(np.int64), mask=~whole),
                    "core": core.view(np.int64),
                }

        return step

    texts = docs.select(*keys(F.col("text")), "text").join(lists, KEY)
    schema = "ka long, kb long, g long, s long, at long, shape long, alone boolean, j long, outer long, core long"
    return emit(texts.select(*KEY, "text", "parts"), schema, compute)


def _shared(runs: DataFrame, name: str) -> DataFrame:
    """The values of `name` that runs of different phrases of one trigger have in one place."""
    ends = runs.groupBy("g", "j", name).agg(F.min("s").alias("a"), F.max("s").alias("b"))
    return ends.where("a <> b").select("g", "j", name)


def repeated(docs: DataFrame, length: int = LENGTH, trigger: int = TRIGGER) -> DataFrame:
    """Where windows of `length` bytes start that also start elsewhere: text's key, `at`, `n` of them.

    `docs` has `text` without nulls. Texts are told apart by key; each row of `docs` counts as a
    document, so a text that is there twice repeats all its windows.
    """
    found = kept(parse(docs, length, trigger), "phrases")
    twice = found.groupBy("g").agg(F.count("*").alias("times")).where("times > 1").select("g")
    # copies of a text have the same rows; they are counted before anything is joined by phrase
    places = [*KEY, "g", "s", "at", "shape"]
    hits = found.join(twice, "g").groupBy(*places).agg(F.count("*").alias("times"))
    hits = kept(hits, "repeated-phrases")
    dropped(found)
    kinds = hits.groupBy("g", "s").agg(F.sum("times").alias("times"), F.min("ka").alias("least"))
    kinds = kept(kinds, "phrase-kinds")
    n = F.shiftright("shape", 16).alias("n")
    whole = hits.join(kinds.where("times > 1").select("g", "s"), ["g", "s"]).select(*KEY, "at", n)
    # one trigger, different phrases: of each phrase, one text's
    mixed = kinds.groupBy("g").agg(F.count("*").alias("kinds")).where("kinds > 1").select("g")
    alone = (F.col("times") == 1).alias("alone")
    chosen = kinds.join(mixed, "g").select("g", "s", F.col("least").alias("ka"), alone)
    chosen = kept(hits.drop("times").join(chosen, ["g", "s", "ka"]), "mixed-phrases")
    settled = [kept(whole, "repeated-places")]
    dropped(hits, kinds)
    for turn in range(TURNS):
        part = chosen.where(F.pmod("g", F.lit(TURNS)) == turn)
        settled.append(_shared_windows(docs, part, length, trigger))
    dropped(chosen)
    return functools.reduce(DataFrame.unionByName, settled)


def _shared_windows(docs: DataFrame, chosen: DataFrame, length: int, trigger: int) -> DataFrame:
    """Windows of phrases that occur once (`alone`) which another phrase of their trigger has too.

    A phrase has no window twice, so a window is elsewhere if two phrases have it. Runs of windows
    whose bytes two phrases have are settled; so are those whose core just one has.
    """
    n = F.shiftright("shape", 16).alias("n")
    runs = kept(_cuts(docs, chosen, length, trigger, TOGETHER), "window-runs")
    same = _shared(runs.where("outer is not null"), "outer").withColumn("same", F.lit(True))
    near = runs.join(_shared(runs, "core"), ["g", "j", "core"]).join(same, ["g", "j", "outer"], "left")
    near = kept(near, "near-runs")
    dropped(runs)
    several = near.where("same and alone").select(*KEY, "at", n)
    unsettled = near.where("same is null and alone").select("g", "j", "core").distinct()
    rest = near.join(unsettled, ["g", "j", "core"], "left_semi").select(*KEY, "g", "s", "at", "shape", "alone")
    windows = _cuts(docs, rest, length, trigger, 1).drop("core", "shape")
    windows = kept(windows.withColumn("n", F.lit(1).cast("long")), "windows")
    single = windows.where("alone").join(_shared(windows, "outer"), ["g", "j", "outer"])
    places = kept(several.unionByName(single.select(*KEY, "at", "n")), "shared-windows")
    dropped(near, windows)
    return places


SPAN = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def merged(at: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes that windows from `at` on, `n` each, cover."""
    order = np.argsort(at, kind="stable")
    start, end = at[order], np.maximum.accumulate(at[order] + n[order] - 1 + length)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(start)) - 1]


def remove_repeated(
    docs: DataFrame, length: int = LENGTH, trigger: int = TRIGGER, text: str = "text"
) -> DataFrame:
    """`docs` with `removed` (maximal byte spans of the UTF-8 text) and `kept` (all other bytes).

    A byte is removed if a string of `length` bytes that covers it also starts anywhere else, in
    the same document too, judged on the texts as they come; strings never cross documents. All
    copies lose what they share: nothing marks one as the first. Null texts are empty, texts
    under `length` bytes lose nothing. Repeated rows are documents of their own. Columns `removed` and
    `kept` of `docs` are replaced; an empty table stays empty.
    """
    content, found, *own = (fresh(docs, n) for n in ("content", "found", *KEY))
    whole = docs.withColumn(content, text_of(text))
    places = repeated(whole.select(F.col(content).alias("text")), length, trigger).distinct()
    places = places.groupBy(*[F.col(k).alias(n) for k, n in zip(KEY, own, strict=True)])
    places = places.agg(F.collect_list(F.struct("at", "n")).alias(found))
    # texts that are too short have no places; they need not meet in one task
    long_enough = F.octet_length(content) >= length
    keyed = whole.withColumns(dict(zip(own, keys(F.col(content)), strict=True)))
    joined = keyed.where(long_enough).join(places, own, "left")
    rest = keyed.where(~long_enough).withColumn(found, F.lit(None).cast(joined.schema[found].dataType))
    joined = joined.select(*rest.columns).unionByName(rest).drop(*own)

    def compute():
        def step(batch: pa.RecordBatch) -> list:
            spans, rest = [], []
            for one, windows in zip(batch.column(0), batch.column(1), strict=True):
                data = one.as_py().encode()
                if not windows.is_valid:
                    spans.append([])
                    rest.append(data)
                    continue
                at, n = (windows.values.field(k).to_numpy(zero_copy_only=False) for k in ("at", "n"))
                begin, end = merged(at, n, length)
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(begin, end, strict=True)])
                edges = zip([0, *end], [*begin, len(data)], strict=True)
                rest.append(b"".join(data[a:b] for a, b in edges))
            return [pa.array(spans, _SPAN_ARROW), pa.array(rest, pa.binary())]

        return step

    inputs = {"text": F.col(content), "places": F.col(found)}
    fields = [T.StructField("removed", SPAN), T.StructField("kept", T.BinaryType())]
    return attach(joined, inputs, fields, compute).drop(content, found)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = remove_repeated(docs)
    size = F.octet_length(text_of()).cast("long")
    return done.select(
        "doc_id",
        size.alias("n_bytes"),
        (size - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
