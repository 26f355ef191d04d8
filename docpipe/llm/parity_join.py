"""Operator 4: documents with similar sets of word shingles, joined by parity sketches.

Every shingle flips one bit of a sketch, so two sketches differ in no more bits than the sets
differ in shingles. Sets of sizes a and b have a Jaccard similarity of p percent or more just if
they differ in at most (100 - p) * (a + b) / (100 + p) shingles. In a band of sizes that makes a
most of D, and of any D + 1 blocks of one sketch the other then has at least one too: blocks are
the keys of the join. A sketch has a few blocks more, so that each set can leave out those that
the fewest shingles fall into, which say least. Pairs with a common block are tested by the
distance of short sketches of the whole sets, and what is left by the sets themselves.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.llm.common import (
    WORD,
    WordHashes,
    attach,
    dropped,
    emit,
    fresh,
    kept,
    mixed,
    settle,
    shingle_hashes,
    table,
    text_of,
)
from docpipe.llm.components import components

#: Each band of sizes ends at this times its begin.
BAND = 1.6
#: 64-bit words of the short sketch of a whole set.
SHORT = 16
#: Sets of more than so many shingles would fill it; they have a wide one too, of so many words.
LARGE, WIDE = 1500, 128
#: Keys are joined in so many turns, so that what one turn shuffles stays small.
TURNS = 4
#: In the second round, each set of a key is compared with about so many of them.
LEADERS = 4
#: Sets of a key that meet in one step of the last round; more sets make more steps.
TILE = 1024
#: Bits of the largest filter that is sent to all tasks (32 MB).
MOST_BITS = 1 << 28


def most_different(a: int, b: int, percent: int) -> int:
    """In how many elements sets of these sizes may differ."""
    return (100 - percent) * (a + b) // (100 + percent)


class Bands:
    """Bands of set sizes, and the number of blocks of a sketch in each."""

    def __init__(self, percent: int):
        self.percent = percent
        # two sets that are similar enough lie in one band or in neighbours
        self.ratio = max(BAND, 101 / percent)
        self.begins = [1]

    def band(self, size: int) -> int:
        while self.begins[-1] <= size:
            self.begins.append(max(self.begins[-1] + 1, int(self.begins[-1] * self.ratio) + 1))
        return int(np.searchsorted(self.begins, size, "right")) - 1

    def needed(self, band: int) -> int:
        """One more than the most by which a set of the band and a larger one may differ."""
        largest = self.begins[band + 1] - 1
        return most_different(largest, largest * 100 // self.percent, self.percent) + 1

    def blocks(self, band: int) -> int:
        """The blocks of a sketch: a quarter more than needed."""
        needed = self.needed(band)
        return needed + needed // 4 + (needed > 1)

    def of(self, size: int) -> list[int]:
        """The bands where a set meets those as small or smaller, and those as large or larger."""
        own = self.band(size)
        below = self.band(-(-size * self.percent // 100))
        return [own] if own == below else [below, own]


def shingle_set(text: str, size: int, hashes: WordHashes) -> np.ndarray:
    """Hashes of the distinct word shingles, sorted; A-Z count as a-z."""
    words = hashes.of(text.encode().lower().split())
    return np.unique(shingle_hashes(words, size))


def parities(numbers: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """64-bit words: number k flips bit `numbers[k] >> 58` of word `places[k]`."""
    out = np.zeros(length, np.uint64)
    if len(numbers):
        order = np.argsort(places, kind="stable")
        places = places[order]
        bits = np.uint64(1) << (numbers[order] >> np.uint64(58))
        first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        out[places[first]] = np.bitwise_xor.reduceat(bits, first)
    return out


def block_keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys of the fullest blocks of the sketches of a set: equal for equal blocks of a band only.

    Of each sketch these are the blocks with at least as many shingles as the last of those needed
    has. Of two sets that are similar enough, the one that asks for more shingles has a block that
    the other has too, with as many shingles, so both have its key. A key also holds the XOR of
    the block's shingles, which equal blocks of similar sets share, and others hardly ever.
    """
    out = []
    for band in bands.of(len(shingles)):
        blocks, needed = bands.blocks(band), bands.needed(band)
        numbers = mixed(shingles + np.uint64(band + 1))
        places = (numbers % np.uint64(blocks)).astype(np.int64)
        order = np.argsort(places, kind="stable")
        sizes = np.bincount(places, minlength=blocks)
        begins = np.cumsum(sizes) - sizes
        some = np.flatnonzero(sizes)
        words, whole = np.zeros(blocks, np.uint64), np.zeros(blocks, np.uint64)
        bits = np.uint64(1) << (numbers[order] >> np.uint64(58))
        words[some] = np.bitwise_xor.reduceat(bits, begins[some])
        whole[some] = np.bitwise_xor.reduceat(numbers[order], begins[some])
        full = sizes >= np.partition(sizes, blocks - needed)[blocks - needed]
        name = mixed(np.arange(blocks, dtype=np.uint64) + (np.uint64(band) << np.uint64(40)))
        out.append(mixed(mixed(words ^ name) ^ whole)[full])
    return np.concatenate(out)


def digest(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    hexed = F.sha2(text, 256)
    return [F.conv(F.substring(hexed, k, 16), 16, -10).cast("long") for k in (1, 17)]


def _sketched(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The text's digest `ka`, `kb`, set size `n`, short sketch and keys of each row."""

    def compute():
        hashes, bands = WordHashes(), Bands(percent)

        def step(batch: pa.RecordBatch) -> list:
            sizes, shorts, wides, found = [], [], [], []
            for content in batch.column(0):
                shingles = shingle_set(content.as_py(), size, hashes)
                sizes.append(len(shingles))
                numbers = mixed(shingles)
                shorts.append(parities(numbers, (numbers % np.uint64(SHORT)).astype(np.int64), SHORT))
                wide = WIDE if len(shingles) > LARGE else 0
                places = (numbers % np.uint64(WIDE)).astype(np.int64) if wide else numbers[:0]
                wides.append(parities(numbers[: len(places)], places, wide))
                found.append(block_keys(shingles, bands) if len(shingles) else numbers)

            def lists(arrays: list[np.ndarray]) -> pa.ListArray:
                ends = np.cumsum([0] + [len(a) for a in arrays])
                flat = np.concatenate([*arrays, np.empty(0, np.uint64)]).view(np.int64)
                return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

            return [pa.array(sizes, pa.int64()), *map(lists, (shorts, wides, found))]

        return step

    ka, kb = digest(F.col("text"))
    thin = docs.select(ka.alias("ka"), kb.alias("kb"), F.col("text").alias("__text"))
    longs = T.ArrayType(T.LongType())
    fields = [T.StructField("n", T.LongType())]
    fields += [T.StructField(name, longs) for name in ("short", "wide", "keys")]
    return attach(thin, {"text": F.col("__text")}, fields, compute).drop("__text")


def _filter(wanted: DataFrame, bits: int) -> np.ndarray:
    """A bit for each value of `ka` modulo `bits`: does any of the wanted texts have it?

    Spark builds it in pieces of 4 KB; the driver gets `bits / 8` bytes at most.
    """
    place = F.pmod("ka", F.lit(bits))
    piece, bit = F.floor(place / 32768).cast("int").alias("piece"), F.pmod(place, F.lit(32768))
    pieces = wanted.groupBy(piece).agg(F.bitmap_construct_agg(bit).alias("b"))
    out = np.zeros(bits // 8, np.uint8)
    for row in pieces.toLocalIterator():
        out[row.piece * 4096 : (row.piece + 1) * 4096] = np.frombuffer(row.b, np.uint8)
    return out


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The shingle sets, as bytes, of the texts in `wanted` (`ka`, `kb`).

    A filter of bounded size, sent to all tasks, passes over most other texts, so that sets and not
    texts meet `wanted`. With more texts than such a filter can tell apart, texts are joined first.
    """
    count = wanted.count()
    bits = 1 << max(18, (16 * count).bit_length())
    ka, kb = digest(F.col("text"))
    texts = docs.select(ka.alias("ka"), kb.alias("kb"), "text")
    bitmap = None
    if bits <= MOST_BITS:
        bitmap = _filter(wanted, bits)
    else:
        texts = texts.join(wanted, ["ka", "kb"], "left_semi")

    def compute():
        hashes = WordHashes()

        def step(batch: pa.RecordBatch):
            if bitmap is not None:
                place = batch.column(0).to_numpy() % bits
                batch = batch.filter(pa.array(bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1))
            # a few at a time, so that sets of long texts do not pile up
            for first in range(0, batch.num_rows, 256):
                rows = batch.slice(first, 256)
                sets = [shingle_set(t.as_py(), size, hashes).tobytes() for t in rows.column(2)]
                yield {"ka": rows.column(0), "kb": rows.column(1), "shingles": pa.array(sets, pa.binary())}

        return step

    found = emit(texts, "ka long, kb long, shingles binary", compute)
    if bitmap is not None:
        found = found.join(wanted, ["ka", "kb"], "left_semi")
    return found.dropDuplicates(["ka", "kb"])


def _similar(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs `u`, `v` whose sets `a`, `b` are similar enough."""

    def compute():
        def step(batch: pa.RecordBatch):
            good = []
            for one, other in zip(batch.column("a"), batch.column("b"), strict=True):
                a, b = (np.frombuffer(x.as_py(), np.uint64) for x in (one, other))
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * both >= percent * (len(a) + len(b) - both))
            kept_rows = batch.filter(pa.array(good, pa.bool_()))
            yield {"u": kept_rows.column("u"), "v": kept_rows.column("v")}

        return step

    return emit(pairs, "u struct<ka:long,kb:long>, v struct<ka:long,kb:long>", compute)


def _close(differ: Column, percent: int) -> Column:
    """Whether sets of `n_u` and `n_v` shingles may be similar if their sketches differ so much."""
    return differ <= F.floor((100 - percent) * (F.col("n_u") + F.col("n_v")) / (100 + percent))


def _many(rows: DataFrame) -> DataFrame:
    """The keys of `rows` (`key`, `ka`, `kb`) that more than one text has, with those texts."""
    ends = rows.groupBy("key").agg(
        F.min("ka").alias("low"), F.max("ka").alias("high"), F.count("*").alias("k")
    )
    return rows.join(ends.where("low <> high").select("key", "low", "k"), "key")


def _close_pairs(live: DataFrame, percent: int) -> DataFrame:
    """Pairs `u`, `v` of one key, of different roots, whose short sketches are close enough.

    `live` has `key`, `v`, `root`, `n` and `short`. The sets of a key are dealt over tiles of
    about TILE, and each two tiles meet in one step, where NumPy compares all sketches; only close
    pairs leave it.
    """
    sizes = live.groupBy("key").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    dealt = live.join(sizes, "key").withColumn("t", F.pmod(F.xxhash64("v"), F.col("tiles")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("o")
    dealt = dealt.select("*", other)
    dealt = dealt.select(
        "key", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), "t",
        F.col("v.ka").alias("ka"), F.col("v.kb").alias("kb"), F.xxhash64("root").alias("root"), "n", "short",
    )
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def pairs(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        i, j, t, root, n = (rows.column(k).to_numpy() for k in ("i", "j", "t", "root", "n"))
        short = rows.column("short").flatten().to_numpy().view(np.uint64).reshape(-1, SHORT)
        one, two = np.flatnonzero(t == i[0]), np.flatnonzero(t == j[0])
        differ = np.zeros((len(one), len(two)), np.int32)
        for word in range(SHORT):
            differ += np.bitwise_count(short[one, word][:, None] ^ short[two, word][None, :])
        most = (100 - percent) * (n[one][:, None] + n[two][None, :]) // (100 + percent)
        good = (differ <= most) & (root[one][:, None] != root[two][None, :])
        if i[0] == j[0]:
            good = np.triu(good)
        a, b = np.nonzero(good)
        return one[a], two[b]

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.concat_batches([held, batch]) if held is not None else batch
            names = [rows.column(k).to_numpy() for k in ("key", "i", "j")]
            new = np.zeros(rows.num_rows, bool)
            for values in names:
                new[1:] |= values[1:] != values[:-1]
            begins = np.append(0, np.flatnonzero(new))
            for first, last in zip(begins[:-1], begins[1:], strict=True):
                yield from found(rows.slice(first, last - first))
            held = rows.slice(begins[-1])
        if held is not None:
            yield from found(held)

    node = pa.struct([("ka", pa.int64()), ("kb", pa.int64())])

    def found(rows: pa.RecordBatch):
        if rows.num_rows < 2:
            return
        a, b = pairs(rows)
        if len(a):
            ends = [
                pa.StructArray.from_arrays([rows.column(k).take(pa.array(x)) for k in ("ka", "kb")], fields=list(node))
                for x in (a, b)
            ]
            yield pa.RecordBatch.from_arrays(ends, names=["u", "v"])

    return dealt.mapInArrow(run, "u struct<ka:long,kb:long>, v struct<ka:long,kb:long>").distinct()


def grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """For each row of `docs`: `doc_id`, text's digest `ka`, `kb`, `n_shingles` and group `root`.

    Two documents link if the sets of their distinct shingles of `size` words have a Jaccard
    similarity of `percent` or more; a text with fewer words is one shingle, one without words
    links with nothing and has no root. What links reach has one root. Words are runs without
    blanks of the whole text, A-Z as a-z; null is empty. Rows with one text are one node; each row
    comes back once, repeated ones too. A null doc_id takes part but is never the least unless all
    are null. Other columns of `docs` are not looked at; an empty table stays empty.

    Of the texts with a common key the first round compares all with one, the second those that
    are not yet in one component with about LEADERS, and the last what is left, tile by tile, where
    only pairs with close sketches leave a tile. So copies of one text never make all their pairs.
    """
    settle(docs.sparkSession)
    docs = docs.select("doc_id", text_of().alias("text"))
    work: list[DataFrame] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        work.append(kept(df, name))
        work[-1].role = name
        return work[-1]

    def finish(role: str) -> None:
        done = [t for t in work if t.role == role]
        dropped(*done)
        work[:] = [t for t in work if t.role != role]

    # one row for each text; rows find their text's size again by its digest
    texts = kept(_sketched(docs, size, percent).dropDuplicates(["ka", "kb"]), "sketched-texts")
    sizes = keep(texts.select("ka", "kb", "n"), "sizes")
    shared = None
    for turn in range(TURNS):
        own = texts.where("n > 0").select("ka", "kb", F.explode("keys").alias("key"))
        part = keep(_many(own.where(F.pmod("key", F.lit(TURNS)) == turn)), "shared-keys")
        shared = part if shared is None else shared.unionByName(part)
    involved = keep(shared.select("ka", "kb").distinct(), "involved")
    node = F.struct("ka", "kb")
    short = texts.join(involved, ["ka", "kb"], "left_semi").select(node.alias("v"), "n", "short", "wide")
    short = keep(short, "short-sketches")
    dropped(texts)
    sets = keep(_sets(docs, involved, size).select(node.alias("node"), "shingles"), "shingle-sets")
    members = shared.select(
        "key", "k", node.alias("v"), (F.col("ka") == F.col("low")).alias("first"),
        # the share of all 64-bit numbers below ka: texts of a key come in random order
        (F.col("ka") / F.lit(2.0**64) + F.lit(0.5)).alias("rank"),
    )

    def with_sketches(pairs: DataFrame, name: str) -> DataFrame:
        one = short.select(F.col("v").alias("u"), F.col("n").alias("n_u"), F.col(name).alias("s_u"))
        other = short.select("v", F.col("n").alias("n_v"), F.col(name).alias("s_v"))
        return pairs.join(one, "u").join(other, "v")

    def differing() -> Column:
        bits = F.zip_with("s_u", "s_v", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
        return F.aggregate(bits, F.lit(0), lambda total, count: total + count)

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = keep(pairs, "close-pairs")
        finish("members")
        # what the short sketches of large sets could not tell
        pairs = with_sketches(pairs, "wide")
        narrow = (F.size("s_u") == 0) | (F.size("s_v") == 0)
        pairs = keep(pairs.where(narrow | _close(differing(), percent)).select("u", "v"), "close-pairs")
        with_u = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
        both = with_u.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
        return _similar(both.select("u", "v", "a", "b"), percent)

    def led(live: DataFrame, lead: DataFrame) -> DataFrame:
        """Close pairs of texts with those that lead their key."""
        lead = lead.select("key", F.col("v").alias("u"), F.col("root").alias("root_u"))
        pairs = live.join(lead, "key").where("root <> root_u").select("u", "v").distinct()
        return with_sketches(pairs, "short").where(_close(differing(), percent)).select("u", "v")

    def open_keys(roots: DataFrame) -> DataFrame:
        """The members of keys that are not in one component yet."""
        settle(docs.sparkSession)
        now = members.join(roots.withColumnRenamed("node", "v"), "v", "left")
        now = keep(now.withColumn("root", F.coalesce("root", "v")), "members")
        ends = now.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"))
        return now.join(ends.where("a <> b").select("key"), "key")

    def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
        return components(links.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v"))))

    start = members.withColumn("root", F.col("v"))
    roots = components(verified(led(start, start.where("first"))))
    live = open_keys(roots)
    roots = joined(roots, verified(led(live, live.where(F.col("rank") < F.lit(float(LEADERS)) / F.col("k")))))
    live = open_keys(roots).join(short.drop("wide"), "v")
    roots = joined(roots, verified(_close_pairs(live, percent)))
    ka, kb = digest(F.col("text"))
    rows = docs.select("doc_id", ka.alias("ka"), kb.alias("kb"))
    rows = rows.join(sizes.withColumnRenamed("n", "n_shingles"), ["ka", "kb"])
    rows = rows.select("doc_id", "ka", "kb", "n_shingles")
    out = rows.withColumn("node", node).join(roots, "node", "left")
    root = F.when(F.col("n_shingles") > 0, F.coalesce("root", "node"))
    out = kept(out.withColumn("root", root).drop("node"), "groups")
    dropped(*work)
    return out


def similar_groups(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """For each row of `docs`: `doc_id`, `n_shingles` and `component_id`, the least doc_id that
    links reach, the own one included; see `grouped`. Without words it is the own id."""
    rows = grouped(docs, size, percent)
    least = rows.where("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = rows.where("n_shingles > 0").join(least, "root").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0")
    return linked.unionByName(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one row of each group of `grouped`: that of the least doc_id, null last.

    Of equal ids the text with the least digest stays, and of rows with equal id and text any one.
    Texts without words are groups of their own and all stay.
    """
    text = text_of()
    rows = grouped(docs, size, percent).where("n_shingles > 0")
    # sizes and ids alone are grouped; texts are looked up once, for the rows that stay
    copies = rows.groupBy("root", "doc_id", "ka", "kb").agg(F.count("*").alias("__copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "ka", "kb", "__copies")).alias("x")
    names = [fresh(docs, n) for n in ("stays", "stays_ka", "stays_kb", "copies")]
    fields = ("doc_id", "ka", "kb", "__copies")
    stay = copies.groupBy("root").agg(first)
    stay = stay.select(*[F.col(f"x.{f}").alias(n) for f, n in zip(fields, names, strict=True)])
    ka, kb = digest(text)
    same = F.col("doc_id").eqNullSafe(F.col(names[0])) & (ka == F.col(names[1])) & (kb == F.col(names[2]))
    found = docs.where(text.rlike(WORD)).join(stay, same)
    once = found.where(F.col(names[3]) == 1).select(*docs.columns)
    often = found.where(F.col(names[3]) > 1).dropDuplicates(names[:3]).select(*docs.columns)
    return once.unionByName(often).unionByName(docs.where(~text.rlike(WORD)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"), size=3, percent=90)


def oracle() -> str:
    """The same in DuckDB, by all pairs that share a shingle."""
    low, up = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
    WITH RECURSIVE words AS (
      SELECT doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{up}', '{low}'), '[^\x20\x09-\x0D]+') AS ws
      FROM documents),
    lists AS (
      SELECT doc_id, list_distinct(CASE
        WHEN len(ws) = 0 THEN []
        WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
        END) AS ss
      FROM words),
    shingles AS (SELECT doc_id, len(ss) AS n, unnest(ss) AS s FROM lists),
    links AS (
      SELECT a.doc_id AS a, b.doc_id AS b
      FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n
      HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
    reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT doc_id, any_value(len(ss)) AS n_shingles, least(doc_id, min(b)) AS component_id
    FROM lists LEFT JOIN reach ON a = doc_id
    GROUP BY doc_id"""
