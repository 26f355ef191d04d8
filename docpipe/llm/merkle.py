"""Operator 11: a Merkle manifest of a dataset, its subtrees in van Emde Boas layout.

Rows are leaves, in order within their group; every eight nodes become one until one is left.
Leaves get their place in the group from a sort by range and a running sum over partitions, so no
group is ever one task. Aligned runs of 4,096 leaves are blocks: one task computes all hashes of a
block and lays its nodes out recursively, the upper half of the levels first, then each subtree
below. The roots of the blocks are the leaves of the next tier, and so on; the roots of the groups
make one more tree. Siblings are fetched by the same address arithmetic, tier by tier from above.
"""

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.llm.common import attach, dropped, kept, table

#: Nodes that become one.
FANOUT = 8
#: Edges from a leaf of a full block to its root.
HEIGHT = 4
BLOCK = FANOUT**HEIGHT
#: Bytes of a digest.
SIZE = 32

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tree_size(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes `index` of a depth (the root's is 0) lie in a tree of so many levels.

    The upper half of the levels lies first, laid out by the same rule; then, from left to right,
    the trees below it.
    """
    if levels == 1:
        return np.zeros_like(index)
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, index)
    below = FANOUT ** (depth - upper)
    lower = levels - upper
    return tree_size(upper) + (index // below) * tree_size(lower) + address(lower, depth - upper, index % below)


def widths(leaves: int, levels: int) -> list[int]:
    """The number of nodes at each depth."""
    return [-(-leaves // FANOUT ** (levels - 1 - d)) for d in range(levels)]


def levels_for(leaves: int) -> int:
    """The levels of the tree that ends at one node."""
    levels = 1
    while leaves > 1:
        leaves = -(-leaves // FANOUT)
        levels += 1
    return levels


def laid_out(leaves: np.ndarray, levels: int) -> np.ndarray:
    """All nodes over the leaves (rows of 32 bytes), in layout order, without a tail that none uses."""
    width = widths(len(leaves), levels)
    at = [address(levels, d, np.arange(n)) for d, n in enumerate(width)]
    nodes = np.zeros((max(int(a.max()) for a in at) + 1, SIZE), np.uint8)
    nodes[at[-1]] = leaves
    for depth in range(levels - 2, -1, -1):
        hexed = nodes[at[depth + 1]].tobytes().hex().encode()
        run = FANOUT * SIZE * 2
        digests = [hashlib.sha256(hexed[k : k + run]).digest() for k in range(0, len(hexed), run)]
        nodes[at[depth]] = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, SIZE)
    return nodes


def paths_of(
    nodes: np.ndarray, leaves: int, levels: int, above: bytes, turns: bytes
) -> tuple[list[bytes], list[bytes]]:
    """For each leaf: its siblings, level by level up to the last root, and how many stand before
    and after the node on each level. `above` and `turns` are those of the block's root."""
    proofs, shapes = [above], [turns]
    for depth, width in enumerate(widths(leaves, levels)[1:], 1):
        row = nodes[address(levels, depth, np.arange(width))].tobytes()
        lower, below = [], []
        for first in range(0, width, FANOUT):
            n = min(FANOUT, width - first)
            run = row[first * SIZE : (first + n) * SIZE]
            upper, shape = proofs[first // FANOUT], shapes[first // FANOUT]
            for k in range(n):
                lower.append(run[: k * SIZE] + run[(k + 1) * SIZE :] + upper)
                below.append(bytes((k, n - 1 - k)) + shape)
        proofs, shapes = lower, below
    return proofs, shapes


def folded(leaf: bytes, proof: bytes, turns: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    siblings, at, digest = proof.hex(), 0, leaf
    for k in range(0, len(turns), 2):
        middle, end = (at + n * SIZE * 2 for n in (turns[k], turns[k] + turns[k + 1]))
        digest = hashlib.sha256((siblings[at:middle] + digest.hex() + siblings[middle:end]).encode()).digest()
        at = end
    return digest


def leaf_hash(columns: dict[str, Column]) -> Column:
    """The digest of the values in order: `-` for null, else the bytes of each and the value."""

    def coded(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(coded, columns.values())).cast("binary"), 256))


class Manifest(NamedTuple):
    """`tiers`: the blocks, tier by tier from the leaves; `tops`: each group's root; `upper`: the
    same for the tree over the groups (None in it); `root`: its root, None without rows."""

    tiers: list[DataFrame]
    tops: DataFrame
    upper: "Manifest | None"
    root: bytes | None


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with their place `r` in their group `g`, and the group's size `m`.

    Rows are sorted by range over all tasks and written; the groups that lie in a partition, and
    how many rows of each, give what stands before.
    """
    by = ["g", *order]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = placed.select("*", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part"))
    placed = kept(placed, "merkle-sorted")
    runs = placed.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    within = Window.partitionBy("g")
    before = F.sum("n").over(within.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = runs.select("g", "part", "first", (before - F.col("n")).alias("before"), F.sum("n").over(within).alias("m"))
    out = placed.join(kept(runs, "merkle-runs"), ["g", "part"])
    out = out.select(*rows.columns, "m", (F.col("at") - F.col("first") + F.col("before")).alias("r"))
    out.work = placed
    return out


BLOCKS = T.StructType(
    [
        T.StructField("g", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("m", T.LongType()),
        T.StructField("nodes", T.BinaryType()),
        T.StructField("root", T.BinaryType()),
    ]
)


def _blocks(rows: DataFrame, payload: list[T.StructField]) -> DataFrame:
    """A row for each block of `rows` (`g`, `m`, `r`, `digest`), with the payload of its leaves as lists."""
    lists = [T.StructField(f.name, T.ArrayType(f.dataType)) for f in payload]

    def build(key: tuple, leaves: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("r").combine_chunks()
        m = leaves.column("m")[0].as_py()
        digests = b"".join(leaves.column("digest").to_pylist())
        levels = HEIGHT + 1 if m > BLOCK else levels_for(m)
        nodes = laid_out(np.frombuffer(digests, np.uint8).reshape(-1, SIZE), levels)
        values = [key[0].as_py(), key[1].as_py(), m, nodes.tobytes(), nodes[0].tobytes()]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        columns = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
        for field in payload:
            column = leaves.column(field.name).combine_chunks()
            if isinstance(column, pa.ChunkedArray):
                column = pa.concat_arrays(column.chunks)
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column))
        return pa.Table.from_arrays(columns, names=[*BLOCKS.names, *(f.name for f in lists)])

    own = rows.withColumn("block", F.floor(F.col("r") / BLOCK).cast("long"))
    return own.groupBy("g", "block").applyInArrow(build, T.StructType([*BLOCKS.fields, *lists]))


def _forest(ranked: DataFrame, payload: list[T.StructField]) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of blocks over ranked leaves, and `g`, `root` of all groups."""
    tiers, rows = [], ranked
    while True:
        tiers.append(kept(_blocks(rows, payload), "merkle-blocks"))
        wide = tiers[-1].where(F.col("m") > BLOCK)
        if wide.isEmpty():
            break
        payload = []
        rows = wide.select(
            "g", F.ceil(F.col("m") / BLOCK).cast("long").alias("m"), F.col("block").alias("r"), F.col("root").alias("digest")
        )
    tops = None
    for tier in tiers:
        ended = tier.where(F.col("m") <= BLOCK).select("g", "root")
        tops = ended if tops is None else tops.unionByName(ended)
    return tiers, tops


def group_key(group: Column) -> Column:
    """A text for each group in the groups' order, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def manifest(leaves: DataFrame, payload: list[str]) -> Manifest:
    """The trees over `leaves`: `g` (see `group_key`), `key` (their order), `digest`, and payload.

    Null keys stand first; equal keys are ordered by digest, so equal rows may change places
    unseen. An empty table has no root. The tables that the manifest names stay: they are the
    stored manifest, about a tenth of the size of usual texts.
    """
    fields = [leaves.schema[name] for name in payload]
    ranked = _ranked(leaves, ["key", "digest"])
    tiers, tops = _forest(ranked, fields)
    dropped(ranked.work)
    above = tops.select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("root").alias("digest"))
    ranked = _ranked(above, ["key"])
    upper_tiers, upper_tops = _forest(ranked, [ranked.schema["key"]])
    dropped(ranked.work)
    last = upper_tops.first()
    root = bytes(last.root) if last else None
    return Manifest(tiers, tops, Manifest(upper_tiers, upper_tops, None, root), root)


#: What a block's leaves share: the path over the block's root, and the root of their group.
PATH = [T.StructField(name, T.BinaryType()) for name in ("proof", "turns", "subroot")]


def _spread(blocks: DataFrame, fields: list[T.StructField], with_root: bool) -> DataFrame:
    """A row for each leaf of the blocks, which carry the path of their roots: `g`, `r`, the
    fields, `proof` and `turns`, and with `with_root` the leaf itself."""
    names = [f.name for f in fields]
    extra = [T.StructField("leaf", T.BinaryType())] if with_root else []
    schema = T.StructType(
        [T.StructField("g", T.StringType()), T.StructField("r", T.LongType()), *fields, *extra, *PATH]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield spread(batch.slice(k, 1))

    def spread(row: pa.RecordBatch) -> pa.RecordBatch:
        g, block, m, data, above, turns, subroot = (
            row.column(n)[0].as_py() for n in ("g", "block", "m", "nodes", *(f.name for f in PATH))
        )
        nodes = np.frombuffer(data, np.uint8).reshape(-1, SIZE)
        levels = HEIGHT + 1 if m > BLOCK else levels_for(m)
        count = min(BLOCK, m - block * BLOCK)
        proofs, shapes = paths_of(nodes, count, levels, above, turns)
        columns = [pa.array([g] * count, pa.string()), pa.array(range(block * BLOCK, block * BLOCK + count), pa.int64())]
        columns += [row.column(n).flatten() for n in names]
        if with_root:
            own = nodes[address(levels, levels - 1, np.arange(count))].tobytes()
            columns.append(pa.array([own[i : i + SIZE] for i in range(0, len(own), SIZE)], pa.binary()))
        columns += [pa.array(x, pa.binary()) for x in (proofs, shapes, [subroot] * count)]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    paths = [f.name for f in PATH]
    return blocks.select("g", "block", "m", "nodes", *names, *paths).mapInArrow(run, schema)


def _descend(tiers: list[DataFrame], starts: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """A row for each leaf with its path up to and over `starts` (`g` and the path of its root)."""
    below = None
    for number in range(len(tiers) - 1, -1, -1):
        tier = tiers[number]
        blocks = tier.where(F.col("m") <= BLOCK).join(starts, "g")
        if below is not None:
            more = below.withColumnRenamed("r", "block")
            blocks = blocks.unionByName(tier.where(F.col("m") > BLOCK).join(more, ["g", "block"]))
        below = _spread(blocks, [] if number else fields, number == 0)
    return below


def proofs(built: Manifest, payload: list[T.StructField]) -> DataFrame:
    """For each leaf: payload, `leaf`, `proof` (the siblings of all levels, one after the other),
    `turns` (on each level, how many siblings stand before and after) and its group's `subroot`."""
    spark = built.tops.sparkSession
    nothing = spark.createDataFrame([("", b"", b"", b"")], T.StructType([T.StructField("g", T.StringType()), *PATH]))
    groups = _descend(built.upper.tiers, nothing, [T.StructField("key", T.StringType())])
    # the leaves over the groups are their roots
    starts = groups.select(F.col("key").alias("g"), "proof", "turns", F.col("leaf").alias("subroot"))
    return _descend(built.tiers, starts, payload).drop("r")


def verified(paths: DataFrame, leaf: str, root: bytes | None, name: str = "folded") -> DataFrame:
    """`paths` with the root that the column `leaf` and the proof give, and `verified`: is it `root`?"""

    def compute():
        def step(batch: pa.RecordBatch) -> list:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            out = [folded(*row) for row in rows]
            return [pa.array(out, pa.binary()), pa.array([d == root for d in out], pa.bool_())]

        return step

    fields = [T.StructField(name, T.BinaryType()), T.StructField("verified", T.BooleanType())]
    return attach(paths, {"leaf": F.col(leaf), "proof": F.col("proof"), "turns": F.col("turns")}, fields, compute)


def documents_manifest(docs: DataFrame, now: dict[str, Column] | None = None) -> Manifest:
    """The manifest of documents by language. `now` are columns as they are found later: their
    digest is kept beside as `again`, so that each row can be proved without reading it twice.

    Nulls have a code of their own in the leaf; a null language is a group, the first. Repeated
    rows are leaves of their own. Columns beside the five are not looked at.
    """
    columns = {name: F.col(name) for name in COLUMNS}
    rows = docs.select(
        group_key(F.col("lang")).alias("g"),
        F.col("doc_id").cast("long").alias("key"),
        leaf_hash(columns).alias("digest"),
        leaf_hash(columns | (now or {})).alias("again"),
    )
    return manifest(rows, ["key", "again"])


PAYLOAD = [T.StructField("key", T.LongType()), T.StructField("again", T.BinaryType())]


def tampered() -> Column:
    """The text, with A-Z as a-z in every third document by a hash of its id; none without id."""
    hit = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = documents_manifest(table(spark, sf_dir, "documents"), {"text": tampered()})
    paths = verified(proofs(built, PAYLOAD), "again", built.root)

    def hexed(name: str) -> Column:
        return F.lower(F.hex(name))

    return paths.select(
        F.col("key").alias("doc_id"),
        hexed("leaf").alias("leaf"),
        hexed("subroot").alias("subroot"),
        F.lit(built.root.hex() if built.root else None).cast("string").alias("root"),
        F.sha2(hexed("proof").cast("binary"), 256).alias("proof_sha256"),
        hexed("folded").alias("folded_root"),
        "verified",
    )


#: Levels that the SQL goes up, for groups of up to 8**7 rows and as many languages.
SQL_LEVELS = 7


def oracle() -> str:
    """The same in DuckDB, level by level."""

    def coded(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(coded(text if c == "text" else c) for c in COLUMNS) + ")"

    def levels(name: str, group: str) -> str:
        """CTEs from {name}0 (group, i, d) up; a group of one node stays as it is."""
        out = []
        for k in range(SQL_LEVELS):
            out.append(f"""
    {name}s{k} AS (
      SELECT {group}, i // 8 AS p, list(d ORDER BY i) AS ds,
        sum(count(*)) OVER (PARTITION BY {group}) AS m
      FROM {name}{k} GROUP BY {group}, i // 8),
    {name}{k + 1} AS (
      SELECT {group}, p AS i, CASE WHEN m = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d
      FROM {name}s{k})""")
        return ",".join(out)

    def climb(rows: str, start: str, name: str, group: str) -> str:
        """CTEs that fold `rows` (group, i, proof, own) up the levels of {name}, from {start}."""
        out, before = [], rows
        for k in range(SQL_LEVELS):
            own = "((b.i % 8) + 1)::INTEGER"
            left, right = f"array_to_string(ds[1:{own} - 1], '')", f"array_to_string(ds[{own} + 1:], '')"
            out.append(f"""
    {start}{k} AS (
      SELECT b.* EXCLUDE (i, proof, own), b.i // 8 AS i,
        b.proof || CASE WHEN m = 1 THEN '' ELSE {left} || {right} END AS proof,
        CASE WHEN m = 1 THEN own ELSE sha256({left} || own || {right}) END AS own
      FROM {before} b JOIN {name}s{k} s ON s.{group} IS NOT DISTINCT FROM b.{group} AND s.p = b.i // 8)""")
            before = f"{start}{k}"
        return ",".join(out)

    # CRC-32 bit by bit: each digit comes in with the first of its eight steps
    steps = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"""xor(4294967295, list_reduce(list_prepend(4294967295, {steps}::BIGINT[]),
        lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))))"""
    return f"""
    WITH leaves AS (
      SELECT doc_id, lang, {leaf("text")} AS d,
        {leaf(f"CASE WHEN {crc} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END")} AS again
      FROM documents),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, d) - 1 AS i FROM leaves),
    a0 AS (SELECT lang, i, d FROM placed),{levels("a", "lang")},
    tops AS (SELECT lang, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM a{SQL_LEVELS}),
    b0 AS (SELECT 0 AS g, i, d FROM tops),{levels("b", "g")},
    began AS (SELECT doc_id, lang, d AS leaf, i, '' AS proof, again AS own FROM placed),
    {climb("began", "c", "a", "lang").lstrip()},
    over AS (
      SELECT c.* EXCLUDE (i), t.i AS i, t.d AS subroot, 0 AS g
      FROM c{SQL_LEVELS - 1} c JOIN tops t ON t.lang IS NOT DISTINCT FROM c.lang),
    {climb("over", "e", "b", "g").lstrip()}
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, own AS folded_root, own = root AS verified
    FROM e{SQL_LEVELS - 1}, (SELECT d AS root FROM b{SQL_LEVELS})"""
