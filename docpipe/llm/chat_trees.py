"""Operator 5: conversations formatted and merged where they begin alike, as prefix trees.

A node is a turn after all turns before it; two conversations share it if they agree that far.
Nodes that the same conversations share follow each other and make a segment, so that a tree
branches, or a conversation ends, only at the end of a segment. A tree is laid out depth-first:
each node's text stands once, at an offset that starts after the root's 0, with the position it has
in its conversations (what its ancestors count) and the intervals that it attends to, besides
itself: those of its ancestors. Offsets and positions are code points of the formatted text.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docpipe.llm.common import dropped, emit, kept, table

#: The template. Every mark has a control string that no escaped text has.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Control strings, of this template and of others, start with the first group, then
#: any backslashes, and go on with the second. Escaping puts in one more backslash.
_HEAD, _TAIL = r"(<|\[)", r"(\||/?INST\]|/?s>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _HEAD + r"(\\*)" + _TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _HEAD + r"\\(\\*)" + _TAIL, "$1$2$3")


def formatted(role: Column, text: Column) -> Column:
    return F.concat(F.lit(TURN), escape(role), F.lit(TEXT), escape(text), F.lit(END))


def _chained(turns: DataFrame) -> DataFrame:
    """Turns in order, each with `pos`, `node` (hash of all so far), `at` (code points before it)."""

    def compute():
        state: dict = {"conv": None}

        def step(batch: pa.RecordBatch):
            nodes, pos, at, roots = [], [], [], []
            for conv, role, content, size in zip(
                *(batch.column(k).to_pylist() for k in ("conv", "role", "text", "size")), strict=True
            ):
                if conv != state["conv"]:
                    state.update(conv=conv, node=b"", pos=0, at=0)
                turn = hashlib.sha256(state["node"])
                for part in (role.encode(), content.encode()):
                    turn.update(len(part).to_bytes(8, "big") + part)
                state["node"] = turn.digest()[:16]
                if not state["pos"]:
                    state["root"] = state["node"]
                nodes.append(state["node"])
                pos.append(state["pos"])
                at.append(state["at"])
                roots.append(state["root"])
                state["pos"] += 1
                state["at"] += size
            yield {
                "conv": batch.column("conv"),
                "tree": pa.array(roots, pa.binary()),
                "node": pa.array(nodes, pa.binary()),
                "pos": pa.array(pos, pa.int64()),
                "at": pa.array(at, pa.int64()),
                "size": batch.column("size"),
                "role": batch.column("role"),
                "text": batch.column("text"),
            }

        return step

    # one task reads a conversation turn by turn and keeps only its last hash and length
    ordered = turns.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    schema = "conv string, tree binary, node binary, pos long, at long, size long, role string, text string"
    return emit(ordered.drop("turn"), schema, compute)


def conversation_key(conv_id: Column) -> Column:
    """The id as text; null has a key of its own."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit("null"))


def build(turns: DataFrame, trained_role: str = "assistant") -> tuple[DataFrame, DataFrame]:
    """Prefix trees of conversations (`conv_id`, `turn`, `role`, `text`): nodes and paths.

    Nodes, each once: `tree`, `segment`, `node`, `pos` (turns before it), `start` and `end` (its
    place in the tree's depth-first text), `position` (of its first code point), `content` (its
    formatted text), `loss` (start and end in the tree of what is trained on: the texts of
    `trained_role`), `attends` (intervals of its ancestors, in order, touching ones merged; it also
    attends to itself up to each code point). Paths: `conv`, `segment`, `at` (positions before it).

    Turns are ordered by turn, then role and text, null first; null roles and texts are empty,
    turns with null ids are one conversation. Repeated rows are turns of their own. Equal
    conversations have equal paths. Other columns are not looked at; no rows make no trees.
    """
    empty = F.lit("")
    clean = turns.select(
        conversation_key(F.col("conv_id")).alias("conv"),
        "turn",
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    size = F.length(formatted(F.col("role"), F.col("text"))).cast("long")
    chained = kept(_chained(clean.withColumn("size", size)), "chained-turns")
    # conversations that share a node share all before it, so equal counts are the same ones
    sharing = chained.groupBy("node").agg(F.count("*").alias("sharing"), F.min("conv").alias("owner"))
    nodes = kept(chained.join(sharing, "node"), "tree-nodes")
    dropped(chained)
    paths = nodes.groupBy("conv", "tree", "sharing").agg(
        F.min("pos").alias("first"), F.min("at").alias("at"), F.sum("size").alias("size"),
        F.min("owner").alias("owner"), F.min(F.struct("pos", "node"))["node"].alias("segment"),
    )
    paths = kept(paths, "tree-paths")
    owned = paths.where("conv = owner")
    # the segments from the root to each: in their order, a tree stands depth-first
    above = paths.join(owned.select("conv").distinct(), "conv", "left_semi")
    lists = above.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("at", "segment", "size"))).alias("all"))
    owned = owned.join(lists, "conv")
    owned = owned.select(
        "tree", "segment", "at", "size", F.filter("all", lambda x: x["at"] <= F.col("at")).alias("all")
    )
    owned = owned.withColumn("path", F.transform("all", lambda x: x["segment"]))
    ranged = owned.repartitionByRange("tree", "path").withColumn("part", F.spark_partition_id())
    ranged = kept(ranged, "tree-order")
    # a tree may span several ranges: sums of whole ranges, then within each
    totals = ranged.groupBy("tree", "part").agg(F.sum("size").alias("total"))
    earlier = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("tree", "part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    within = W.partitionBy("tree", "part").orderBy("path").rowsBetween(W.unboundedPreceding, -1)
    placed = ranged.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(totals, ["tree", "part"])
    placed = kept(
        placed.select("segment", "at", "all", "size", (F.col("base") + F.col("before")).alias("start")),
        "tree-segments",
    )
    dropped(ranged)
    # what each segment attends to: where its ancestors stand
    starts = placed.select(F.col("segment").alias("ancestor"), F.col("start").alias("a_start"))
    links = placed.select("segment", F.explode(F.filter("all", lambda x: x["at"] < F.col("at"))).alias("x"))
    links = links.select("segment", F.col("x.segment").alias("ancestor"), F.col("x.size").alias("a_size"))
    spans = links.join(starts, "ancestor").groupBy("segment").agg(
        F.sort_array(
            F.collect_list(F.struct(F.col("a_start").alias("start"), (F.col("a_start") + F.col("a_size")).alias("end")))
        ).alias("spans")
    )

    def join_up(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.array_append(
            F.slice(done, 1, F.size(done) - 1),
            F.struct(last["start"].alias("start"), span["end"].alias("end")),
        )
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] == span["start"])
        return F.when(touches, grown).otherwise(F.array_append(done, span))

    kind = "array<struct<start:bigint,end:bigint>>"
    none = F.expr(f"cast(array() as {kind})")
    attends = F.coalesce(F.aggregate("spans", none, join_up), none)
    placed = placed.join(spans, "segment", "left").select(
        "segment", F.col("at").alias("s_at"), F.col("start").alias("s_start"), attends.alias("s_attends")
    )
    # each node's text comes from the first conversation that has it
    texts = nodes.where("conv = owner").join(
        owned_segments(paths), ["conv", "sharing"]
    ).join(placed, "segment")
    start = F.col("s_start") + F.col("at") - F.col("s_at")
    own_before = F.when(
        F.col("at") > F.col("s_at"),
        F.array(F.struct(F.col("s_start").alias("start"), start.alias("end"))),
    ).otherwise(none)
    all_before = F.aggregate(F.concat("s_attends", own_before), none, join_up)
    lead = F.length(F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))).cast("long")
    trained = F.when(
        F.col("role") == trained_role,
        F.array(F.struct((start + lead).alias("start"), (start + F.col("size") - len(END)).alias("end"))),
    ).otherwise(none)
    nodes_out = texts.select(
        "tree", "segment", "node", "pos", start.alias("start"), (start + F.col("size")).alias("end"),
        F.col("at").alias("position"), formatted(F.col("role"), F.col("text")).alias("content"),
        trained.alias("loss"), all_before.alias("attends"),
    )
    return nodes_out, paths.select("conv", "tree", "segment", "at")


def owned_segments(paths: DataFrame) -> DataFrame:
    return paths.where("conv = owner").select("conv", "sharing", "segment")


def read_back(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Each conversation's turns in order as the trees have them.

    `conv`, `position`, `attended` (the length of the intervals that the turn attends to), `content`,
    then from the content alone `role`, `said`, and, from the loss mask, `trained`, the unescaped
    text that it covers or null.
    """
    rows = paths.select("conv", "segment").join(nodes, "segment")
    mask = F.col("loss")[0]
    inner = F.substring(F.col("content"), mask["start"] - F.col("start") + 1, mask["end"] - mask["start"])
    pattern = r"(?s)^<\|turn\|>(.*?)<\|text\|>(.*)<\|end\|>\n$"
    attended = F.aggregate("attends", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return rows.select(
        "conv", "position", attended.alias("attended"), "content",
        unescape(F.regexp_extract("content", pattern, 1)).alias("role"),
        unescape(F.regexp_extract("content", pattern, 2)).alias("said"),
        F.when(F.size("loss") > 0, unescape(inner)).alias("trained"),
    )


def digests(turns: DataFrame) -> DataFrame:
    """For each conversation of `read_back`: counts and SHA-256 of its turns and its trained text, of
    its turns' positions, and the length of all that they attend to."""
    schema = (
        "conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, positions_sha256 string, attended_chars long"
    )

    def run(batches):
        now = None
        out: list[tuple] = []

        def close():
            if now is not None:
                places = ",".join(map(str, positions)).encode()
                out.append((
                    conv, n, said.hexdigest(), chars, trained.hexdigest(), length,
                    hashlib.sha256(places).hexdigest(), attended,
                ))

        conv = n = chars = length = said = trained = positions = attended = None
        for batch in batches:
            for key, role, content, loss, size, position, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    close()
                    now, conv, n, chars, length = key, key, 0, 0, 0
                    said, trained, positions, attended = hashlib.sha256(), hashlib.sha256(), [], 0
                said.update(f"{role}\n{content}\n".encode())
                n, length, attended = n + 1, length + size, attended + seen
                positions.append(position)
                if loss is not None:
                    chars += len(loss)
                    trained.update(loss.encode())
            yield from flush(out)
        close()
        yield from flush(out)

    def flush(out: list[tuple]):
        text, whole = pa.string(), pa.int64()
        kinds = [text, whole, text, whole, text, whole, text, whole]
        if out:
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            names = [part.split()[0] for part in schema.split(", ")]
            out.clear()
            yield pa.RecordBatch.from_arrays(columns, names=names)

    size = F.length("content").cast("long").alias("size")
    wanted = turns.select("conv", "role", "said", "trained", size, "position", "attended")
    ordered = wanted.repartition("conv").sortWithinPartitions("conv", "position")
    return ordered.mapInArrow(run, schema)


#: A conversation whose texts hold control strings, which the query adds.
TRICKY = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    turns = turns.unionByName(spark.createDataFrame(more, turns.schema))
    found = digests(read_back(*build(turns)))
    conv_id = F.when(F.col("conv") != "null", F.expr("substring(conv, 2)").cast("long"))
    return found.select(conv_id.alias("conv_id"), *[c for c in found.columns if c != "conv"])


def oracle() -> str:
    """The digests in DuckDB, straight from the table."""
    control = r"(<|\[)(\\*)(\||/?INST\]|/?s>)"
    extra = len(TURN) + len(TEXT) + len(END)
    return f"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations
      UNION ALL SELECT * FROM (VALUES
        (-7, 0, 'user', '{TRICKY}'), (-7, 1, 'assistant', '{TRICKY}')) v),
    sized AS (
      SELECT *, {extra} + length(role) + length(text)
        + len(regexp_extract_all(role, '{control}')) + len(regexp_extract_all(text, '{control}')) AS size
      FROM turns),
    placed AS (
      SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY conv_id ORDER BY turn, role, text
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS position
      FROM sized)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum(size) AS BIGINT) AS formatted_chars,
      sha256(string_agg(position, ',' ORDER BY position)) AS positions_sha256,
      CAST(sum(position) AS BIGINT) AS attended_chars
    FROM placed GROUP BY conv_id"""
