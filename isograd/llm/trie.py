"""Prefix trie of conversations, by ROLLUP over the turns as columns.

A turn is named by the digest of its role and text.  The turns of every
conversation are numbered and laid out as ``WIDTH`` columns a row; a long
conversation continues in further rows, each keyed by the node that its
earlier turns end in.  A node is named by its depth and two 64-bit sums (XOR)
of a hash of each turn with its place, so the key of a later block follows
from the turns before it without another pass.  One ``GROUP BY ROLLUP`` over
the columns then gives the nodes of every depth of every block at once, and
``grouping_id`` says which.

Sums over subtrees come from a second ROLLUP of sums over members.  Each node
is charged to its smallest member.  The nodes of a member that are charged to
it are the deepest ones of its path, so the nodes below a node are those
charged to its members, without what its own smallest member has above it.

No step holds a conversation or a node whole in one task: turns are numbered
by a range shuffle and sums over its parts, grouping pre-aggregates in the
tasks, and parents with many children are broadcast (a bounded number of
them).  Only the digest of the conversations that end in one node is a
sequence by nature; they are joined in chunks of ``CHUNK`` and streamed.

Null roles and texts are empty.  Rows without a conversation id are left out.
Turns are ordered by their number, null first, those with one number by their
digest; repeated rows are turns of their own.  An empty table has no nodes.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isograd.llm.skew import meet
from isograd.llm.storage import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Turns in a row of the ROLLUP.
WIDTH = 8
#: Rows of a conversation that one window numbers, and conversation ids joined into one string.
CHUNK = 4096

KEY = ["depth", "za", "zb"]


def turn_ids(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turn``, 128-bit ``id`` of role and text, and ``words`` of the text."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    whole = F.concat(F.length(by).cast("string"), F.lit(":"), by, said)
    return turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.unhex(F.md5(whole)).alias("id"),
        F.regexp_count(said, F.lit(WORD)).cast("long").alias("words"),
    )


def numbered(ids: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``pos``, ``id``, ``words``: the turns of each conversation counted from 0.

    Rows are range-partitioned by conversation and turn, so that one long
    conversation fills several parts; each part counts its own rows and the
    counts of the parts before are added.
    """
    order = ["conv_id", "turn", "id", "salt"]
    ranged = ids.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.drop("salt").withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    kept = stored(placed, "turns")
    spans = kept.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(before), F.lit(0))
    spans = spans.select("conv_id", "part", (offset - F.col("first")).alias("shift"))
    return kept.join(spans, ["conv_id", "part"]).select("conv_id", "part", (F.col("row") + F.col("shift")).alias("pos"), "id", "words")


def _named(turn: Column, pos: Column) -> tuple[Column, Column]:
    return F.xxhash64(turn, pos), F.xxhash64(F.lit(7), pos, turn)


def _blocks(rows: DataFrame) -> DataFrame:
    """One row for ``WIDTH`` turns of a conversation, with the name and the words of all turns before them."""
    pos = F.col("pos").cast("long")
    za, zb = _named(F.col("id"), pos)
    slot = F.pmod(pos, F.lit(WIDTH))
    held = rows.groupBy("conv_id", F.floor(pos / WIDTH).cast("long").alias("block")).agg(
        *[F.max(F.when(slot == k, F.col("id"))).alias(f"t{k}") for k in range(WIDTH)],
        *[F.max(F.when(slot == k, F.col("words"))).alias(f"w{k}") for k in range(WIDTH)],
        F.bit_xor(za).alias("xa"), F.bit_xor(zb).alias("xb"), F.sum("words").alias("own"), F.count("*").alias("n"),
    )
    held = stored(held.withColumn("chunk", F.floor(F.col("block") / CHUNK).cast("long")), "blocks")

    def before(by: list[str], order: str, prefix: str) -> dict[str, Column]:
        earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        sums = {"xa": F.bit_xor("xa"), "xb": F.bit_xor("xb"), "own": F.sum("own")}
        return {f"{prefix}{c}": F.coalesce(s.over(earlier), F.lit(0)) for c, s in sums.items()}

    chunks = held.groupBy("conv_id", "chunk").agg(F.bit_xor("xa").alias("xa"), F.bit_xor("xb").alias("xb"), F.sum("own").alias("own"))
    offsets = chunks.withColumns(before(["conv_id"], "chunk", "c")).select("conv_id", "chunk", "cxa", "cxb", "cown")
    inside = held.withColumns(before(["conv_id", "chunk"], "block", "i"))
    return inside.join(offsets, ["conv_id", "chunk"]).select(
        "conv_id", "block", "chunk",
        F.col("ixa").bitwiseXOR(F.col("cxa")).alias("pa"), F.col("ixb").bitwiseXOR(F.col("cxb")).alias("pb"), (F.col("iown") + F.col("cown")).alias("pw"),
        *[f"t{k}" for k in range(WIDTH)], *[f"w{k}" for k in range(WIDTH)], "xa", "xb", "own", "n",
    )


def _rollup(blocks: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Aggregates of all prefixes: names of the node and its parent, and the words of its last turn and before it."""
    turns = ", ".join(f"t{k}" for k in range(WIDTH))
    said = ", ".join(f"max(w{k}) AS w{k}" for k in range(WIDTH))
    asked = ", ".join(f"{sql} AS {name}" for name, sql in sums.items())
    found = blocks.sparkSession.sql(
        f"""SELECT block, pa, pb, {turns}, {WIDTH} - bit_count(grouping_id()) AS level, max(pw) AS pw, {said}, {asked}
            FROM {{blocks}} GROUP BY block, pa, pb, ROLLUP({turns})""",
        blocks=blocks,
    )
    last = F.when(F.col("level") > 0, F.get(F.array(*[f"t{k}" for k in range(WIDTH)]), F.col("level") - 1))
    found = found.where(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(last.isNotNull()))

    def name(which: int, shorter: int) -> Column:
        parts = [
            F.when(F.col("level") > k + shorter, _named(F.col(f"t{k}"), F.col("block") * WIDTH + k)[which]).otherwise(F.lit(0)) for k in range(WIDTH)
        ]
        return reduce(lambda a, b: a.bitwiseXOR(b), parts, F.col("pa" if which == 0 else "pb"))

    words = [F.when(F.col("level") == k + 1, F.col(f"w{k}")) for k in range(WIDTH)]
    earlier = [F.when(F.col("level") > k + 1, F.col(f"w{k}")).otherwise(F.lit(0)) for k in range(WIDTH)]
    return found.select(
        (F.col("block") * WIDTH + F.col("level")).alias("depth"), name(0, 0).alias("za"), name(1, 0).alias("zb"),
        name(0, 1).alias("parent_a"), name(1, 1).alias("parent_b"),
        F.coalesce(*words, F.lit(0)).alias("words"), reduce(lambda a, b: a + b, earlier, F.col("pw")).alias("words_above"), *sums,
    )


def _ends(members: DataFrame) -> DataFrame:
    """Digest of the ids, ascending and comma-joined, of the conversations that end in each node."""
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = members.groupBy(*KEY, F.floor(F.col("conv_id") / CHUNK).cast("long").alias("chunk")).agg(joined.alias("ids"))
    ordered = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk")
    names = [*KEY, "ends_sha256"]

    def digested(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for *here, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if here != key:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = here, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, state.hexdigest())], names=names)

    return ordered.mapInArrow(digested, "depth long, za long, zb long, ends_sha256 string")


def prefix_trie(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Nodes of the conversations ``members`` (``conv_id``) with the numbered turns ``rows``; one row a node.

    ``conv_id`` is the smallest member and, with ``depth``, names the node;
    ``parent_conv_id`` that of its parent (null for the root); ``n_convs``,
    ``n_children``, ``n_leaves``; ``saved_tokens``, the words that members
    share with another in the subtree; ``ends_sha256`` of the conversations
    that end here.  Conversations without turns are members of the root.
    """
    blocks = _blocks(rows)
    full = blocks.groupBy("conv_id").agg(
        F.sum("n").alias("depth"), F.bit_xor("xa").alias("za"), F.bit_xor("xb").alias("zb"), F.sum("own").alias("total")
    )
    ends = members.select("conv_id").distinct().join(full, "conv_id", "left").fillna(0, [*KEY, "total"])
    ends = stored(ends, "conversations")
    mute = ends.where("depth = 0").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in ("block", "chunk", "pa", "pb", "pw")],
        *[F.lit(None).cast("binary").alias(f"t{k}") for k in range(WIDTH)], *[F.lit(None).cast("long").alias(f"w{k}") for k in range(WIDTH)],
    )
    laid = stored(blocks.select(*mute.columns).unionAll(mute), "prefixes")

    nodes = stored(_rollup(laid, {"conv_id": "min(conv_id)", "n_convs": "count(*)"}), "nodes")
    child = [(F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("za"), F.col("parent_b").alias("zb")]
    families = nodes.where("depth > 0").select(*child).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(families, KEY, "left").fillna(0, ["n_children"]), "families")

    charged = nodes.groupBy("conv_id").agg(F.sum("words").alias("charged"), F.count(F.when(F.col("n_children") == 0, 1)).alias("leaves"))
    each = ends.select("conv_id", "total").join(charged, "conv_id", "left").fillna(0, ["charged", "leaves"])
    each = laid.select("conv_id", "chunk").distinct().join(each, "conv_id")
    sums = {c: f"sum({c})" for c in ("total", "charged", "leaves")} | {"own": "min(struct(conv_id, charged, total))"}
    below = _rollup(laid.join(each, ["conv_id", "chunk"]), sums).select(*KEY, *sums)

    # words of all members from this node on, less one for each node of the subtree
    again = F.col("total") - F.col("n_convs") * F.col("words_above")
    once = F.col("charged") - F.col("own.charged") + F.col("own.total") - F.col("words_above")
    found = nodes.join(below, KEY).withColumns({"saved_tokens": again - once, "n_leaves": F.col("leaves")})
    found = found.join(_ends(ends), KEY, "left").select(
        "depth", "parent_a", "parent_b", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    above = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("za").alias("parent_a"), F.col("zb").alias("parent_b"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("asked"),
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    under = meet(found.where("depth > 0"), above, ["depth", "parent_a", "parent_b"], "asked").select(*columns)
    root = found.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns)
    return root.unionAll(under)


def conversation_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The prefix trie of a table of turns."""
    rows = numbered(turn_ids(turns, conv, turn, role, text))
    return prefix_trie(rows, rows.select("conv_id"))
