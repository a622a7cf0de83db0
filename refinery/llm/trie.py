"""Conversation prefix trie: every shared beginning of conversations is a node, all prefixes by SQL ROLLUP.

1. A turn becomes a turn id: a digest of (role, text) and the number of its words.
   Texts never leave the scan.
2. A conversation is laid out in blocks of ``WIDTH`` positional turn-id columns.
   ``GROUP BY block, prior node, ROLLUP(t1 .. tn)`` aggregates the prefixes of all
   lengths together, and grouping_id says at which column a group ends. A long
   conversation continues in further blocks, keyed by the node where the prior
   block ended, so any length takes one ROLLUP.
3. A node's key is its depth and ``LANES`` sums of 32-bit hashes of (position,
   turn id), 128 bits together. Sums run over chunks of any size, so the node
   before a block is known without walking a conversation turn by turn.
4. A node's smallest member owns it, and whoever owns a node owns the rest of its
   own path. So sums over a subtree are sums over its members: with T the words of
   a member, O the words of the nodes it owns and P the words before the node,

       saved = sum(T) - n * P - (sum(O) - O_owner + T_owner - P)

   and a second ROLLUP adds T, O and owned leaves up.
5. The ids that end at a node are sorted in chunks, and hashed as a stream.

Defined cases: rows without conv_id belong to no conversation; a null turn comes
first; null role or text is empty; turns of one number are ordered by digest, and
repeated rows are turns of their own; a conversation may be empty after the
rebuild, then it ends at the root; an empty table gives no rows. Only the columns
conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import chunk_by_range
from .common import ROW, with_row, written

WIDTH = 8
LANES = 4
HEAD = 3                 # the most turns that a rebuilt conversation takes from another
GROUP = 20
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()

_K = [f"k{i}" for i in range(LANES)]
_L = [f"l{i}" for i in range(LANES)]


def running(rows: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``rows`` and, by name, the sums over the earlier rows of the same key. However many rows
    a key has, a window holds those of one chunk, and one sum a chunk beyond it."""
    chunks = chunk_by_range(rows.withColumns({f"__s_{n}": c for n, c in sums.items()}), keys, order)
    earlier = Window.partitionBy("__chunk", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = chunks.groupBy("__chunk", *keys).agg(*[F.sum(f"__s_{n}").alias(f"__w_{n}") for n in sums])
    base = whole.select("__chunk", *keys, *[F.sum(f"__w_{n}").over(before).alias(f"__b_{n}") for n in sums])
    inner = chunks.select("*", *[F.sum(f"__s_{n}").over(earlier).alias(f"__i_{n}") for n in sums])
    zero = F.lit(0).cast("long")
    return inner.join(base, ["__chunk", *keys]).select(
        *rows.columns, *[(F.coalesce(f"__i_{n}", zero) + F.coalesce(f"__b_{n}", zero)).alias(n) for n in sums])


def turn_id(role: Column, text: Column) -> Column:
    """128 bits of the digest of (role, text), and the words of the text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, 32), F.lit(":"), F.regexp_count(text, F.lit(WORD)).cast("string"))


def words(t: Column) -> Column:
    return F.substring(t, 34, 20).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, id) of the conversations as they are."""
    rows = with_row(conversations.select("conv_id", "turn", "role", "text")).filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_id(F.col("role"), F.col("text")).alias("id"), ROW)
    keyed = rows.select("conv_id", F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"), "id", ROW)
    placed = running(keyed, ["conv_id"], ["has", "turn", "id", ROW], {"before": F.lit(1).cast("long")})
    return placed.select("conv_id", (F.col("before") + 1).alias("pos"), "id")


def rebuilt(plain: DataFrame) -> DataFrame:
    """(conv_id, pos, id): every conversation with the first h turns of its group's first conversation
    in place of its own first h; one that has no turns left keeps a row without an id."""
    conv = F.col("conv_id")
    h = (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int")
    heads = (plain.filter((conv % GROUP == 0) & (F.col("pos") <= HEAD)).groupBy(conv.alias("base"))   # HEAD rows a key
             .agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("head")))
    convs = (plain.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
             .select("conv_id", "n", h.alias("h"), (conv - conv % GROUP).alias("base")).join(heads, "base", "left")
             .select("conv_id", "n", "h", F.coalesce(F.slice("head.id", 1, F.col("h")), F.array().cast("array<string>")).alias("taken")))
    convs = written(convs, "conversations")
    shared = convs.select("conv_id", F.posexplode("taken").alias("at", "id")).select("conv_id", (F.col("at") + 1).cast("long").alias("pos"), "id")
    own = plain.filter(F.col("pos") > h).join(convs.select("conv_id", "h", F.size("taken").alias("g")), "conv_id").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("g")).alias("pos"), "id")
    bare = convs.filter((F.size("taken") == 0) & (F.col("n") <= F.col("h"))).select(
        "conv_id", F.lit(1).cast("long").alias("pos"), F.lit(None).cast("string").alias("id"))
    return shared.unionByName(own).unionByName(bare)


def _lane(k: int, depth: Column, t: Column) -> Column:
    """32 bits of (position, turn id); 0 without a turn."""
    return F.when(t.isNotNull(), F.shiftrightunsigned(F.xxhash64(F.lit(k), depth.cast("long"), t), 32)).otherwise(F.lit(0).cast("long"))


def _node(depth: Column, lanes: list[Column]) -> Column:
    return F.concat_ws(".", depth.cast("string"), *[x.cast("string") for x in lanes])


class Layout:
    """Conversations in blocks of ``width`` turn-id columns, and the nodes of a ROLLUP over them."""

    def __init__(self, width: int):
        self.width = width
        self.t = [f"t{i}" for i in range(1, width + 1)]

    def blocks(self, paths: DataFrame) -> DataFrame:
        """(conv_id, block, t1.., k0..: the prior node's lanes, l0..: the block's own, seen: words before, held: words within)."""
        slot = (F.col("pos") - 1) % self.width
        wide = paths.groupBy("conv_id", F.expr(f"(pos - 1) div {self.width}").alias("block")).agg(
            *[F.max(F.when(slot == i, F.col("id"))).alias(t) for i, t in enumerate(self.t)])
        own = {name: sum((_lane(k, F.col("block") * self.width + i + 1, F.col(t)) for i, t in enumerate(self.t)), F.lit(0).cast("long"))
               for k, name in enumerate(_L)}
        held = sum((F.coalesce(words(F.col(t)), F.lit(0).cast("long")) for t in self.t), F.lit(0).cast("long"))
        rows = wide.withColumns(own | {"held": held})
        sums = {k: F.col(name) for k, name in zip(_K, _L)} | {"seen": F.col("held")}
        return written(running(rows, ["conv_id"], ["block"], sums), "blocks")

    def ends(self, blocks: DataFrame) -> DataFrame:
        """(conv_id, node, words): where each conversation ends, and all its words."""
        n = sum((F.col(t).isNotNull().cast("long") for t in self.t), F.lit(0).cast("long"))
        whole = blocks.groupBy("conv_id").agg(F.sum(n).alias("n"), *[F.sum(name).alias(name) for name in _L], F.sum("held").alias("words"))
        return whole.select("conv_id", _node(F.col("n"), [F.col(name) for name in _L]).alias("node"), "words")

    def rollup(self, blocks: DataFrame, measures: str) -> DataFrame:
        """A row a node: node, parent, depth, last (words of its last turn), path (words before that), and ``measures``."""
        names = ", ".join(self.t)
        found = blocks.sparkSession.sql(
            f"SELECT block, {', '.join(_K)}, {names}, {self.width} - bit_count(grouping_id()) AS at, min(seen) AS seen, {measures} "
            f"FROM {{blocks}} GROUP BY block, {', '.join(_K)}, ROLLUP({names})", blocks=blocks)
        turn = [F.col(t) for t in self.t]
        here = F.when(F.col("at") > 0, F.get(F.array(*turn), (F.col("at") - 1).cast("int")))
        found = found.withColumn("here", here).filter("here is not null or (at = 0 and block = 0)")
        depth = F.col("block") * self.width + F.col("at")
        # beyond its group a ROLLUP row has no turns, so the sums over all columns are those up to the node
        lanes = [F.col(k) + sum((_lane(j, F.col("block") * self.width + i + 1, t) for i, t in enumerate(turn)), F.lit(0).cast("long"))
                 for j, k in enumerate(_K)]
        zero = F.lit(0).cast("long")
        path = F.col("seen") + sum((F.coalesce(words(t), zero) for t in turn), zero)
        keyed = found.withColumns({f"n{j}": lane for j, lane in enumerate(lanes)} | {
            "depth": depth, "last": F.coalesce(words(F.col("here")), zero), "path": path})
        mine = [F.col(f"n{j}") for j in range(LANES)]
        up = [c - _lane(j, F.col("depth"), F.col("here")) for j, c in enumerate(mine)]
        kept = [c for c in found.columns if c not in {"block", *_K, *self.t, "at", "seen", "here"}]
        return keyed.select(_node(F.col("depth"), mine).alias("node"),
                            F.when(F.col("depth") > 0, _node(F.col("depth") - 1, up)).alias("parent"),
                            "depth", "last", (F.col("path") - F.col("last")).alias("path"), *kept)


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): the digest of the ids that end at a node, numerically ascending, comma-joined.

    Chunks of ids are sorted and joined to text first; a task then streams the texts of a node
    in order through one digest, and never holds a node's ids together."""
    pieces = (chunk_by_range(ends.select("node", "conv_id"), ["node"], ["conv_id"]).groupBy("node", "__chunk")
              .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
              .select("node", F.col("ids")[0].alias("first"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("text")))

    def run(batches):
        node, digest = None, None
        for batch in batches:
            done = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name == node:
                    digest.update(b"," + text.encode())
                    continue
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = name, hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])

    return (pieces.repartition("node").sortWithinPartitions("node", "first").select("node", "text")
            .mapInArrow(run, "node string, ends_sha256 string"))


def prefix_trie(paths: DataFrame, width: int = WIDTH) -> DataFrame:
    """A row a node of the trie over ``paths`` (conv_id, pos from 1, id; no id: a conversation without turns):
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    layout = Layout(width)
    blocks = layout.blocks(paths)
    ends = written(layout.ends(blocks), "ends")
    nodes = written(layout.rollup(blocks, "min(conv_id) AS conv_id, count(*) AS n_convs"), "nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    owned = (nodes.join(children, "node", "left").groupBy("conv_id")
             .agg(F.sum("last").alias("owned"), F.count_if(F.col("n_children").isNull()).alias("leaves")))
    zero = F.lit(0).cast("long")
    shares = ends.select("conv_id", "words").join(owned, "conv_id", "left").select(
        "conv_id", "words", F.coalesce("owned", zero).alias("owned"), F.coalesce("leaves", zero).alias("leaves"))
    sums = layout.rollup(blocks.join(shares, "conv_id"), "sum(words) AS words, sum(owned) AS owned, sum(leaves) AS n_leaves, "
                         "min(struct(conv_id, words, owned)) AS owner").select("node", "words", "owned", "n_leaves", "owner")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    placed = (nodes.join(above, "parent", "left").join(sums, "node").join(children, "node", "left")
              .join(end_digests(ends), "node", "left"))
    reached = F.col("words") - F.col("n_convs") * F.col("path")
    distinct = F.col("owned") - F.col("owner.owned") + F.col("owner.words") - F.col("path")
    return placed.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
        (reached - distinct).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """The trie of the rebuilt conversations. Runs its jobs when called, but for the last."""
    return prefix_trie(rebuilt(written(turns(conversations), "turns")), width)
