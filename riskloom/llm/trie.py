"""Prefix trie of conversations: minimal-perfect-hash node tables, summed up in depth order.

Each first d turns of a conversation is a node, named by a digest that is a running sum over its
turns, so even the prefixes of one very long conversation are found in many tasks. Nodes are
grouped by digest. A node with one member needs no sums: below it is one chain. Nodes with
more members form shards, the subtrees of nodes with at most ``limit`` members below nodes with
more. In a shard a minimal perfect hash gives every digest a slot of flat arrays; counts are
scattered there and added into parent slots from the deepest level up. The few nodes above
are a last shard, which takes the sums of the subtrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.base import WORD, running_start, stored, table

#: Consecutive turn numbers that are ordered in one task.
TURNS = 1024
#: Members of a shard's top node at most, unless the table has more than MOST * LIMIT turns: then
#: as many that at most MOST nodes lie above the shards. Shared nodes of a shard, about.
LIMIT, MOST, SHARD = 4096, 1_000_000, 200_000
#: Conversation ids that are joined into one piece of text before it is hashed.
PIECE = 65_536


def turn_digest(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, turn (a digest of role and text) and words, as a stored table.

    Turns are numbered from 0 by ``turn``, nulls first, then by digest. A null role or text is
    empty. Rows without a conv_id belong to no conversation. Rows that repeat a turn are turns of their
    own. Each stretch of TURNS turn numbers is ordered in its own task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("_turn"), turn_digest(role, text).alias("turn"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.floor(F.col("turn").cast("long") / TURNS).alias("_part"),
    )
    rows = stored(rows, "turns")
    numbered = running_start(rows, ["conv_id"], "_part", ["_turn", "turn"], F.lit(1), "pos")
    return stored(numbered.select("conv_id", F.col("pos").cast("long").alias("pos"), "turn", "words"), "turns")


def branched(turns: DataFrame, every: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like others: (turns, conversations with their number of turns).

    Conversation c takes the first h turns of conversation c - c % every (all if fewer, none if
    there is no such conversation), then its own after its first h; h is the CRC-32 of c modulo
    ``shared``.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    own = turns.groupBy("conv_id").agg(F.count("*").alias("_own"))
    own = own.withColumn("_h", h).withColumn("_base", F.col("conv_id") - F.col("conv_id") % every)
    # At most shared - 1 turns of a conversation can begin another one.
    first = turns.where((F.col("pos") < shared - 1) & (F.col("conv_id") % every == 0))
    first = first.groupBy(F.col("conv_id").alias("_id")).agg(F.array_sort(F.collect_list(F.struct("pos", "turn", "words"))).alias("_first"))
    begun = own.join(first, own["_base"] == first["_id"], "left").select(
        "conv_id", "_h", F.greatest(F.col("_own") - F.col("_h"), F.lit(0)).alias("_rest"),
        F.expr("slice(coalesce(_first, array()), 1, cast(_h as int))").alias("_taken"),
    )
    begun = stored(begun, "begun")
    taken = begun.select("conv_id", F.explode("_taken").alias("_t")).select("conv_id", "_t.pos", "_t.turn", "_t.words")
    shift = begun.select(F.col("conv_id").alias("_id"), "_h", F.size("_taken").alias("_n"))
    rest = turns.join(shift, turns["conv_id"] == shift["_id"]).where("pos >= _h")
    rest = rest.select("conv_id", (F.col("pos") - F.col("_h") + F.col("_n")).alias("pos"), "turn", "words")
    sizes = begun.select("conv_id", (F.col("_rest") + F.size("_taken")).alias("n_turns"))
    return taken.unionByName(rest), sizes


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with the digests of the prefix up to it and of the one before, as a stored table.

    A prefix is told by its length and by four sums of 32 bits each over hashes of (place, turn).
    Sums of parts add up, so a conversation is summed in parts of TURNS turns.
    """
    salted = F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("turn")))
    parts = [F.conv(F.substring(salted, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"_u{k}") for k in range(4)]
    rows = stored(turns.select("conv_id", "pos", "turn", "words", F.floor(F.col("pos") / TURNS).alias("_part"), *parts), "salted")
    before = Window.partitionBy("_id").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(F.col("conv_id").alias("_id"), F.col("_part").alias("_p")).agg(*[F.sum(f"_u{k}").alias(f"_t{k}") for k in range(4)])
    totals = totals.select("_id", "_p", *[F.coalesce(F.sum(f"_t{k}").over(before), F.lit(0)).alias(f"_t{k}") for k in range(4)])
    inside = Window.partitionBy("conv_id", "_part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.join(totals, (rows["conv_id"] == totals["_id"]) & (rows["_part"] == totals["_p"]))
    summed = summed.select("conv_id", "pos", "turn", "words", *[f"_u{k}" for k in range(4)], *[(F.col(f"_t{k}") + F.sum(f"_u{k}").over(inside)).alias(f"_s{k}") for k in range(4)])

    def name(depth: Column, sums: list[Column]) -> Column:
        return F.unhex(F.md5(F.concat_ws(":", *[c.cast("string") for c in [depth, *sums]])))

    upto = [F.col(f"_s{k}") for k in range(4)]
    ahead = [F.col(f"_s{k}") - F.col(f"_u{k}") for k in range(4)]
    depth = (F.col("pos") + 1).alias("depth")
    return stored(summed.select("conv_id", depth, "turn", "words", name(F.col("pos") + 1, upto).alias("node"), name(F.col("pos"), ahead).alias("parent")), "prefixes")


class PerfectHash:
    """Slots 0 to n - 1 for n different keys of two 64-bit words, without a key table to probe.

    Keys that fall alone into a level's bits are placed there; the rest go on to the next
    level. A key's slot is the number of bits set before its own. ``slots`` compares the
    key kept in the slot, so a key that is not in the table is told by -1.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, placed = np.arange(len(keys)), 0
        while len(left):
            if len(self.levels) > 200:
                raise ValueError("two nodes have one digest")
            size = 2 * len(left) + 1
            at = self._place(keys[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((alone, placed + np.cumsum(alone) - alone))
            placed += int(alone.sum())
            left = left[~alone[at]]
        self.keys = np.zeros_like(keys)
        slot = self._find(keys)
        self.keys[slot] = keys
        if not np.array_equal(np.sort(slot), np.arange(len(keys))) or not np.array_equal(self.keys[slot], keys):
            raise ValueError("two nodes share a slot")

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys[:, 0] + np.uint64(2 * level + 1) * keys[:, 1]
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return ((x ^ (x >> np.uint64(33))) % np.uint64(size)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slot, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._place(keys[left], level, len(alone))
            hit = alone[at]
            slot[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return slot

    def slots(self, keys: np.ndarray) -> np.ndarray:
        slot = self._find(keys)
        known = slot >= 0
        known[known] = (self.keys[slot[known]] == keys[known]).all(axis=1)
        return np.where(known, slot, -1)


SUMS = "node binary, parent binary, n_children long, n_leaves long, saved_tokens long"


def _accumulate(nodes: pa.Table) -> pa.Table:
    """The sums over the subtrees of a shard: node, parent, depth and what each node starts with
    (children and leaves outside the shard, saved tokens)."""

    def digests(name: str) -> np.ndarray:
        return np.frombuffer(b"".join(nodes.column(name).to_pylist()), np.uint64).reshape(-1, 2)

    keys = digests("node")
    table = PerfectHash(keys)
    slot, up = table.slots(keys), table.slots(digests("parent"))
    n = len(keys)
    parent, depth = np.empty(n, np.int64), np.empty(n, np.int64)
    parent[slot], depth[slot] = up, nodes.column("depth").to_numpy()
    children, leaves, saved = (np.empty(n, np.int64) for _ in range(3))
    for array, name in ((children, "kids"), (leaves, "leaves"), (saved, "saved")):
        array[slot] = nodes.column(name).to_numpy()
    inner = np.flatnonzero(parent >= 0)
    np.add.at(children, parent[inner], 1)
    # Deepest level first: a node's own sums are whole before they go to its parent.
    order = inner[np.argsort(-depth[inner], kind="stable")]
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    return pa.Table.from_arrays(
        [nodes.column("node"), nodes.column("parent"), *(pa.array(a[slot]) for a in (children, leaves, saved))],
        ["node", "parent", "n_children", "n_leaves", "saved_tokens"],
    )


def _digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of text sorted by (node, part) to one SHA-256 per node; a node's text is never held."""
    node, engine = None, None
    for batch in batches:
        done = []
        for name, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist()):
            if name == node:
                engine.update(b"," + piece.encode())
                continue
            if engine is not None:
                done.append((node, engine.hexdigest()))
            node, engine = name, hashlib.sha256(piece.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*done), (pa.binary(), pa.string()))], ["node", "ends_sha256"])
    if engine is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([engine.hexdigest()])], ["node", "ends_sha256"])


def ends(members: DataFrame) -> DataFrame:
    """The SHA-256 of each node's conversation ids, ascending, joined by commas: node, ends_sha256.

    PIECE ids at most are put together in a task; a hash takes its text in order, so one task reads a
    node's pieces one after the other.
    """
    pieces = members.groupBy("node", F.floor(F.col("conv_id") / PIECE).alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("piece")
    )
    return pieces.repartition("node").sortWithinPartitions("node", "part").mapInArrow(_digest_pieces, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, sizes: DataFrame, limit: int | None = None, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos from 0 without gaps, turn, words) of the
    conversations ``sizes`` (conv_id, n_turns): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    The root is there if there is any conversation, also for those without turns; no conversations
    give an empty result. ``limit`` bounds the members of a shard's top.
    """
    root = F.unhex(F.md5(F.lit("0:0:0:0:0")))
    rows = prefixes(turns)
    sizes = stored(sizes, "sizes")
    if limit is None:
        limit = max(LIMIT, -(-rows.count() // MOST))
    told = rows.join(sizes.select(F.col("conv_id").alias("_id"), "n_turns"), rows["conv_id"] == F.col("_id"))
    told = told.select("conv_id", "depth", "node", "parent", "turn", "words", (F.col("depth") == F.col("n_turns")).alias("last"))
    none = F.lit(None).cast("string")
    at_root = sizes.select("conv_id", F.lit(0).cast("long").alias("depth"), root.alias("node"), F.unhex(none).alias("parent"), none.alias("turn"), F.lit(0).cast("long").alias("words"), (F.col("n_turns") == 0).alias("last"))
    paths = stored(told.unionByName(at_root), "paths")
    one = (F.min("turn").eqNullSafe(F.max("turn"))) & (F.min("parent").eqNullSafe(F.max("parent"))) & (F.min("depth") == F.max("depth"))
    nodes = paths.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.count("*").alias("n_convs"),
        F.count_if("last").alias("_ends"), F.min("words").alias("words"), one.alias("_one"),
    )
    checked = F.when(F.col("_one"), F.col("depth")).otherwise(F.raise_error(F.lit("two prefixes have one digest")).cast("long"))
    nodes = stored(nodes.withColumn("depth", checked).drop("_one"), "nodes")

    # Children with one member count as one leaf each; other children are in the arrays.
    single, shared = nodes.where("n_convs = 1"), nodes.where("n_convs > 1")
    alone = single.where("parent IS NOT NULL").groupBy(F.col("parent").alias("_up")).agg(F.count("*").alias("_alone"))
    start = shared.join(alone, shared["node"] == alone["_up"], "left").select(
        "node", F.coalesce("parent", F.lit(b"\0" * 16)).alias("parent"), "depth", "conv_id", "n_convs",
        F.coalesce("_alone", F.lit(0)).alias("kids"),
        (F.coalesce("_alone", F.lit(0)) + (F.col("_ends") == F.col("n_convs")).cast("long")).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    start = stored(start, "shared-nodes")
    light, heavy = start.where(F.col("n_convs") <= limit), start.where(F.col("n_convs") > limit)
    # The top of a node is the first light node on the way to it, which its smallest member goes.
    asked = light.select(F.col("conv_id").alias("_id")).distinct()
    ways = paths.join(asked, paths["conv_id"] == asked["_id"], "left_semi").select("conv_id", "node", "depth")
    small = light.select(F.col("node").alias("_node"))
    tops = ways.join(small, ways["node"] == small["_node"]).groupBy(F.col("conv_id").alias("_id")).agg(F.min_by("node", "depth").alias("top"))
    shards = max(1, -(-light.count() // shard))
    dealt = light.join(tops, light["conv_id"] == tops["_id"]).withColumn("shard", F.pmod(F.xxhash64("top"), F.lit(shards)))
    columns = ("node", "parent", "depth", "kids", "leaves", "saved")
    low = stored(dealt.select("shard", *columns).groupBy("shard").applyInArrow(lambda t: _accumulate(t), SUMS), "sums")
    # What the shards' tops hand to the nodes above, at most MOST.
    above = low.join(heavy.select(F.col("node").alias("_up")), low["parent"] == F.col("_up"), "left_semi")
    above = above.groupBy(F.col("parent").alias("_up")).agg(F.count("*").alias("_k"), F.sum("n_leaves").alias("_l"), F.sum("saved_tokens").alias("_s"))
    crown = heavy.join(above, heavy["node"] == above["_up"], "left").select(
        F.lit(0).alias("shard"), "node", "parent", "depth", (F.col("kids") + F.coalesce("_k", F.lit(0))).alias("kids"),
        (F.col("leaves") + F.coalesce("_l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("_s", F.lit(0))).alias("saved"),
    )
    high = crown.groupBy("shard").applyInArrow(lambda t: _accumulate(t), SUMS)
    sums = low.unionByName(high).drop("parent")
    closed = single.select("node", (1 - F.col("_ends")).alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    sums = sums.unionByName(closed)

    found = ends(paths.where("last").select("node", "conv_id"))
    up = nodes.select(F.col("node").alias("_up"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums.withColumnRenamed("node", "_n"), nodes["node"] == F.col("_n")).join(up, nodes["parent"] == up["_up"], "left")
    out = out.join(found.select(F.col("node").alias("_e"), "ends_sha256"), nodes["node"] == F.col("_e"), "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = ordered_turns(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return prefix_trie(*branched(turns))


ORACLE = """
WITH crc_table AS (
  SELECT list(list_reduce(list_concat([i], range(8)),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)
), said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), named AS (
  SELECT conv_id, turn, md5(octet_length(encode(role)) || ':' || role || text) AS d, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM said
), conv AS (
  SELECT conv_id, list({'d': d, 'words': words} ORDER BY turn NULLS FIRST, d) AS turns FROM named GROUP BY conv_id
), hashed AS (
  SELECT conv_id, turns, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(
    range(len(conv_id::VARCHAR)), lambda k: ascii(substr(conv_id::VARCHAR, k + 1, 1))::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 4 AS h
  FROM conv, crc_table
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns
  FROM hashed AS a LEFT JOIN conv AS b ON b.conv_id = a.base
), path AS (
  SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt
), keyed AS (
  SELECT conv_id, n, depth, array_to_string(list_transform(turns[1:depth], lambda x: x.d), '/') AS node,
    array_to_string(list_transform(turns[1:depth - 1], lambda x: x.d), '/') AS parent,
    CASE WHEN depth = 0 THEN 0 ELSE turns[depth].words END AS words, turns FROM path
), nodes AS (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, any_value(turns) AS turns,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM keyed GROUP BY node, depth
), kids AS (
  SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent, depth
), whole AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.parent = nodes.node AND kids.depth = nodes.depth
), raised AS (
  SELECT n_children, (n_convs - 1) * words AS saved, turns, unnest(range(depth + 1)) AS up FROM whole
), summed AS (
  SELECT array_to_string(list_transform(turns[1:up], lambda x: x.d), '/') AS node, up,
    count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM raised GROUP BY 1, 2
)
SELECT w.conv_id::BIGINT AS conv_id, w.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, w.n_convs::BIGINT AS n_convs,
  w.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM whole AS w JOIN summed AS s ON s.node = w.node AND s.up = w.depth
LEFT JOIN nodes AS p ON p.node = w.parent AND p.depth = w.depth - 1
"""
