"""Prefix trie of conversations: which beginnings conversations share, and how
much text a cache of shared beginnings would save.

Method. A turn is reduced to a digest and its length in code points before
anything is shuffled; a beginning of d turns is the chained digest of its
turns. Digests are enumerated in shards. Each shard builds a minimal perfect
hash of its distinct digests (``PerfectTable``), whose slots keep the digests
so that every lookup is verified, scatters counts into flat arrays by slot
and adds up subtrees through the array of parent slots, deepest first.

Sharding. A beginning that more than ``limit`` conversations share is
*heavy*. ``limit`` is at least the number of (conversation, beginning) rows
divided by ``MAX_HEAVY``, so there are fewer than ``MAX_HEAVY`` heavy
beginnings at any size of input; only these are broadcast, and one task adds
up their part of the trie. What lies below is split into subtrees of at most
``limit`` conversations; a shard takes whole subtrees, and sends the heavy
part one row for each heavy parent. A first turn or a whole conversation that
a third of all conversations share is thus counted by partial aggregation.

The list of conversations that end in a heavy beginning is written in sorted
pieces by many tasks. SHA-256 has to read it in order: one task streams the
pieces of one beginning, in constant memory.

Turns are ordered by turn, null first; ties by the turn's digest. Null role
or text counts as ''. Rows without a whole-numbered conv_id belong to no
conversation. Repeated rows are turns of their own. Turns are streamed, so
texts and conversations of any length do. An empty table gives no rows, not
even the root. Columns other than the four are not read. Beginnings are told
apart by 128 bits of SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.blocks import bucket_count
from skyfold.llm.text import U64, column_buffers, mix64
from skyfold.session import cut_lineage

#: Bytes of a beginning's digest.
DIGEST = 16
ROOT = hashlib.sha256(b"").digest()[:DIGEST]
ABOVE_ROOT = bytes(DIGEST)
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Bound of the number of heavy beginnings, and the fewest conversations one has.
MAX_HEAVY, MIN_LIMIT = 100_000, 32
#: Rows of a shard, about.
SHARD_ROWS = 100_000
#: Bytes of a piece of a list of conversation ids.
PIECE_BYTES = 1 << 16


def turn_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos from 1, t, chars): the turns in order, as digests."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    turns = conversations.select(F.expr(f"try_cast(`{conv_col}` AS long)").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), digest.alias("t"), F.length(text).cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "t")
    return turns.where(F.col("conv_id").isNotNull()).select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "t", "chars")


def conversation_rows(turns: DataFrame) -> DataFrame:
    """Turns and, for every conversation, the textless beginning (pos 0)."""
    return turns.unionByName(_roots(turns.where(F.col("pos") == 1)))


def _roots(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("t"), F.lit(0).cast("long").alias("chars"))


def lend_heads(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Rebuilt conversations: the first h turns of conversation c - c % every,
    then c's own turns after its first h, with h = crc32(c) % most."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    convs = turns.where(F.col("pos") == 1).select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    lent = convs.join(heads, "base").where(F.col("pos") <= h).select("conv_id", "pos", "t", "chars")
    return _roots(convs).unionByName(lent).unionByName(turns.where(F.col("pos") > h))


_PATH = "conv_id long, depth long, digest binary, parent binary, chars long, last boolean"


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns of sorted conversations to their beginnings. One row is held
    back, since the next one tells whether it is its conversation's last."""
    rows: list[list] = [[], [], [], [], []]
    last: list[bool] = []
    conv, digest, depth = None, ROOT, 0

    def flush(n: int) -> pa.RecordBatch:
        columns = [c[:n] for c in (*rows, last)]
        for c in (*rows, last):
            del c[:n]
        kinds = pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "depth", "digest", "parent", "chars", "last"])

    for batch in batches:
        for c, t, n in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "t", "chars")), strict=True):
            if last:
                last[-1] = c != conv
            if c != conv:  # the row of pos 0
                conv, digest, depth, parent = c, ROOT, 0, ABOVE_ROOT
            else:
                parent, depth = digest, depth + 1
                digest = hashlib.sha256(parent + t).digest()[:DIGEST]
            for column, x in zip(rows, (c, depth, digest, parent, n), strict=True):
                column.append(x)
            last.append(True)
        if len(last) > 1:
            yield flush(len(last) - 1)
    if last:
        yield flush(len(last))


class PerfectTable:
    """Minimal perfect hash of distinct 128-bit keys ((n, 2) uint64).

    Level by level, keys that are alone in their cell get the next slots in
    the order of the cells, the others go on to the next level. ``owner`` has
    the key of every slot, so that a lookup never takes one key for another.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[int, int, np.ndarray]] = []  # seed, first slot, cells' ranks (-1: no or several keys)
        self.owner = np.empty_like(keys)
        left, slots = np.arange(len(keys)), 0
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("repeated keys")
            cell = self._cells(keys[left], len(self.levels), 2 * len(left))
            alone = np.bincount(cell, minlength=2 * len(left)) == 1
            rank = np.where(alone, np.cumsum(alone) - 1, -1)
            self.levels.append((len(self.levels), slots, rank))
            placed = alone[cell]
            self.owner[slots + rank[cell[placed]]] = keys[left[placed]]
            slots += int(placed.sum())
            left = left[~placed]

    @staticmethod
    def _cells(keys: np.ndarray, seed: int, n: int) -> np.ndarray:
        return (mix64(keys[:, 0] ^ mix64(keys[:, 1] + U64(seed))) % U64(n)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key; -1 for keys that are not in the table."""
        out = np.full(len(keys), -1)
        left = np.arange(len(keys))
        for seed, first, rank in self.levels:
            at = rank[self._cells(keys[left], seed, len(rank))]
            out[left[at >= 0]] = first + at[at >= 0]
            left = left[at < 0]
        found = np.flatnonzero(out >= 0)
        out[found[(self.owner[out[found]] != keys[found]).any(axis=1)]] = -1
        return out


def _keys(column) -> np.ndarray:
    raw, _ = column_buffers(column)
    return np.ascontiguousarray(raw).view(U64).reshape(-1, 2)


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = keys[np.lexsort((keys[:, 1], keys[:, 0]))]
    return keys[np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])] if len(keys) else keys


def add_up(depth: np.ndarray, parent: np.ndarray, children: np.ndarray, leaves: np.ndarray, saved: np.ndarray) -> None:
    """Adds every slot's numbers to its parent's, deepest first, in place.
    ``children``, ``leaves`` and ``saved`` come with what is known from
    outside the arrays (and the slot's own saving)."""
    order = np.argsort(-depth, kind="stable")
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(depth[order])) + 1, [len(order)]])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        at = order[a:b]
        leaves[at[children[at] == 0]] = 1
        at = at[parent[at] >= 0]
        np.add.at(children, parent[at], 1)
        np.add.at(leaves, parent[at], leaves[at])
        np.add.at(saved, parent[at], saved[at])


class _Nodes:
    """Flat arrays by slot, scattered from rows of beginnings."""

    def __init__(self, rows: pa.Table, n: np.ndarray):
        keys, above = _keys(rows["digest"]), _keys(rows["parent"])
        self.table = PerfectTable(_distinct(keys))
        self.slot = slot = self.table.slots(keys)
        size = len(self.table.owner)
        conv, depth, chars = (rows[c].to_numpy() for c in ("conv_id", "depth", "chars"))
        self.count = np.zeros(size, np.int64)
        np.add.at(self.count, slot, n)
        self.conv = np.full(size, np.iinfo(np.int64).max)
        np.minimum.at(self.conv, slot, conv)
        self.depth, self.chars, self.above = np.empty(size, np.int64), np.empty(size, np.int64), np.empty((size, 2), U64)
        self.depth[slot], self.chars[slot], self.above[slot] = depth, chars, above
        if (self.depth[slot] != depth).any() or (self.chars[slot] != chars).any() or (self.above[slot] != above).any():
            raise ValueError("two beginnings share a digest")
        self.parent = self.table.slots(self.above)
        self.children, self.leaves = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.saved = (self.count - 1) * self.chars

    def rows(self, ends: list[str | None]) -> pa.Table:
        add_up(self.depth, self.parent, self.children, self.leaves, self.saved)
        inside = self.parent >= 0
        parent_conv = pa.array(self.conv[np.where(inside, self.parent, 0)], mask=~inside)
        as_bytes = lambda keys: pa.array([k.tobytes() for k in keys], pa.binary())
        return pa.table({
            "digest": as_bytes(self.table.owner), "parent": as_bytes(self.above), "conv_id": self.conv, "depth": self.depth, "parent_conv_id": parent_conv,
            "n_convs": self.count, "n_children": self.children, "n_leaves": self.leaves, "saved_tokens": self.saved, "ends_sha256": pa.array(ends, pa.string()),
        })


_NODE = (
    "digest binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def _light_shard(rows: pa.Table) -> pa.Table:
    """All nodes of a shard's subtrees."""
    nodes = _Nodes(rows, np.ones(rows.num_rows, np.int64))
    last = rows["last"].to_numpy()
    slot, conv = nodes.slot[last], rows["conv_id"].to_numpy()[last]
    order = np.lexsort((conv, slot))
    ends = [NO_ENDS] * len(nodes.conv)
    for ids in np.split(order, np.flatnonzero(np.diff(slot[order])) + 1) if len(order) else []:
        ends[slot[ids[0]]] = hashlib.sha256(",".join(map(str, conv[ids].tolist())).encode()).hexdigest()
    return nodes.rows(ends)


def _heavy_part(rows: pa.Table) -> pa.Table:
    """All heavy nodes, with what their light children add."""
    nodes = _Nodes(rows, rows["n"].to_numpy())
    for name in ("children", "leaves", "saved"):
        np.add.at(getattr(nodes, name), nodes.slot, rows[name].to_numpy())
    return nodes.rows([None] * len(nodes.conv))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, conv_id) to (digest, first, ids joined by commas)."""
    digest, first, held, size = None, 0, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([digest], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(held)])], ["digest", "first", "ids"])

    for batch in batches:
        for d, c in zip(batch.column("digest").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if held and (d != digest or size >= PIECE_BYTES):
                yield piece()
                held = []
            if not held:
                digest, first, size = d, c, 0
            held.append(str(c))
            size += len(held[-1]) + 1
    if held:
        yield piece()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to (digest, ends_sha256)."""
    digest, state = None, None
    out = lambda: pa.RecordBatch.from_arrays([pa.array([digest], pa.binary()), pa.array([state.hexdigest()])], ["digest", "ends_sha256"])
    for batch in batches:
        for d, ids in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if d == digest:
                state.update(b",")
            else:
                if state:
                    yield out()
                digest, state = d, hashlib.sha256()
            state.update(ids.encode())
    if state:
        yield out()


def _ends_of(members: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of (digest, conv_id) rows."""
    dealt = members.repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    pieces = dealt.mapInArrow(_pieces, "digest binary, first long, ids string")
    return pieces.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(_hash_pieces, "digest binary, ends_sha256 string")


def prefix_trie(rows: DataFrame, max_heavy: int = MAX_HEAVY, min_limit: int = MIN_LIMIT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each distinct beginning of the conversations given by
    (conv_id, pos, t, chars), pos 0 being the textless one (see
    ``conversation_rows``): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = rows.sparkSession
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos").select("conv_id", "t", "chars")
    paths = cut_lineage(dealt.mapInArrow(_chain, _PATH), "beginnings")
    total = paths.count()
    limit = max(min_limit, -(-total // max_heavy))
    one_each: dict[str, Column] = {"n": F.count("*"), "conv_id": F.min("conv_id"), "depth": F.min("depth"), "parent": F.min("parent"), "chars": F.min("chars")}
    counted = paths.groupBy("digest").agg(*(c.alias(name) for name, c in one_each.items()))
    heavy = cut_lineage(counted.where(F.col("n") > limit), "heavy_beginnings")
    few = F.broadcast(heavy.select("digest"))  # fewer than total / limit <= max_heavy rows

    shards = max(bucket_count(spark), -(-total // shard_rows))
    top = F.first("digest").over(Window.partitionBy("conv_id").orderBy("depth"))
    light = paths.join(few, "digest", "left_anti").withColumn("shard", F.pmod(F.xxhash64(top), F.lit(shards)))
    low = cut_lineage(light.groupBy("shard").applyInArrow(_light_shard, _NODE), "light_nodes")

    tops = low.where(F.col("parent_conv_id").isNull()).groupBy(F.col("parent").alias("digest"))
    given = tops.agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    known = heavy.join(given, "digest", "left").na.fill(0, ["children", "leaves", "saved"])
    high = known.withColumn("trie", F.lit(0)).groupBy("trie").applyInArrow(_heavy_part, _NODE)
    ends = _ends_of(paths.where("last").join(few, "digest").select("digest", "conv_id"))
    high = high.drop("ends_sha256").join(ends, "digest", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))

    above = F.broadcast(heavy.select(F.col("digest").alias("parent"), F.col("conv_id").alias("above")))
    low = low.join(above, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return low.select(*names).unionByName(high.select(*names))
