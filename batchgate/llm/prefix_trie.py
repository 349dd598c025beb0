"""Conversation prefix trie: nodes in minimal-perfect-hash tables, one table a shard.

A node is a distinct sequence of turns that conversations begin with.  Its digest follows from its
parent's digest and its last turn, so conversations find their nodes one by one, in one stream
over sorted turns.

1. **Shards.**  Conversations are dealt to shards by hash, long ones in segments of at most
   SEGMENT turns, so a shard has a bounded number of turns on average whatever they share.  Each
   shard enumerates its distinct digests, gives them slots by a minimal perfect hash whose slots
   are verified against the digests, and scatters members, ends and smallest members into flat
   arrays.  A segment also holds the node before it, so every node finds its parent's slot.
2. **Nodes.**  The shards' nodes add up by digest: at most one row a shard and node, however many
   conversations share it.  A node without a member that goes on is a leaf; the shard of its
   smallest member owns it.
3. **Subtrees.**  Back in the shards, owned nodes scatter what they add (themselves if leaves,
   themselves as children, saved tokens) into the same arrays; values then go from slot to parent
   slot, deepest nodes first.  Every node of a shard has its ancestors there, up to the segment's
   beginning; what later segments of a conversation hold is added where they begin.  The shards'
   sums add up by digest again.
4. **Ends.**  The ids of the members that end in a node are range-sorted with the node, joined to
   blocks, and the blocks stream in order through one SHA-256 a node.

Memory of a task: one shard's nodes, or a stream.  A turn's text leaves the first stream as its
number of code points.

Cases: rows without a conv_id take no part; a null role or text is empty, a null turn comes first,
equal turns go by role and text; repeated rows are turns of their own; an empty table has no
conversations and no nodes; other columns are ignored.  Digests of 128 bits are taken to differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import mixed, staged, tidy

ROOT = hashlib.blake2b(b"", digest_size=16).digest()
# Turns of one conversation that one shard holds, and turns of a shard on average.
SEGMENT = 4096
SHARD_TURNS = 200_000
# Ids that are joined before they reach a node's hash.
BLOCK_IDS = 4096
FAMILY, SHARED = 100, 6
_U = np.uint64


def minimal_perfect_hash(keys: np.ndarray) -> np.ndarray:
    """A slot from 0 to n - 1 for each of n distinct keys (n x 2 numbers), without gaps.

    In each round the keys left fall into an array of twice their number; those alone in their
    place keep it, the others go on.  A key's slot is the rank of its place among all kept ones.
    """
    slots = np.full(len(keys), -1, np.int64)
    left, taken, turn = np.arange(len(keys)), 0, 0
    while len(left):
        turn += 1
        size = 2 * len(left)
        place = (mixed(mixed(keys[left, 0] + _U(turn)) ^ keys[left, 1]) % _U(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        rank = np.cumsum(alone) - 1
        kept = alone[place]
        slots[left[kept]] = taken + rank[place[kept]]
        taken += int(kept.sum())
        left = left[~kept]
        if turn > 200:
            raise ValueError("keys are not distinct")
    return slots


class NodeTable:
    """The nodes of one shard: digest, depth and parent's slot by slot."""

    def __init__(self, digests: np.ndarray, parents: np.ndarray, depths: np.ndarray):
        """Rows of digests (n x 2), repeated or not; a parent that is not among them has slot -1."""
        kinds = np.dtype([("a", "<u8"), ("b", "<u8")])
        view = lambda x: np.ascontiguousarray(x).view(kinds).ravel()
        distinct, one, owner = np.unique(view(digests), return_index=True, return_inverse=True)
        keys = np.ascontiguousarray(digests[one])
        slot = minimal_perfect_hash(keys)
        self.size = len(keys)
        self.digest = np.zeros_like(keys)
        self.digest[slot] = keys
        self.slot = slot[owner]  # of each row
        if not np.array_equal(self.digest[self.slot], digests):
            raise ValueError("a slot holds another digest")
        self.depth = np.zeros(self.size, np.int64)
        self.depth[self.slot] = depths
        self.row = np.zeros(self.size, np.int64)  # a row of each slot
        self.row[slot] = one
        at = np.searchsorted(distinct, view(parents[one]))
        at = np.minimum(at, max(len(distinct) - 1, 0))
        there = distinct[at] == view(parents[one]) if len(distinct) else np.zeros(0, bool)
        self.parent = np.full(self.size, -1, np.int64)
        self.parent[slot] = np.where(there, slot[at], -1)
        self.parent[self.depth == 0] = -1

    def scattered(self, values: np.ndarray, add=np.add, start: int = 0) -> np.ndarray:
        """Values of rows by slot."""
        out = np.full(self.size, start, np.int64)
        add.at(out, self.slot, values)
        return out

    def accumulated(self, values: np.ndarray) -> np.ndarray:
        """Values by slot, summed over subtrees through the parents' slots, deepest nodes first."""
        out = values.copy()
        order = np.argsort(-self.depth, kind="stable")
        edges = np.flatnonzero(np.diff(self.depth[order], prepend=-1)).tolist() + [self.size]
        for a, b in zip(edges, edges[1:]):
            at = order[a:b]
            at = at[self.parent[at] >= 0]
            np.add.at(out, self.parent[at], out[at])
        return out


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv, at (from 1), role, text of the rebuilt conversations; at is 0 in one row of each.

    The first h turns of conversation c - c % 100, then the turns of c after its first h, with
    h = crc32 of c in decimal, modulo 6.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", text("role"), text("text"))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, at = None, 0
        for batch in batches:
            ids = batch.column("conv").to_numpy()
            numbers = np.zeros(len(ids), np.int64)
            for k, c in enumerate(ids.tolist()):
                conv, at = c, at + 1 if c == conv else 1
                numbers[k] = at
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array(numbers), batch.column("role"),
                 batch.column("text")], ["conv", "at", "role", "text"])

    placed = staged(rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
                    .mapInArrow(tidy(numbered), "conv long, at long, role string, text string"))
    n_shared = F.crc32(F.col("conv").cast("string")) % SHARED
    convs = placed.where("at = 1").select("conv", n_shared.alias("h"))
    own = placed.where(F.col("at") > n_shared)
    first = placed.where(F.col("at") < SHARED).withColumnRenamed("conv", "base")
    lent = convs.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).join(
        first, "base").where(F.col("at") <= F.col("h")).select("conv", "at", "role", "text")
    none = convs.select("conv", F.lit(0).cast("long").alias("at"), F.lit("").alias("role"),
                        F.lit("").alias("text"))
    return own.unionByName(lent).unionByName(none)


def paths(conversations: DataFrame) -> DataFrame:
    """conv, depth, digest, parent, chars, ends: the node of every beginning of every conversation.

    The last turn of a conversation is known when the next one comes, so a row waits for it.
    """
    names = ["conv", "depth", "digest", "parent", "chars", "ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list | None = None

        def out(rows: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            rows = []
            for conv, role, text in zip(*(batch.column(c).to_pylist()
                                          for c in ("conv", "role", "text"))):
                if last is not None:
                    last[5] = conv != last[0]
                    rows.append(last)
                if last is None or conv != last[0]:  # the row of the root comes first
                    last = [conv, 0, ROOT, ROOT, 0, False]
                    continue
                one = role.encode()
                node = hashlib.blake2b(last[2] + len(one).to_bytes(8, "little") + one
                                       + text.encode(), digest_size=16).digest()
                last = [conv, last[1] + 1, node, last[2], len(text), False]
            if rows:
                yield out(rows)
        if last is not None:
            last[5] = True
            yield out([last])

    ordered = conversations.repartition("conv").sortWithinPartitions("conv", "at")
    return ordered.select("conv", "role", "text").mapInArrow(
        tidy(run), "conv long, depth long, digest binary, parent binary, chars long, ends boolean")


def _numbers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def _digests(numbers: np.ndarray) -> pa.Array:
    ends = np.arange(len(numbers) + 1, dtype=np.int32) * 16
    return pa.Array.from_buffers(pa.binary(), len(numbers), [
        None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(numbers))])


def _per_shard(rows: DataFrame, shards: int, work, schema: str) -> DataFrame:
    """``work`` on the rows of each shard, as one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            ids = batch.column("shard").to_numpy()
            edges = np.flatnonzero(np.diff(ids, prepend=-1)).tolist() + [len(ids)]
            for a, b in zip(edges, edges[1:]):
                if b > a:
                    if held and ids[a] != now:
                        yield work(pa.Table.from_batches(held).combine_chunks())
                        held = []
                    now = ids[a]
                    held.append(batch.slice(a, b - a))
        if held:
            yield work(pa.Table.from_batches(held).combine_chunks())

    return rows.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(
        tidy(run), schema)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def shard_nodes(path_rows: DataFrame, shards: int, segment: int) -> DataFrame:
    """One row a shard and node: members, ends and smallest member within the shard.

    ``key`` names the node in its table.  A segment's first nodes have the ``lent`` node before
    it as parent, under a key of its own: the node's members are in other shards, or elsewhere in
    this one.
    """
    part = F.greatest(F.floor((F.col("depth") - 1) / segment), F.lit(0))
    place = lambda p: F.pmod(F.xxhash64("conv", p), F.lit(shards)).cast("int")
    other = lambda c: F.unhex(F.md5(c))
    first = (F.col("depth") > 1) & ((F.col("depth") - 1) % segment == 0)
    own = path_rows.withColumn("key", F.col("digest")).withColumn(
        "above", F.when(first, other("parent")).otherwise(F.col("parent")))
    lent = path_rows.where((F.col("depth") > 0) & (F.col("depth") % segment == 0) & ~F.col("ends"))
    lent = lent.withColumn("key", other("digest")).withColumn("above", F.lit(bytes(16)))
    rows = own.select("*", place(part).alias("shard"), F.lit(False).alias("lent")).unionByName(
        lent.select("*", place(F.floor(F.col("depth") / segment)).alias("shard"),
                    F.lit(True).alias("lent")))

    def work(rows: pa.Table) -> pa.RecordBatch:
        table = NodeTable(_numbers(rows.column("key")), _numbers(rows.column("above")),
                          _column(rows, "depth"))
        own = ~_column(rows, "lent")
        conv = np.where(own, _column(rows, "conv"), np.iinfo(np.int64).max)
        members = table.scattered(own.astype(np.int64))
        ends = table.scattered((own & _column(rows, "ends")).astype(np.int64))
        smallest = table.scattered(conv, np.minimum, np.iinfo(np.int64).max)
        one = pa.array(table.row)
        same = lambda name: rows.column(name).combine_chunks().take(one)
        return pa.RecordBatch.from_arrays(
            [same("shard"), _digests(table.digest), same("above"), same("digest"),
             pa.array(table.depth), same("chars"), same("lent"), pa.array(members),
             pa.array(ends), pa.array(smallest)],
            ["shard", "key", "above", "digest", "depth", "chars", "lent", "members", "ends",
             "smallest"])

    return _per_shard(rows, shards, work, (
        "shard int, key binary, above binary, digest binary, depth long, chars long, "
        "lent boolean, members long, ends long, smallest long"))


def subtree_sums(nodes_of_shards: DataFrame, shards: int) -> DataFrame:
    """One row a shard and node: what the shard adds to the subtree, and the parent's member."""

    def work(rows: pa.Table) -> pa.RecordBatch:
        table = NodeTable(_numbers(rows.column("key")), _numbers(rows.column("above")),
                          _column(rows, "depth"))
        owned, lent = _column(rows, "owned").astype(np.int64), _column(rows, "lent")
        leaf = table.scattered(owned * _column(rows, "leaf") + _column(rows, "below_leaves"))
        saved = table.scattered(owned * _column(rows, "weight") + _column(rows, "below_saved"))
        mine, member = table.scattered(owned), table.scattered(_column(rows, "conv_id"))
        inside = np.flatnonzero(table.parent >= 0)
        children = np.zeros(table.size, np.int64)
        np.add.at(children, table.parent[inside], mine[inside])
        above = np.where(table.parent >= 0, member[table.parent], -1)
        known = (table.parent >= 0) & (mine > 0)
        # A lent node's subtree is summed where its members are.
        shown = ~lent[table.row]
        sums = [np.where(shown, table.accumulated(x), 0) for x in (leaf, saved)]
        return pa.RecordBatch.from_arrays(
            [rows.column("digest").combine_chunks().take(pa.array(table.row)),
             *map(pa.array, sums), pa.array(children), pa.array(above, mask=~known)],
            ["digest", "n_leaves", "saved_tokens", "n_children", "parent_conv_id"])

    return _per_shard(nodes_of_shards, shards, work, (
        "digest binary, n_leaves long, saved_tokens long, n_children long, parent_conv_id long"))


def ends_digests(path_rows: DataFrame) -> DataFrame:
    """digest and the hash of the ids of the conversations that end there."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        for batch in batches:
            rows = []
            for digest, conv in zip(batch.column("digest").to_pylist(),
                                    batch.column("conv").to_pylist()):
                if ids and (digest != node or len(ids) >= BLOCK_IDS):
                    rows.append((node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = digest
                ids.append(conv)
            yield out(rows, ["digest", "first", "ids"],
                      [pa.binary(), pa.int64(), pa.string()])
        if ids:
            yield out([(node, ids[0], ",".join(map(str, ids)))], ["digest", "first", "ids"],
                      [pa.binary(), pa.int64(), pa.string()])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            rows = []
            for digest, ids in zip(batch.column("digest").to_pylist(),
                                   batch.column("ids").to_pylist()):
                if digest == node:
                    sha.update(b"," + ids.encode())
                    continue
                if node is not None:
                    rows.append((node, sha.hexdigest()))
                node, sha = digest, hashlib.sha256(ids.encode())
            yield out(rows, ["digest", "ends_sha256"], [pa.binary(), pa.string()])
        if node is not None:
            yield out([(node, sha.hexdigest())], ["digest", "ends_sha256"],
                      [pa.binary(), pa.string()])

    def out(rows, names, kinds):
        columns = zip(*rows) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names)

    ends = path_rows.where("ends").select("digest", "conv")
    width = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = ends.repartitionByRange(width, "digest", "conv").sortWithinPartitions(
        "digest", "conv").mapInArrow(tidy(joined), "digest binary, first long, ids string")
    return blocks.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(
        tidy(hashed), "digest binary, ends_sha256 string")


def trie(turns: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the rebuilt conversations, one row each."""
    path_rows = staged(paths(rebuilt(turns)))
    shards = max(1, -(-path_rows.count() // shard_turns))
    local = staged(shard_nodes(path_rows, shards, segment))
    nodes = staged(local.where("not lent").groupBy("digest").agg(
        F.sum("members").alias("n_convs"), F.sum("ends").alias("n_ends"),
        F.min(F.struct("smallest", "shard")).alias("own"), F.max("depth").alias("depth"),
        F.max("chars").alias("chars")).select(
        "digest", "n_convs", "depth", F.col("own.smallest").alias("conv_id"),
        F.col("own.shard").alias("own_shard"),
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("weight")))

    # What the segments behind a node hold that are owned by one conversation.
    number = lambda d: F.greatest(F.floor((F.col(d) - 1) / segment), F.lit(0))
    long_ones = path_rows.where((F.col("depth") % segment == 0) & ~F.col("ends")
                                & (F.col("depth") > 0)).select("conv", "depth", "digest")
    owned = nodes.where(F.col("depth") > segment).groupBy(
        F.col("conv_id").alias("conv"), number("depth").alias("segment")).agg(
        F.sum("leaf").alias("leaves"), F.sum("weight").alias("saved"))
    below = long_ones.join(owned, "conv").where(
        F.col("segment") * segment >= F.col("depth")).groupBy("conv", "digest", "depth").agg(
        F.sum("leaves").alias("below_leaves"), F.sum("saved").alias("below_saved"))
    place = F.pmod(F.xxhash64("conv", number("depth")), F.lit(shards)).cast("int")
    below = below.select("digest", place.alias("shard"), "below_leaves", "below_saved").groupBy(
        "digest", "shard").agg(F.sum("below_leaves").alias("below_leaves"),
                               F.sum("below_saved").alias("below_saved"))

    facts = local.select("shard", "key", "above", "digest", "lent").join(nodes, "digest").join(
        below.withColumn("lent", F.lit(False)), ["digest", "shard", "lent"], "left").select(
        "shard", "key", "above", "digest", "lent", "depth", "conv_id", "leaf", "weight",
        ((F.col("shard") == F.col("own_shard")) & ~F.col("lent")).alias("owned"),
        F.coalesce("below_leaves", F.lit(0)).alias("below_leaves"),
        F.coalesce("below_saved", F.lit(0)).alias("below_saved"))
    sums = subtree_sums(facts, shards).groupBy("digest").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.sum("n_children").alias("n_children"), F.max("parent_conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(sums, "digest").join(ends_digests(path_rows), "digest", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"), "digest")


def op12_prefix_trie(turns: DataFrame) -> DataFrame:
    """All nodes of the rebuilt conversations' trie."""
    return trie(turns).drop("digest")
