"""The prefix trie of conversations, by time-forward processing.

A node is a distinct sequence of first turns. Its key is a digest chained along the sequence (128
bits of SHA-256), so nodes are found by one pass over sorted turns and a grouping by key.
Totals of subtrees then travel upwards: nodes are sorted by reverse level order, and a node sends what its
subtree adds up to to its parent, which comes later in that order. Messages under way wait in a
priority queue ordered like the nodes, which writes sorted runs to disk when it is full, so memory does not
depend on the width of a level.

Shards. A subtree with at most SHARD_CONVS members stays in one shard; its root's parent has more. The
roots of shards add up their totals per parent, and the nodes with more members form a much smaller
tree that is processed in the same way with FANOUT times as many members a shard, until no
larger node is left. Very common first turns are such large nodes: their children meet only as sums.

Defined results: rows without conv_id belong to no conversation and take no part; turns of a conversation
are ordered by turn (null first), then role, then the digest of the turn, and repeated rows count again; null roles and texts are
empty; other columns are not read. A conversation's turns are read one after the other by one task, which
keeps only the digest of its last one.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoloom.session import stored

# Most members of a subtree that is kept in one shard.
SHARD_CONVS = 100
# Growth of that number from one level of shards to the next.
FANOUT = 1_000
# Messages a priority queue holds in memory before it writes a run.
QUEUE_ROWS = 200_000
# Ids of members in one piece of text on the way to their hash.
PIECE_IDS = 50_000

KEY_BYTES = 16
SPACE = "[\\x20\\x09-\\x0D]+"
PATHS = "conv_id bigint, depth bigint, node binary, parent binary, tokens bigint, last boolean"
TOTALS = "node binary, depth bigint, parent binary, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, top boolean"


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, tokens): every turn's place, its digest, and the number of words of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    tokens = F.size(F.array_remove(F.split(text, SPACE), "")).cast("long")
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"), role.alias("role"), turn.alias("turn"), tokens.alias("tokens"))
    order = Window.partitionBy("conv_id").orderBy(F.col("at").asc_nulls_first(), "role", "turn")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), "turn", "tokens")


def _starts(turns: DataFrame) -> DataFrame:
    nothing = [F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("tokens")]
    return turns.where("pos = 0").select("conv_id", *nothing)


def shared_heads(turns: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """Conversations rebuilt on the first turns of their group's first one.

    Conversation c starts with the first h turns of conversation ``c - c % group`` (fewer, if it is shorter or absent) and goes
    on with its own turns after its first h; h = crc32 of c in decimals, modulo ``heads``.
    """
    turns = stored(turns, "turns")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    named = turns.select("*", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("leader"))
    own = named.where("pos >= h OR leader = conv_id").select("conv_id", "pos", "turn", "tokens")
    followers = named.where("pos = 0 AND h > 0 AND leader <> conv_id").select("conv_id", "h", "leader")
    first = turns.where(F.col("pos") < heads).select(F.col("conv_id").alias("leader"), "pos", "turn", "tokens")
    lent = followers.join(first, "leader").where("pos < h").select("conv_id", "pos", "turn", "tokens")
    # a conversation may be left without any turn, and still is one
    return own.unionByName(lent).unionByName(_starts(turns))


def with_starts(turns: DataFrame) -> DataFrame:
    """Turns as they are, and the empty start of every conversation."""
    return turns.unionByName(_starts(turns))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to nodes: every row gets the key of its prefix and of the prefix before."""
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("tokens", pa.int64()), ("last", pa.bool_())])
    held, key, depth = None, None, 0
    for batch in batches:
        rows = []
        for conv, turn, tokens in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "tokens"))):
            if held is not None:
                rows.append((*held, held[0] != conv))
            if turn is None:
                key, depth, parent = bytes(KEY_BYTES), 0, None
            else:
                parent = key
                key, depth = hashlib.sha256(parent + turn).digest()[:KEY_BYTES], depth + 1
            held = (conv, depth, key, parent, tokens)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * 6, schema)], schema=schema)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*held, True), schema)], schema=schema)


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, tokens, last): one row per conversation and prefix, the empty one included."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos").select("conv_id", "turn", "tokens").mapInArrow(_chain, PATHS)


class SpillingQueue:
    """A priority queue of messages (level, node, leaves, saved) that keeps ``limit`` of them in memory."""

    RECORD = struct.Struct(f"<q{KEY_BYTES}sqq")

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit, self.heap, self.runs = limit, [], []

    def push(self, message: tuple[int, bytes, int, int]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        """Write the messages in memory as a sorted run to a nameless file, gone with the task."""
        file = tempfile.TemporaryFile()
        for message in sorted(self.heap):
            file.write(self.RECORD.pack(*message))
        file.seek(0)
        self.heap = []
        self._next(file)

    def _next(self, file) -> None:
        record = file.read(self.RECORD.size)
        if record:
            heapq.heappush(self.runs, (self.RECORD.unpack(record), id(file), file))
        else:
            file.close()

    def take(self, level: int, node: bytes) -> Iterator[tuple[int, bytes, int, int]]:
        """All messages to a node, which is the first of those that still wait for any."""
        target = (level, node)
        while self.heap and self.heap[0][:2] == target:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:2] == target:
            message, _, file = heapq.heappop(self.runs)
            self._next(file)
            yield message


def _forward(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nodes by reverse level order, with what other shards have sent; out come their totals."""
        queue = SpillingQueue(limit)
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("node", "depth", "parent", "n_convs", "tokens", "top", "n_children", "n_leaves", "saved_tokens")}
            children, leaves, saved = columns["n_children"], columns["n_leaves"], columns["saved_tokens"]
            for i, (node, depth) in enumerate(zip(columns["node"], columns["depth"])):
                for _, _, below, tokens in queue.take(-depth, node):
                    children[i] += 1
                    leaves[i] += below
                    saved[i] += tokens
                if children[i] == 0:
                    leaves[i] = 1
                saved[i] += (columns["n_convs"][i] - 1) * columns["tokens"][i]
                if not columns["top"][i]:
                    queue.push((1 - depth, columns["parent"][i], leaves[i], saved[i]))
            sums = [pa.array(x, pa.int64()) for x in (children, leaves, saved)]
            out = [batch.column(c) for c in ("node", "depth", "parent", "conv_id", "n_convs")] + sums + [batch.column("top")]
            yield pa.RecordBatch.from_arrays(out, ["node", "depth", "parent", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "top"])

    return run


def totals(steps: DataFrame, shard_convs: int = SHARD_CONVS, fanout: int = FANOUT, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """One row per node of the stored ``paths`` with the totals of its subtree.

    ``top`` marks the root of a shard of the lowest level, whose parent has more than ``shard_convs`` members.
    """
    nodes = stored(steps.groupBy("node").agg(
        F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.max("tokens").alias("tokens")), "nodes")
    sums = ["n_children", "n_leaves", "saved_tokens"]
    rest = nodes.select("*", *[F.lit(0).cast("long").alias(c) for c in sums])
    limit, found = shard_convs, []
    while True:
        small, large = rest.where(F.col("n_convs") <= limit), stored(rest.where(F.col("n_convs") > limit), "large")
        # the shard of a small node is the first small node on the way to it, read off the path of its smallest member
        on_path = steps.select("conv_id", "depth", "node")
        if found:  # only the larger nodes and their smallest members are left
            on_path = on_path.join(rest.select("node"), "node", "left_semi").join(rest.select("conv_id").distinct(), "conv_id", "left_semi")
        first = on_path.join(large.select("node"), "node", "left_anti").groupBy("conv_id").agg(F.min(F.struct("depth", "node")).alias("first"))
        placed = small.join(first.select("conv_id", F.col("first.node").alias("shard")), "conv_id")
        placed = placed.select("*", (F.col("node") == F.col("shard")).alias("top"))
        order = placed.repartition("shard").sortWithinPartitions(F.col("depth").desc(), "node")
        done = stored(order.drop("shard").mapInArrow(_forward(queue_rows), TOTALS), "totals")
        found.append(done)
        sent = done.where("top AND parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.count(F.lit(1)).alias("__children"), F.sum("n_leaves").alias("__leaves"), F.sum("saved_tokens").alias("__saved"))
        if large.isEmpty():
            break
        given = large.join(sent, "node", "left")
        rest = stored(given.select(
            *[c for c in nodes.columns],
            (F.col("n_children") + F.coalesce("__children", F.lit(0))).alias("n_children"),
            (F.col("n_leaves") + F.coalesce("__leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("__saved", F.lit(0))).alias("saved_tokens")), "rest")
        limit *= fanout
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more.withColumn("top", F.lit(True)))
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) to pieces of comma-joined ids, at most PIECE_IDS each."""
    node, ids, start = None, [], 0

    def piece() -> pa.RecordBatch:
        text = ",".join(map(str, ids))
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([start], pa.int64()), pa.array([text])], ["node", "start", "ids"])

    out = []
    for batch in batches:
        for key, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if key != node or len(ids) >= PIECE_IDS:
                if ids:
                    out.append(piece())
                node, ids, start = key, [], conv
            ids.append(conv)
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()
            out = []
    if ids:
        yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one SHA-256 a node, fed piece by piece."""
    node, digest, nodes, hashes = None, None, [], []
    for batch in batches:
        for key, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if key == node:
                digest.update(b"," + text.encode())
            else:
                if digest is not None:
                    nodes.append(node)
                    hashes.append(digest.hexdigest())
                node, digest = key, hashlib.sha256(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(hashes, pa.string())], ["node", "ends_sha256"])
        nodes, hashes = [], []
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])


def ends(steps: DataFrame) -> DataFrame:
    """(node, ends_sha256): hash of the ids of the conversations that end in a node, ascending, comma-joined.

    A node where very many end is cut over ranges of ids first; the hash itself, which is
    sequential by nature, reads only a few long pieces.
    """
    last = steps.where("last").select("node", "conv_id")
    ranged = last.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ranged.mapInArrow(_pieces, "node binary, start bigint, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "start").mapInArrow(_digests, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, shard_convs: int = SHARD_CONVS, fanout: int = FANOUT, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """All nodes of the trie of ``turns`` (of ``shared_heads`` or ``with_starts``).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    steps = stored(paths(turns), "paths")
    nodes = totals(steps, shard_convs, fanout, queue_rows)
    name = [F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")]
    # a small parent has few children; the large ones, which may have very many, are few
    small, large = nodes.where(F.col("n_convs") <= shard_convs).select(*name), nodes.where(F.col("n_convs") > shard_convs).select(*name)
    inside = nodes.where("NOT top").join(small, "parent", "left")
    across = nodes.where("top").join(large, "parent", "left")
    named = inside.unionByName(across).join(ends(steps), "node", "left")
    none = hashlib.sha256(b"").hexdigest()
    return named.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
