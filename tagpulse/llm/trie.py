"""Prefix trie over conversations, as a table of its nodes.

Every distinct sequence of first d turns (role, text) is a node; the root has no turns. A
conversation is a member of all nodes it starts with.

``digested`` turns texts into 128-bit digests in the scan, so texts are never shuffled;
``sequences`` gathers each conversation's digests in order. Sequences are sorted in ranges (by
digests, then by conversation) over shards of about ``SHARD_TURNS`` turns. A shard numbers its
distinct turns, puts its distinct sequences into a ternary search tree over these numbers,
medians first, which keeps the trees of siblings balanced, and goes through the nodes once
from last to first, so children before parents, without recursion. In a range, only nodes on
the paths of its first and last sequence can have members in another range; these leave the
shard with the digest of their path. Those that two shards or more share are merged: counts
add up, and what the shards counted more than once (the node itself as a child, as a leaf, its
tokens) is corrected along the paths of shared nodes by doubling distances, so in as many
rounds as the logarithm of the deepest shared node.

A prefix, or a whole sequence, that a third of all conversations share is spread over many
shards: conversations decide ties of the sort. The ids of conversations that end in a shared
node are hashed in order from pieces of bounded size. A conversation's digests, 16 bytes a
turn, have to fit in a row, and the numbers of a shard's turns in a task.

Turns come by number (null first), those of equal number by digest; null roles and texts
are empty; repeated rows are repeated turns. Rows without a conversation id belong to no
conversation and are left out. Ids are whole numbers. Other columns are left out, whatever
their names. An empty table gives no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagpulse.llm.shared import settle

#: Turns that a shard should hold.
SHARD_TURNS = 250_000
#: Ids in one piece of a shared node's ends.
PIECE_IDS = 50_000
WIDTH = 16

TURNS = "conv_id bigint, turn, digest binary, chars bigint"
_ROOT = b"\0" * WIDTH
_NODES = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, tokens bigint, spared bigint, chars bigint, ends_sha256 string, "
    "path binary, parent_path binary, shard int, piece int, ends string"
)
_NAMES = [field.split()[0] for field in _NODES.split(", ")]
_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _digest(role: Column, text: Column) -> Column:
    # The role's length keeps role and text apart.
    named = F.concat_ws(":", F.char_length(role).cast("string"), role, text)
    return F.unhex(F.substring(F.sha2(named, 256), 1, 2 * WIDTH))


def digested(
    turns: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Turns as (conv_id, turn, digest, chars), without role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    return turns.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("conv_id"),
        F.col(turn).alias("turn"),
        _digest(role, text).alias("digest"),
        F.char_length(text).cast("bigint").alias("chars"),
    )


def sequences(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """A row a conversation: ``path``, its digests one after the other, and ``chars``. ``ids``
    (conv_id) adds conversations without turns."""
    turns = turns.select("conv_id", F.struct("turn", "digest", "chars").alias("row"))
    if ids is not None:
        turns = turns.unionByName(ids.select("conv_id"), allowMissingColumns=True)
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    path = F.unhex(F.array_join(F.transform("turns.digest", F.hex), ""))
    return gathered.select("conv_id", path.alias("path"), F.col("turns.chars").alias("chars"))


class Tree:
    """A ternary search tree over sequences of numbers; node 0 of the trie is the root."""

    def __init__(self) -> None:
        self.symbol, self.low, self.high, self.first = array("q", [0]), array("q", [0]), array("q", [0]), array("q", [0])
        self.parent = array("q", [-1])

    def _new(self, symbol: int, parent: int) -> int:
        for column, value in ((self.symbol, symbol), (self.low, 0), (self.high, 0), (self.first, 0), (self.parent, parent)):
            column.append(value)
        return len(self.symbol) - 1

    def insert(self, sequence: array) -> Iterator[int]:
        """The nodes of a sequence, the root first; those that lack are made."""
        at = 0
        yield at
        for symbol in sequence:
            if not (node := self.first[at]):
                node = self.first[at] = self._new(symbol, at)
            while (here := self.symbol[node]) != symbol:
                side = self.low if symbol < here else self.high
                if not side[node]:
                    side[node] = self._new(symbol, at)
                node = side[node]
            at = node
            yield at


def _medians(n: int) -> Iterator[int]:
    """0 to n-1, the middle of every stretch before its halves."""
    open_ = [(0, n)]
    while open_:
        start, end = open_.pop()
        if start < end:
            middle = (start + end) // 2
            yield middle
            open_ += [(middle + 1, end), (start, middle)]


def _next_path(path: bytes, digest: bytes) -> bytes:
    return hashlib.sha256(path + digest).digest()[:WIDTH]


def _joined_ids(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def _shard_nodes(rows: list[tuple[int, bytes, list[int]]], shard: int) -> Iterator[dict]:
    """The nodes of a shard's sequences (conv_id, path, chars), which are sorted."""
    digests = sorted({path[i : i + WIDTH] for _, path, _ in rows for i in range(0, len(path), WIDTH)})
    number = {digest: i for i, digest in enumerate(digests)}
    # Equal sequences follow each other.
    starts = [i for i, (_, path, _) in enumerate(rows) if i == 0 or path != rows[i - 1][1]] + [len(rows)]
    tree, depth, chars = Tree(), array("q", [0]), array("q", [0])
    ended: dict[int, tuple[int, int]] = {}
    edges: dict[int, bytes] = {}
    for group in _medians(len(starts) - 1):
        _, path, sizes = rows[starts[group]]
        known = number.__getitem__
        numbers = array("q", [known(path[i : i + WIDTH]) for i in range(0, len(path), WIDTH)])
        edge = group in (0, len(starts) - 2)
        name = _ROOT
        for level, node in enumerate(tree.insert(numbers)):
            if node == len(depth):
                depth.append(level)
                chars.append(sizes[level - 1])
            if edge:
                name = _next_path(name, path[(level - 1) * WIDTH : level * WIDTH]) if level else name
                edges[node] = name
        ended[node] = starts[group], starts[group + 1]

    n = len(depth)
    members, smallest = array("q", [0]) * n, array("q", [(1 << 63) - 1]) * n
    children, leaves = array("q", [0]) * n, array("q", [0]) * n
    # Tokens of all members, and of each node once.
    tokens, spared = array("q", [0]) * n, array("q", [0]) * n
    for node in range(n - 1, -1, -1):  # children are younger than their parents
        if node in ended:
            start, end = ended[node]
            members[node] += end - start
            smallest[node] = min(smallest[node], rows[start][0])
        leaves[node] += not children[node]
        tokens[node] += members[node] * chars[node]
        spared[node] += chars[node]
        if (up := tree.parent[node]) >= 0:
            members[up] += members[node]
            smallest[up] = min(smallest[up], smallest[node])
            children[up] += 1
            leaves[up] += leaves[node]
            tokens[up] += tokens[node]
            spared[up] += spared[node]
    for node in range(n):
        start, end = ended.get(node, (0, 0))
        edge, up = node in edges, tree.parent[node]
        row = {
            "conv_id": smallest[node],
            "depth": depth[node],
            "parent_conv_id": smallest[up] if up >= 0 else None,
            "n_convs": members[node],
            "n_children": children[node],
            "n_leaves": leaves[node],
            "tokens": tokens[node],
            "spared": spared[node],
            "chars": chars[node],
            "path": edges.get(node),
            "parent_path": edges.get(up),
            "shard": shard,
        }
        yield row | {"ends_sha256": hashlib.sha256(_joined_ids([r[0] for r in rows[start:end]]).encode()).hexdigest()}
        if edge:
            for piece, at in enumerate(range(start, end, PIECE_IDS)):
                ids = _joined_ids([r[0] for r in rows[at : min(at + PIECE_IDS, end)]])
                yield {"path": edges[node], "shard": shard, "piece": piece, "ends": ids}


def _batches(rows: Iterator[dict], size: int = 5000) -> Iterator[pa.RecordBatch]:
    kinds = {"ends_sha256": pa.string(), "ends": pa.string(), "path": pa.binary(), "parent_path": pa.binary(), "shard": pa.int32(), "piece": pa.int32()}
    held: list[dict] = []

    def batch() -> pa.RecordBatch:
        arrays = [pa.array([r.get(n) for r in held], kinds.get(n, pa.int64())) for n in _NAMES]
        return pa.RecordBatch.from_arrays(arrays, _NAMES)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held = []
    yield batch()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("conv_id", "path", "chars")]
        rows += [(c, p, array("q", s)) for c, p, s in zip(*columns, strict=True)]
    if rows:
        yield from _batches(_shard_nodes(rows, TaskContext.get().partitionId()))


def _hashed_ends(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash for the pieces of a path, which follow each other in order."""
    now, sha = None, None
    for batch in pieces:
        paths, hashes = [], []
        for path, ends in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if path != now:
                if sha is not None:
                    paths.append(now)
                    hashes.append(sha.hexdigest())
                now, sha = path, hashlib.sha256(ends.encode())
            else:
                sha.update(b"," + ends.encode())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(hashes, pa.string())], ["path", "hash"])
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([sha.hexdigest()])], ["path", "hash"])


def _over_subtrees(shared: DataFrame, deepest: int) -> DataFrame:
    """``shared`` (path, parent_path, leaves, spared) with the two summed over each subtree:
    after round k a node has the sums of all nodes fewer than 2**k below it."""
    now = shared.withColumn("up", F.col("parent_path"))
    reach = 1
    while reach <= deepest:
        below = now.where("up IS NOT NULL").groupBy(F.col("up").alias("path")).agg(
            F.sum("leaves").alias("leaves_below"), F.sum("spared").alias("spared_below")
        )
        further = now.select(F.col("path").alias("up"), F.col("up").alias("next"))
        now = (
            now.join(below, "path", "left")
            .join(further, "up", "left")
            .select(
                "path",
                (F.col("leaves") + F.coalesce("leaves_below", F.lit(0))).alias("leaves"),
                (F.col("spared") + F.coalesce("spared_below", F.lit(0))).alias("spared"),
                F.col("next").alias("up"),
            )
        )
        now = settle(now, "trie-sums")
        reach *= 2
    return now.select("path", "leaves", "spared")


def nodes(paths: DataFrame) -> DataFrame:
    """The trie's nodes of ``sequences``: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``."""
    paths = settle(paths, "sequences")
    n_turns = paths.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
    shards = max(1, -(-n_turns // SHARD_TURNS))
    sorted_ = paths.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    found = settle(sorted_.mapInArrow(_shards, _NODES), "trie")
    pieces = found.where("ends IS NOT NULL").select("path", "shard", "piece", "ends")
    found = found.where("ends IS NULL").drop("piece", "ends")

    # Nodes of two shards or more. With a shared node its parent is shared, up to the root.
    shared = found.where("path IS NOT NULL").groupBy("path").agg(
        F.count("*").alias("times"),
        *[F.min(c).alias(c) for c in ("conv_id", "depth", "parent_path", "chars")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "tokens", "spared")],
        F.sum((F.col("n_children") == 0).cast("bigint")).alias("as_leaf"),
        F.min("ends_sha256").alias("any_ends"),
    )
    shared = settle(shared.where("times > 1"), "trie-shared")
    parents = shared.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("parent"))
    known = shared.select("path")
    again = shared.where("depth > 0").groupBy(F.col("parent_path").alias("path")).agg(F.sum(F.col("times") - 1).alias("again"))
    shared = shared.join(again, "path", "left").withColumn("n_children", F.col("n_children") - F.coalesce("again", F.lit(0)))
    corrected = shared.select(
        "path",
        "parent_path",
        ((F.col("n_children") == 0).cast("bigint") - F.col("as_leaf")).alias("leaves"),
        ((1 - F.col("times")) * F.col("chars")).alias("spared"),
    )
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    sums = _over_subtrees(corrected, deepest).select(
        "path", F.col("leaves").alias("leaf_change"), F.col("spared").alias("spared_change")
    )
    ends = (
        pieces.join(known, "path", "left_semi")
        .repartition("path")
        .sortWithinPartitions("path", "shard", "piece")
        .mapInArrow(_hashed_ends, "path binary, hash string")
    )
    merged = (
        shared.join(sums, "path")
        .join(ends, "path", "left")
        .join(parents, "parent_path", "left")
        .select(
            "conv_id",
            "depth",
            F.col("parent").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            (F.col("n_leaves") + F.col("leaf_change")).alias("n_leaves"),
            (F.col("tokens") - F.col("spared") - F.col("spared_change")).alias("saved_tokens"),
            F.coalesce("hash", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
    # All other nodes are whole in their shard, but for the smallest member of a shared parent.
    found = found.withColumn("saved_tokens", F.col("tokens") - F.col("spared"))
    at_edges = (
        found.where("path IS NOT NULL OR parent_path IS NOT NULL")
        .join(known, "path", "left_anti")
        .join(parents, "parent_path", "left")
        .withColumn("parent_conv_id", F.coalesce("parent", "parent_conv_id"))
    )
    inside = found.where("path IS NULL AND parent_path IS NULL")
    return inside.select(*_RESULT).unionByName(at_edges.select(*_RESULT)).unionByName(merged.select(*_RESULT))
