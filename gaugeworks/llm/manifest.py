"""Merkle manifest of a table by time-forward processing.

Every row is a leaf. The leaves of a group (a language) are ordered by id; 8 consecutive
nodes become their parent until one node, the group's subroot, is left; the subroots become
the root in the same way. A node's label says when it is processed: after all its children
and before its right neighbour's first leaf. Values travel along the edges of the tree as
messages addressed to labels and are handed out in label order by a priority queue:

* forward, every node takes the digests of its children from the queue and sends its own
  digest to its parent's label;
* backward, from the root, every node takes the proof suffix its parent has sent (the
  siblings from its level up to the root) and sends each child its siblings and the suffix.

The queue lives in two places. Trees are cut into blocks of ``8 ** 3`` consecutive nodes of
one level; inside a block it is a heap in the task, which never holds more than seven
messages a level. Messages that leave a block, the block's digest on the way up and the
suffix for a block on the way down, go through Spark's sorted shuffle, which spills: it
delivers them to the task of the block, before the block's own rows, in the order of the
labels. A level of blocks is one shuffle; n leaves take log(n) / log(512) of them.
"""

from __future__ import annotations

import heapq
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.ranks import ranked
from gaugeworks.llm.text import folded
from gaugeworks.session import cut_lineage

FAN, LEVELS = 8, 3
SPAN = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: Iterable[bytes]) -> bytes:
    """Digest of the concatenated digests, which are hashed as hex text."""
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def height(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


@dataclass
class Block:
    """Consecutive nodes of one level of a tree, and the nodes above them up to the block's top."""

    leaves: int
    levels: int
    runs: dict[tuple[int, int], list[bytes]] = field(default_factory=dict)  # children by parent's label

    def parent(self, label: tuple[int, int]) -> tuple[int, int]:
        """Label of the parent: its last leaf here, then its level."""
        last, level = label
        width = FAN ** (level + 1)
        return min((last // width + 1) * width, self.leaves) - 1, level + 1

    def forward(self, digests: Iterable[bytes], keep: bool = False) -> bytes:
        """Digest of the block; with ``keep`` the children of every node stay in ``runs``."""
        queue: list[tuple[tuple[int, int], int, bytes]] = []
        sent = 0
        value = b""
        for last, value in enumerate(digests):
            label = (last, 0)
            while label[1] < self.levels:
                heapq.heappush(queue, (self.parent(label), sent, value))
                sent += 1
                if queue[0][0][0] != last:
                    break
                label, children = queue[0][0], []
                while queue and queue[0][0] == label:  # messages to one label come in order of sending
                    children.append(heapq.heappop(queue)[2])
                if keep:
                    self.runs[label] = children
                value = digest(children)
        return value

    def backward(self, shape: bytes, siblings: bytes) -> Iterator[tuple[int, bytes, bytes]]:
        """``(leaf, shape, siblings)`` from the last leaf to the first, after ``forward(keep=True)``.

        ``siblings`` is the concatenation of the siblings' digests from the leaf's level up,
        ``shape`` has two bytes a level, the node's position in its run and how many siblings
        it has. The block's own ones are appended to those given for its top.
        """
        queue = [(1 - self.leaves, -self.levels, shape, siblings)]  # labels in descending order
        while queue:
            last, level, shape, siblings = heapq.heappop(queue)
            if not level:
                yield -last, shape, siblings
                continue
            run = self.runs[-last, -level]
            width = FAN ** (-level - 1)
            first = -last // (width * FAN) * FAN
            for position in range(len(run)):
                end = min((first + position + 1) * width, self.leaves) - 1
                others = b"".join(run[:position] + run[position + 1 :])
                heapq.heappush(queue, (-end, level + 1, bytes((position, len(run) - 1)) + shape, others + siblings))


def proof_steps(shape: bytes, siblings: bytes) -> list[tuple[int, list[str]]]:
    """(position, siblings as hex text) from the leaf's level to the root's."""
    text, steps, at = siblings.hex(), [], 0
    for position, count in zip(shape[::2], shape[1::2]):
        steps.append((position, [text[k : k + 64] for k in range(at, at + 64 * count, 64)]))
        at += 64 * count
    return steps


def fold(leaf: bytes, shape: bytes, siblings: bytes) -> str:
    """The root, as hex text, that a leaf and its proof lead to."""
    value, text, at = leaf.hex(), siblings.hex(), 0
    for position, count in zip(shape[::2], shape[1::2]):
        own, end = at + 64 * position, at + 64 * count
        value = hashlib.sha256(f"{text[at:own]}{value}{text[own:end]}".encode()).hexdigest()
        at = end
    return value


def leaf_digest(text: Column) -> Column:
    """SHA-256 of a row: every field as byte count, colon and value, or - where it is null."""
    fields = [(text if name == "text" else F.col(name)).cast("string") for name in FIELDS]
    parts = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each (tree, block), which follow each other."""
    key, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row)
    if held:
        yield key, held


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """Rows sorted by tree, block and rank; the message to a block, which has no rank, comes first."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", F.col("rank").asc_nulls_first())


def _block_of(size: int, leaves: int) -> Block:
    """A tree of one block ends at its own height; blocks of larger trees have the same height."""
    return Block(leaves, LEVELS if size > SPAN else height(size))


def _up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for (tree, block), rows in _blocks(batches):
        size = rows[0][2]
        out.append((tree, -(-size // SPAN), block, _block_of(size, len(rows)).forward(r[4] for r in rows)))
    if out:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["tree", "size", "rank", "digest"])


NODE = "tree bigint, size bigint, rank bigint, digest binary"
MESSAGE = "tree bigint, block bigint, shape binary, siblings binary, subroot binary"


def up(nodes: DataFrame) -> DataFrame:
    """Digests of all blocks: the nodes ``LEVELS`` further up, or the tree's last node."""
    rows = nodes.select("tree", F.floor(F.col("rank") / SPAN).alias("block"), "size", "rank", "digest")
    return cut_lineage(_in_blocks(rows).mapInArrow(_up, NODE))


def _messages(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[tuple], list[tuple], bytes]]:
    """Per block its rows, the suffix of each (in the order of the rows) and the subroot."""
    for _, (message, *rows) in _blocks(batches):
        shape, siblings, subroot = message[5:8]
        block = _block_of(rows[0][2], len(rows))
        block.forward((r[4] for r in rows), keep=True)
        found = [s[1:] for s in block.backward(shape, siblings)]
        yield rows, found[::-1], subroot


def _down(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, suffixes, subroot in _messages(batches):
        columns = [[r[0] for r in rows], [r[3] for r in rows], *zip(*suffixes), [subroot] * len(rows)]
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["tree", "block", "shape", "siblings", "subroot"])


def addressed(nodes: DataFrame, messages: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """The nodes of a level and the message to each of their blocks, in the order of labels."""
    rows = nodes.select("tree", F.floor(F.col("rank") / SPAN).alias("block"), "size", "rank", "digest", *more)
    return _in_blocks(rows.unionByName(messages, allowMissingColumns=True).select(
        "tree", "block", "size", "rank", "digest", "shape", "siblings", "subroot", *more
    ))


def down(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    """The messages to all nodes of a level, each the top of a block of the level below."""
    return cut_lineage(addressed(nodes, messages).mapInArrow(_down, MESSAGE))


def grown(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """All levels of blocks from the leaves to one node per tree."""
    levels = [nodes]
    while len(levels) == 1 or largest > 1:
        levels.append(up(levels[-1]))
        largest = -(-largest // SPAN)
    return levels


SCHEMA = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
PROOF = "array<struct<position:int,siblings:array<string>>>"


def manifest(docs: DataFrame, text_now: Column | None = None, with_proof: bool = False) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and whether the row still leads to the root.

    The manifest is that of the rows as given; ``text_now`` is what the text is found to be
    at verification (default: unchanged). One row per document: ``doc_id, leaf, subroot,
    root, proof_sha256`` (of all siblings from the leaf to the root), ``folded_root`` (from
    the row as found and its proof), ``verified`` (that equals the root). With
    ``with_proof`` also ``proof``, an array of (position, siblings) by level.

    Nulls in any column are hashed as -, different from an empty text. A null lang is a
    group of its own, the first; null doc_ids come first in their group. Rows with equal
    doc_id are leaves of their own, ordered by their digests; rows equal in everything are
    neighbouring leaves. A single row is its own subroot and root, with an empty proof.
    Empty table: no rows. Further columns of any name are ignored.
    """
    spark = docs.sparkSession
    text = F.col("text")
    now = text if text_now is None else text_now
    rows = (
        docs.withColumn("_now", now)
        .select(*FIELDS, "_now")
        .select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "lang",
            leaf_digest(text).alias("digest"),
            F.when(~F.col("_now").eqNullSafe(text), leaf_digest(F.col("_now"))).alias("found"),
            F.monotonically_increasing_id().alias("tie"),
        )
    )
    placed = ranked(rows, [F.col(c) for c in ("lang", "doc_id", "digest", "tie")], "place")
    groups = placed.groupBy("lang").agg(F.count("*").alias("size"), F.min("place").alias("first"))
    trees = ranked(groups, [F.col("lang")], "tree").withColumnRenamed("lang", "_lang")
    total = trees.agg(F.count("*").alias("trees"), F.max("size").alias("largest")).first()
    leaves = placed.join(trees, F.col("lang").eqNullSafe(F.col("_lang"))).select(
        "tree", "size", (F.col("place") - F.col("first")).alias("rank"), "digest", "doc_id", "found"
    )
    levels = grown(leaves, total["largest"] or 1)
    subroots = levels[-1].select(F.lit(0).cast("long").alias("tree"), F.lit(total["trees"]).alias("size"), F.col("tree").alias("rank"), "digest")
    crown = grown(subroots, total["trees"])
    top = crown[-1].first()
    root = top["digest"].hex() if top else None

    nothing = F.lit(b"")
    messages = spark.range(1 if top else 0).select(
        F.col("id").alias("tree"), F.lit(0).cast("long").alias("block"), nothing.alias("shape"), nothing.alias("siblings"), nothing.alias("subroot")
    )
    for level in reversed(crown[:-1]):
        messages = down(level, messages)
    messages = messages.drop("tree", "subroot").withColumnRenamed("block", "tree")
    messages = messages.join(levels[-1].select("tree", F.col("digest").alias("subroot")), "tree").withColumn("block", F.lit(0).cast("long"))
    for level in reversed(levels[1:-1]):
        messages = down(level, messages)

    def leaves_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, suffixes, subroot in _messages(batches):
            folded_roots = [fold(r[9] or r[4], *s) for r, s in zip(nodes, suffixes)]
            columns = [
                pa.array([r[8] for r in nodes], pa.int64()),
                [r[4].hex() for r in nodes],
                [subroot.hex()] * len(nodes),
                [root] * len(nodes),
                [hashlib.sha256(s[1].hex().encode()).hexdigest() for s in suffixes],
                folded_roots,
                [f == root for f in folded_roots],
            ]
            names = [f.strip().split(" ")[0] for f in SCHEMA.split(",")]
            if with_proof:
                steps = [[{"position": p, "siblings": o} for p, o in proof_steps(*s)] for s in suffixes]
                kind = pa.list_(pa.struct([("position", pa.int32()), ("siblings", pa.list_(pa.string()))]))
                columns.append(pa.array(steps, kind))
                names.append("proof")
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    schema = SCHEMA + (f", proof {PROOF}" if with_proof else "")
    return addressed(leaves, messages, ("doc_id", "found")).mapInArrow(leaves_out, schema)
