"""Chat formatting over a prefix tree of conversations.

A turn is written as ``<turn ROLE>`` newline, the text, newline ``</turn>`` newline. In roles
and texts every backslash, ``<``, ``>`` and ``#`` gets a backslash before it, so no text can
hold a mark, and taking the backslashes off gives it back.

Conversations that share their first turns share those tree nodes: a node stands for one
whole prefix of turns, named by a chained digest of role and text. Every node's tokens are
emitted once, in depth-first order of one global token stream:

* ``position_start``: position id of its first token, the tokens of its ancestors before it;
* ``start`` and ``subtree_end``: its place in the stream and where its subtree ends. A token
  may attend to a node's tokens exactly if it lies in ``[start, subtree_end)`` and not before
  them: these are the node itself and its descendants. One interval per node says for all
  of its ancestors and descendants what an attention mask needs.

Depth-first order needs no pass over the tree: conversations are ranked by their path of
digests; a node belongs to the first path through it, comes after that path's shallower
nodes, and its subtree ends with the last path through it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.ranks import ranked, running_sums
from gaugeworks.session import cut_lineage

LEARNED = "assistant"
CONTROL = regex.compile(r"[\\<>#]")
ESCAPED = regex.compile(r"\\(.)", regex.DOTALL)


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def head_of(role: str) -> str:
    return f"<turn {escape(role)}>\n"


TAIL = "\n</turn>\n"


@cache
def encoding(path: str):
    """Byte-level vocabulary of a rank file; every text is encoded without loss."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TURNS = (
    "conv_id bigint, depth bigint, node binary, parent binary, tokens binary, loss_start int, loss_end int, "
    "n_tokens bigint, position_start bigint, path array<binary>"
)


def _chained(path: str):
    """Rows sorted by conversation and turn; each becomes its tree node, the last one has the path."""
    fields = pa.schema(
        [
            ("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
            ("tokens", pa.binary()), ("loss_start", pa.int32()), ("loss_end", pa.int32()), ("n_tokens", pa.int64()),
            ("position_start", pa.int64()), ("path", pa.list_(pa.binary())),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        nothing = object()
        conv, chain, position, rows, size = nothing, [], 0, [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

        for part in batches:
            for conv_id, role, text in zip(*(part.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv_id != conv or conv is nothing:
                    if rows:
                        rows[-1][-1] = chain
                        if size > 1 << 20:
                            yield batch()
                            rows, size = [], 0
                    conv, chain, position = conv_id, [], 0
                elif size > 1 << 23:
                    held = rows.pop()  # the last row waits for the conversation's end
                    if rows:
                        yield batch()
                    rows, size = [held], 0
                parent = chain[-1] if chain else None
                said = text.encode()
                digest = hashlib.blake2b(parent or b"", digest_size=16)
                named = role.encode()
                digest.update(len(named).to_bytes(8, "little") + named + said)
                node = digest.digest()
                head, body, tail = encode(head_of(role)), encode(escape(text)), encode(TAIL)
                ids = np.array(head + body + tail, "<u2")
                learned = role == LEARNED
                rows.append(
                    [
                        conv_id, len(chain), node, parent, ids.tobytes(), len(head) if learned else None,
                        len(head) + len(body) if learned else None, len(ids), position, None,
                    ]
                )
                chain.append(node)
                position += len(ids)
                size += 2 * len(ids) + 100
        if rows:
            rows[-1][-1] = chain
            yield batch()

    return run


@dataclass(frozen=True)
class Formatted:
    """The token stream's nodes, and the nodes of every conversation in order."""

    nodes: DataFrame
    members: DataFrame


def ranks_path(given: str | None) -> str:
    import public_tokenizers

    return given or public_tokenizers.path("byte_bpe_50k.tiktoken")


def format_conversations(conversations: DataFrame, tokenizer_path: str | None = None) -> Formatted:
    """Merge all conversations into one prefix tree and emit it.

    ``nodes``: ``node, parent, depth, tokens`` (little-endian 16-bit ids), ``n_tokens,
    loss_start, loss_end`` (token range under the loss mask, null if none),
    ``position_start, start, subtree_end``. ``members``: ``conv_id, depth, node``.

    Turns are ordered by ``turn``, then role and text; null turn first. Null role and text
    count as empty. Rows without a conv_id are one conversation without an id. Repeated rows
    are turns of their own. Equal conversations share all nodes. Empty table: no rows.
    Further columns of any name are ignored.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = cut_lineage(
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(_chained(ranks_path(tokenizer_path)), TURNS)
    )
    paths = ranked(turns.filter("path is not null").select("path").distinct(), [F.col("path")], "rank")
    through = (
        paths.select("rank", F.explode("path").alias("node"))
        .groupBy("node")
        .agg(F.min("rank").alias("owner"), F.max("rank").alias("last"))
    )
    what = ("parent", "depth", "tokens", "n_tokens", "loss_start", "loss_end", "position_start")
    distinct = turns.groupBy("node").agg(F.first(F.struct(*what)).alias("_n")).select("node", *[F.col(f"_n.{c}").alias(c) for c in what])
    owned = cut_lineage(distinct.join(through, "node"))
    sums = owned.groupBy("owner").agg(F.sum("n_tokens").alias("own_tokens"))
    ends = cut_lineage(running_sums(sums, "owner", "own_tokens", "before"))
    shallower = Window.partitionBy("owner").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    first = ends.select("owner", F.col("before").alias("_begin"))
    # every path owns its leaf, so the last path through a node has a row of its own
    last = ends.select(F.col("owner").alias("last"), (F.col("before") + F.col("own_tokens")).alias("subtree_end"))
    nodes = (
        owned.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(shallower), F.lit(0)))
        .join(first, "owner")
        .withColumn("start", F.col("_begin") + F.col("_inside"))
        .join(last, "last")
        .select("node", "parent", "depth", "tokens", "n_tokens", "loss_start", "loss_end", "position_start", "start", "subtree_end")
    )
    return Formatted(cut_lineage(nodes), turns.select("conv_id", "depth", "node"))


def _digested(path: str):
    number, digest = pa.int64(), pa.string()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [number, number, digest, number, digest, number]

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    mark = regex.compile(r"<turn ((?:[^\\>]|\\.)*)>\n((?:[^\\<]|\\.)*)\n</turn>\n", regex.DOTALL)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoding(path).decode_bytes
        nothing = object()
        conv, out = nothing, []
        turns = loss = None
        n = learned = chars = 0

        def done() -> None:
            out.append((conv, n, turns.hexdigest(), learned, loss.hexdigest(), chars))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "tokens", "loss_start", "loss_end"))
            for conv_id, tokens, begin, end in zip(*columns):
                if conv_id != conv or conv is nothing:
                    if conv is not nothing:
                        done()
                    conv, n, learned, chars = conv_id, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                ids = np.frombuffer(tokens, "<u2").tolist()
                written = decode(ids).decode()
                role, text = mark.fullmatch(written).groups()
                turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                n, chars = n + 1, chars + len(written)
                if begin is not None:
                    under = unescape(decode(ids[begin:end]).decode())
                    loss.update(under.encode())
                    learned += len(under)
            if len(out) > 10_000:
                yield rows_of(out)
                out = []
        if conv is not nothing:
            done()
        if out:
            yield rows_of(out)

    return run


def read_back(formatted: Formatted, tokenizer_path: str | None = None) -> DataFrame:
    """Decode every conversation from the emitted nodes: turns, text under the loss mask, size."""
    return (
        formatted.members.join(formatted.nodes.select("node", "tokens", "loss_start", "loss_end"), "node")
        .select("conv_id", "depth", "tokens", "loss_start", "loss_end")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "depth")
        .mapInArrow(
            _digested(ranks_path(tokenizer_path)),
            "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
        )
    )
