"""SimHash near-dedup with Golay-code fuzzy hashing.

A fingerprint's 64 bits are three segments of 22, 21 and 21 bits, each read as a word of
the perfect (23, 12) Golay code with zeros added. A segment's keys are the indices of the
codewords that it and its one-bit neighbours decode to: at most six, and two segments
that differ in up to two bits share one. Of at most three differing bits

* either some segment is intact: then it, together with the Golay keys of the segment
  after it, is a key of both (of two segments with errors none has over two; if only one
  has errors, one of the intact ones is followed by the other), or
* every segment differs in exactly one bit: then one half of each segment is intact, and
  one of the eight choices of halves is a key of both.

Equal fingerprints are merged before any of this. Fingerprints that share a key are
compared exactly inside its bucket by a breadth-first search over the not yet reached
ones, so a bucket of n close fingerprints gives at most n - 1 links and no list of pairs.
Each task joins its links and passes on a spanning forest; components follow by
alternating star steps.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import offsets_of, pieces, words_of
from gaugeworks.llm.components import connected
from gaugeworks.llm.skew import dealt_anew
from gaugeworks.session import cut_lineage

GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
LENGTH, DATA = 23, 12
SEGMENTS = ((0, 22), (22, 21), (43, 21))
REACH = 3


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, DATA - 2, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - (LENGTH - DATA))
    return word


@cache
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 bits and of the high 11, and the error of every remainder."""
    single = [_remainder(1 << b) for b in range(LENGTH)]
    low, high = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
    for b in range(12):
        low[1 << b : 2 << b] = low[: 1 << b] ^ single[b]
    for b in range(11):
        high[1 << b : 2 << b] = high[: 1 << b] ^ single[12 + b]
    error = np.zeros(1 << 11, np.int64)
    for a in range(LENGTH):
        error[single[a]] = 1 << a
        for b in range(a):
            error[single[a] ^ single[b]] = 1 << a | 1 << b
            for c in range(b):
                error[single[a] ^ single[b] ^ single[c]] = 1 << a | 1 << b | 1 << c
    return low, high, error


def golay_index(words: np.ndarray) -> np.ndarray:
    """Index (the 12 data bits) of the one codeword within three bits of each word."""
    low, high, error = golay_tables()
    return (words ^ error[low[words & 0xFFF] ^ high[words >> 12]]) >> (LENGTH - DATA)


def golay_keys(segment: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices near each segment, (n, width + 1), and which are first of their kind."""
    flips = np.concatenate([[0], 1 << np.arange(width, dtype=np.int64)])
    found = np.sort(golay_index(segment[:, None] ^ flips), axis=1)
    fresh = np.ones(found.shape, bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    return found, fresh


def bucket_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of uint64 fingerprints and the row each belongs to; the family is in the top bits."""
    segments = [((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    keys, rows = [], []
    for i, segment in enumerate(segments):
        after = (i + 1) % 3
        found, fresh = golay_keys(segments[after], SEGMENTS[after][1])
        row, column = np.nonzero(fresh)
        keys.append(i << 48 | segment[row] << 12 | found[row, column])
        rows.append(row)
    halves = [(s & 0x3FF, s >> 10) for s in segments]
    every = np.arange(len(prints))
    for choice in range(8):
        a, b, c = (halves[k][choice >> k & 1] for k in range(3))
        keys.append((3 + choice) << 48 | a << 24 | b << 12 | c)
        rows.append(every)
    return np.concatenate(keys), np.concatenate(rows)


def links(prints: np.ndarray, reach: int = REACH, block: int = 1 << 20) -> list[tuple[int, int]]:
    """Spanning forest (index pairs) of distinct fingerprints under the Hamming bound."""
    out, left = [], np.arange(1, len(prints))
    frontier = np.zeros(1, np.int64)
    while len(left):
        grown = []
        step = max(1, block // len(left))
        for at in range(0, len(frontier), step):
            some = frontier[at : at + step]
            near = np.bitwise_count(prints[some][:, None] ^ prints[left]) <= reach
            hit = near.any(axis=0)
            if hit.any():
                reached = left[hit]
                out += zip(some[near[:, hit].argmax(axis=0)].tolist(), reached.tolist())
                grown.append(reached)
                left = left[~hit]
            if not len(left):
                break
        if grown:
            frontier = np.concatenate(grown)
        else:
            frontier, left = left[:1], left[1:]
    return out


def few_links(prints: list[int], reach: int = REACH) -> list[tuple[int, int]]:
    """As ``links``, without arrays, for a handful."""
    return [
        (i, j)
        for j in range(1, len(prints))
        for i in range(j)
        if (prints[i] ^ prints[j]).bit_count() <= reach
    ]


def fingerprints(texts: pa.Array, seed: int = 42, span: int = 3) -> np.ndarray:
    """SimHash of each text as uint64."""
    words, counts = words_of(pc.ascii_lower(pc.fill_null(texts, "")))
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes + 1) - 1  # in the words joined by one space
    starts = ends - sizes
    line = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string()))
    data = memoryview(pc.binary_join(line, " ")[0].as_buffer())
    first = offsets_of(counts)[:-1]
    n = np.where(counts >= span, counts - span + 1, np.minimum(counts, 1))
    at = np.repeat(first - offsets_of(n)[:-1], n) + np.arange(int(n.sum()))
    upto = at + np.repeat(np.minimum(counts, span) - 1, n)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(data[a:b], seed) for a, b in zip(starts[at].tolist(), ends[upto].tolist())), np.uint64, len(at)
    )
    out = np.zeros(len(counts), np.uint64)
    full = np.nonzero(n)[0]
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, offsets_of(n[full])[:-1], axis=0, dtype=np.int32)
        set_ = 2 * ones > n[full][:, None]
        out[full] = np.packbits(set_, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _print_rows(with_text: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            text = batch.column("text")
            prints = pa.array(fingerprints(text).view(np.int64))
            kept = [text] if with_text else []
            yield pa.RecordBatch.from_arrays([batch.column("_row"), prints, *kept], ["_row", "print", "text"][: 2 + with_text])

    return run


def _key_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            prints = batch.column(0).slice(at, 4096).to_numpy().view(np.uint64)
            keys, rows = bucket_keys(prints)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[rows].view(np.int64))], ["key", "print"])


class Forest:
    """Union-find over the fingerprints linked in one task; the least one is the root."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, node: int) -> int:
        path = []
        while (up := self.above.get(node, node)) != node:
            path.append(node)
            node = up
        for p in path:
            self.above[p] = node
        return node

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            low, high = min(a, b), max(a, b)
            self.above[high] = low

    def edges(self) -> tuple[list[int], list[int]]:
        nodes = list(self.above)
        return nodes, [self.root(n) for n in nodes]


def _bucket_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key; a bucket may go on in the next batch."""
    forest = Forest()

    def of(prints: np.ndarray) -> None:
        if len(prints) <= 12:
            whole = prints.tolist()
            signed = prints.view(np.int64).tolist()
            for i, j in few_links(whole):
                forest.join(signed[i], signed[j])
        else:
            signed = prints.view(np.int64)
            for i, j in links(prints):
                forest.join(int(signed[i]), int(signed[j]))

    rest_keys, rest = np.zeros(0, np.int64), []
    for batch in batches:
        keys = batch.column("key").to_numpy()
        prints = batch.column("print").to_numpy().view(np.uint64)
        if not len(keys):
            continue
        cuts = np.nonzero(np.diff(keys))[0] + 1
        bounds = np.concatenate([[0], cuts, [len(keys)]])
        sizes = np.diff(bounds)
        head = 0
        if rest and keys[0] == rest_keys[0]:
            rest.append(prints[: bounds[1]])
            head = 1
        if rest and (head == 0 or len(sizes) > 1):
            if sum(map(len, rest)) > 1:
                of(np.concatenate(rest))
            rest = []
        last = len(sizes) - 1
        for g in head + np.nonzero(sizes[head:last] > 1)[0]:
            of(prints[bounds[g] : bounds[g + 1]])
        if last >= head:
            rest_keys, rest = keys[-1:].copy(), [prints[bounds[last] :].copy()]
    if rest and sum(map(len, rest)) > 1:
        of(np.concatenate(rest))
    nodes, roots = forest.edges()
    for at in range(0, len(nodes), 10_000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[at : at + 10_000], pa.int64()), pa.array(roots[at : at + 10_000], pa.int64())], ["u", "v"]
        )


def near_groups(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Components of documents whose fingerprints differ in at most three bits.

    Words of the text with A-Z lower-cased, hashed as 3-word shingles with repeats (a text
    of one or two words is one shingle). Returns one row per document: ``doc_id,
    fingerprint`` (16 hex digits), ``component_id`` (the smallest doc_id reachable), ``kept``
    (one row of each component, of that doc_id) and the columns named in ``carry``.

    Null or empty text has fingerprint zero and links like any other. Null doc_ids are never
    the smallest unless all of a component are. Repeated rows are rows of one component.
    Empty table: no rows. Further columns of any name are ignored unless carried.
    """
    carried = [c for c in carry if c not in ("doc_id", "text")]
    with_text = "text" in carry
    row = F.struct("doc_id", *carried)
    schema = f"_row {docs.select(row.alias('r')).schema['r'].dataType.simpleString()}, print bigint" + ", text string" * with_text
    prints = cut_lineage(
        docs.select(row.alias("_row"), "text")
        .mapInArrow(_print_rows(with_text), schema)
        .withColumn("_uid", F.monotonically_increasing_id())
    )
    order = F.struct(F.col("_row.doc_id").isNull().alias("none"), F.col("_row.doc_id").alias("doc_id"), F.col("_uid").alias("uid"))
    distinct = cut_lineage(prints.groupBy("print").agg(F.min(order).alias("_least")))
    keys = distinct.select("print").mapInArrow(_key_rows, "key bigint, print bigint")
    edges = (
        keys.repartition("key").sortWithinPartitions("key").mapInArrow(_bucket_links, "u bigint, v bigint")
    )
    roots = connected(edges)
    labelled = distinct.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "_least", F.coalesce("root", "print").alias("root")
    )
    least = labelled.groupBy("root").agg(F.min("_least").alias("_least"))
    label = labelled.select("print", "root").join(least.select(dealt_anew("root"), "_least"), "root").select(F.col("print").alias("_print"), "_least")
    return prints.join(label, F.col("print") == F.col("_print"), "left").select(
        F.col("_row.doc_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("_least.doc_id").alias("component_id"),
        (F.col("_uid") == F.col("_least.uid")).alias("kept"),
        *[F.col("text") if c == "text" else F.col(f"_row.{c}").alias(c) for c in carry if c != "doc_id"],
    )
