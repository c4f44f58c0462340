"""Order-preserving packing by dynamic programming.

Documents are range-sorted by id; each partition runs over its documents' tokens in order
and chooses where one sequence ends and the next begins. Cuts may fall at document ends
(free), sentence ends (a penalty) or, inside very long sentences, at a grid of positions
(a larger penalty). The cost of a sequence is its padding, which is nothing when its
length is a power of two, plus the penalty of its last cut. The best cut before position p
minimises cost + position over a sliding window of one sequence length, so a monotone
queue gives each transition in constant time; power-of-two lengths are single look-ups.

A partition works on a bounded stretch of tokens at a time and carries the last, still
open sequence into the next stretch. Pieces of a document stay in order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import encoded, offsets_of, pieces, ragged, words_of
from gaugeworks.llm.text import filled
from gaugeworks.llm.wordpiece import vocabulary

SENTENCE_END = r"[.!?]$"


@dataclass(frozen=True)
class PackRules:
    """Sequence size and what a cut costs, in tokens of padding."""

    size: int = 2048
    least_power: int = 256
    sentence_cut: float = 2.0
    hard_cut: float = 32.0
    hard_grid: int = 64
    longest_sentence: int = 256


def best_cuts(positions: list[int], penalties: list[float], rules: PackRules) -> list[int]:
    """Indices of the cuts of the cheapest division of positions[0] .. positions[-1].

    Neighbouring positions must lie at most ``rules.size`` apart.
    """
    count, size = len(positions), rules.size
    where = np.array(positions, np.int64)
    jumps: dict[int, list[int]] = {}
    power = rules.least_power
    while power < size:
        at = np.searchsorted(where, where - power)
        for j in np.nonzero((where >= where[0] + power) & (where[at] == where - power))[0].tolist():
            jumps.setdefault(j, []).append(int(at[j]))
        power *= 2
    cost, back, value = [0.0] * count, [0] * count, [0.0] * count
    value[0] = float(positions[0])
    queue, head = [0], 0
    for j in range(1, count):
        p = positions[j]
        while positions[queue[head]] < p - size:
            head += 1
        i = queue[head]
        c = value[i] - p + size
        if j in jumps:
            for k in jumps[j]:
                if cost[k] < c:
                    c, i = cost[k], k
        c += penalties[j]
        cost[j], back[j] = c, i
        v = value[j] = c + p
        while len(queue) > head and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    cuts, j = [], count - 1
    while j:
        cuts.append(j)
        j = back[j]
    cuts.append(0)
    return cuts[::-1]


def candidates(ends: np.ndarray, sentence: np.ndarray, total: int, rules: PackRules) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a sequence may end, 0 and total among them, and their penalties."""
    places = np.unique(np.concatenate([[0], ends, sentence, [total]]))
    wide = np.nonzero(np.diff(places) > rules.longest_sentence)[0]
    if len(wide):
        counts = (places[wide + 1] - places[wide] - 1) // rules.hard_grid
        steps = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + 1
        places = np.union1d(places, np.repeat(places[wide], counts) + steps * rules.hard_grid)
    penalty = np.full(len(places), rules.hard_cut)
    penalty[np.isin(places, sentence)] = rules.sentence_cut
    penalty[np.isin(places, ends)] = 0.0
    return places, penalty


class Packer:
    """Token stretch of one partition: documents come in, finished pieces go out."""

    def __init__(self, rules: PackRules, first_sequence: int):
        self.rules, self.sequence = rules, first_sequence
        self.ids = np.zeros(0, np.uint32)
        self.sentence = np.zeros(0, np.int64)
        self.doc_ids: list = []
        self.begin = np.zeros(0, np.int64)  # of each document here; below 0 if it began earlier
        self.end = np.zeros(0, np.int64)

    def add(self, doc_ids: list, ids: np.ndarray, sizes: np.ndarray, sentence: np.ndarray) -> None:
        at = len(self.ids)
        ends = at + np.cumsum(sizes)
        self.ids = np.concatenate([self.ids, ids])
        self.sentence = np.concatenate([self.sentence, at + sentence])
        self.doc_ids += doc_ids
        self.begin = np.concatenate([self.begin, ends - sizes])
        self.end = np.concatenate([self.end, ends])

    def take(self, last: bool) -> dict | None:
        """Pieces of all finished sequences; the open one stays unless this is the end."""
        total = len(self.ids)
        if not total:
            return None
        places, penalty = candidates(self.end, self.sentence, total, self.rules)
        cuts = places[best_cuts(places.tolist(), penalty.tolist(), self.rules)]
        if not last:
            cuts = cuts[:-1]
        upto = int(cuts[-1])
        bounds = np.union1d(cuts, self.end[self.end < upto])
        start, stop = bounds[:-1], bounds[1:]
        doc = np.searchsorted(self.end, start, side="right")
        window = np.searchsorted(cuts, start, side="right") - 1
        view = memoryview(np.ascontiguousarray(self.ids).astype("<u4", copy=False)).cast("B")
        out = {
            "doc_id": [self.doc_ids[d] for d in doc.tolist()],
            "start": start - self.begin[doc],
            "length": stop - start,
            "ids_crc32": [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(start.tolist(), stop.tolist())],
            "doc_tokens": self.end[doc] - self.begin[doc],
            "sequence_id": self.sequence + window,
            "offset": start - cuts[window],
            "ids": (start, stop, self.ids),
        }
        self.sequence += len(cuts) - 1
        done = int(np.searchsorted(self.end, upto, side="right"))
        self.doc_ids, self.begin, self.end = self.doc_ids[done:], self.begin[done:] - upto, self.end[done:] - upto
        self.sentence = self.sentence[self.sentence > upto] - upto
        self.ids = self.ids[upto:].copy()
        return out if len(start) else None


def tokenised(batch: pa.RecordBatch, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, each closed by end_id; sizes; and positions after sentences."""
    words, counts = words_of(batch.column("text"))
    distinct, place = encoded(words)
    vocab = vocabulary(path, (end_id,))
    known = vocab.places_of(distinct.to_pylist())
    stops = pc.match_substring_regex(distinct, SENTENCE_END).to_numpy(zero_copy_only=False) if len(distinct) else np.zeros(0, bool)
    text_ends = np.cumsum(counts)
    # place 0 of the vocabulary is the end id, put after every document's last word
    chunks = np.insert(known[place] if len(place) else place, text_ends, 0)
    stop = np.insert(stops[place] if len(place) else np.zeros(0, bool), text_ends, False)
    lengths = vocab.lengths[chunks]
    ids = vocab.ids[ragged(vocab.starts[chunks], lengths)]
    ends = np.cumsum(lengths)
    at = ends[text_ends + np.arange(len(counts))]
    return ids, np.diff(np.concatenate([[0], at])), ends[stop]


SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    end_id: int = 1,
    rules: PackRules = PackRules(),
    with_ids: bool = False,
) -> DataFrame:
    """Pack whole documents into sequences of at most ``rules.size`` tokens.

    A document is the ids of its text and ``end_id``. Returns one row per piece:
    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, with
    ``with_ids``, the piece's ``ids``. Sequences hold consecutive documents in doc_id order;
    sequence ids grow with it and may skip numbers.

    Null or empty text is a document of the end id alone. Null doc_ids come first; rows that
    repeat a doc_id are documents of their own, ordered by a hash of their text. Empty
    table: no rows. Further columns of any name are ignored.
    """
    import public_tokenizers

    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    fields = [(f.strip().split(" ")[0], pa.int64()) for f in SCHEMA.split(",")]
    arrow = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(rules, TaskContext.get().partitionId() << 33)

        def batch_of(found: dict) -> pa.RecordBatch:
            start, stop, ids = found.pop("ids")
            if with_ids:
                values = ids[ragged(start, stop - start)].astype(np.int32)
                found["ids"] = pa.ListArray.from_arrays(offsets_of(stop - start).astype(np.int32), values)
            return pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, arrow.field(n).type) for n, c in found.items()], schema=arrow
            )

        for batch in pieces(batches, "text"):
            packer.add(batch.column("doc_id").to_pylist(), *tokenised(batch, path, end_id))
            if found := packer.take(last=False):
                yield batch_of(found)
        if found := packer.take(last=True):
            yield batch_of(found)

    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), filled(F.col("text")).alias("text"))
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)
