"""Periodic runs of words, caught online over completed power-of-two blocks.

Words are appended to a stream. A completed block of ``m = 2 ** k`` words at a multiple of
``m`` sets up a catcher, which looks for its block again ``q`` words on, for every period
``m <= q < 2 * m``. Words appended later advance the comparison: where the windows of
``2 * q`` words at the block and ``q`` words on agree, a square of period ``q`` (indeed
three periods) has been caught; it joins a run of that period that is already known, or
is extended to a new run by comparing the words themselves. A run whose last word is the
last of the stream stays open and grows with what is appended.

A run of at least four periods of ``q`` words holds a block of its level within its first
period, followed by three periods of the run, so some catcher finds it. A catcher need not
look where its block and the copy lie within one run of a smaller period ``r < m``: by the
theorem of Fine and Wilf a run of period ``q`` there has a smaller one too. So a run of
thousands of equal words is caught once and not for every multiple of its period.

Window hashes only choose what is compared; every word of a run is compared exactly. The
work is a fixed number of vector operations a level, so n log n for n words. A catcher
of level k is done once ``8 * m`` words after its start have been appended.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import encoded, offsets_of, pieces, ragged, words_of

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words a stream takes in at once, and the catchers of a level that advance together.
STRETCH, CATCHERS = 1 << 16, 8
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


class SquareCatcher:
    """A stream of word codes (any int64); ``append`` stretches, then ``close``."""

    def __init__(self, capacity: int):
        self.codes = np.empty(capacity, np.int64)
        self.sums = np.zeros(capacity + 1, np.uint64)
        powers = np.full(capacity + 1, BASE)
        powers[0] = 1
        self.powers = np.cumprod(powers, dtype=np.uint64)
        powers[1:] = UNBASE
        self.inverse = np.cumprod(powers, dtype=np.uint64)
        self.size = 0
        self.levels: list[int] = []  # catchers done, by level
        self.runs: list[list[int]] = []  # start, end, period
        self.latest: dict[int, list[int]] = {}  # by period
        self.open: list[list[int]] = []

    def window(self, start: np.ndarray | slice, length: int | np.ndarray) -> np.ndarray:
        """Hashes of the windows of so many words at the starts."""
        if isinstance(start, slice):
            ahead = slice(start.start + length, start.stop + length)
            return (self.sums[ahead] - self.sums[start]) * self.inverse[start]
        return (self.sums[start + length] - self.sums[start]) * self.inverse[start]

    def append(self, codes: np.ndarray) -> None:
        begin, self.size = self.size, self.size + len(codes)
        self.codes[begin : self.size] = codes
        hashed = codes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        hashed ^= hashed >> np.uint64(32)
        hashed *= np.uint64(0xD6E8FEB86659FD93)
        hashed *= self.powers[begin : self.size]
        self.sums[begin + 1 : self.size + 1] = self.sums[begin] + np.cumsum(hashed, dtype=np.uint64)
        for run in self.open:
            run[1] = self.reach(run[1] - run[2], run[2]) + run[2]
        self.open = [run for run in self.open if run[1] == self.size]
        self.advance(final=False)

    def close(self) -> list[tuple[int, int, int]]:
        """``(start, end, period)`` of all runs, by start and period."""
        self.advance(final=True)
        return sorted((s, e, q) for s, e, q in self.runs if e - s >= max(LEAST_WORDS, LEAST_PERIODS * q))

    def reach(self, at: int, period: int) -> int:
        """First position from ``at`` on that differs from the one a period later."""
        step = 64
        while True:
            end = min(at + step, self.size - period)
            if end <= at:
                return at
            same = self.codes[at:end] == self.codes[at + period : end + period]
            if not same.all():
                return at + int(np.argmin(same))
            at, step = end, step * 2

    def back(self, at: int, period: int) -> int:
        """Least position from which on all up to ``at`` equal the one a period later."""
        step = 64
        while at:
            begin = max(0, at - step)
            same = self.codes[begin:at] == self.codes[begin + period : at + period]
            if not same.all():
                return at - int(np.argmin(same[::-1]))
            at, step = begin, step * 2
        return 0

    def advance(self, final: bool) -> None:
        """All levels in ascending order: a level needs the runs of smaller periods."""
        level = 0
        while (3 if final else 8) << level <= self.size:
            if level == len(self.levels):
                self.levels.append(0)
            width, first = 1 << level, self.levels[level]
            last = self.size // width if final else (self.size - 8 * width) // width + 1
            if last - first >= (1 if final else max(CATCHERS, STRETCH >> (level + 1))):
                self.catch(width, first, last)
                self.levels[level] = last
            level += 1

    def catch(self, width: int, first: int, last: int) -> None:
        """Catchers of the blocks ``first`` up to before ``last`` of one level."""
        low = first * width
        high = min(last * width + width, self.size - width + 1)  # starts of the copies
        if high <= low + width:
            return
        seen = self.window(slice(low, high), width)
        found = np.nonzero(seen[width:] == np.repeat(seen[: high - low - width : width], width)[: high - low - width])[0]
        if not len(found):
            return
        start = low + found // width * width
        period = found + (low + width) - start
        ahead = np.maximum(2 * period, LEAST_WORDS - 1)  # words that equal those a period on
        fits = start + period + ahead <= self.size
        start, period, ahead = start[fits], period[fits], ahead[fits]
        if not len(start):
            return
        known = [run for run in self.runs if run[2] < width and run[1] > low]
        if known:
            some = np.array(sorted(known), np.int64)
            furthest = np.maximum.accumulate(some[:, 1])
            at = np.searchsorted(some[:, 0], start, side="right") - 1
            covered = (at >= 0) & (furthest[at] >= start + width + period)
            start, period, ahead = start[~covered], period[~covered], ahead[~covered]
        alike = self.window(start, ahead) == self.window(start + period, ahead)
        start, period = start[alike], period[alike]
        order = np.lexsort((start, period))
        start, period = start[order], period[order]
        at = 0
        while at < len(start):
            q = int(period[at])
            run = self.merge(int(start[at]), q)
            # further squares of this run need no comparison
            furthest = np.searchsorted(start[: np.searchsorted(period, q, side="right")][at:], run[1] - q, side="right") if run else 0
            at += max(1, int(furthest))

    def merge(self, start: int, period: int) -> list[int] | None:
        """The run of a caught square, known or new; none if only hashes agreed."""
        run = self.latest.get(period)
        if run and start + period <= run[1]:
            return run
        end = self.reach(start, period) + period
        if end - start < 3 * period:
            return None
        run = self.latest[period] = [self.back(start, period), end, period]
        self.runs.append(run)
        if end == self.size:
            self.open.append(run)
        return run


def runs_of(codes: np.ndarray, stretch: int = STRETCH) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of all runs of one sequence of word codes."""
    catcher = SquareCatcher(len(codes))
    for at in range(0, len(codes), stretch):
        catcher.append(codes[at : at + stretch])
    return catcher.close()


SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(
    docs: DataFrame,
    source_of: Callable[[Sequence[int | None], np.ndarray], np.ndarray | None] | None = None,
    with_runs: bool = False,
) -> DataFrame:
    """Maximal periodic runs of the words of every text, and the text without repeats.

    A run is a stretch of words with smallest period ``q`` and at least 6 words and four
    periods that neither neighbouring word extends. One row per document: ``doc_id, n_runs``;
    ``start, length, period, exponent_milli`` of the run with the greatest length / period
    (ties: smallest start, then period; null without runs); digests of all runs and of the
    words that are left if each run keeps its first period only, joined by single spaces.
    With ``with_runs`` also ``runs`` and ``collapsed`` themselves.

    ``source_of(doc_ids, counts)`` may rearrange words beforehand: for all words of the
    given documents, one after another, it returns the number (within all of them) of the
    word to put there, or None to leave them.

    Null, empty and blank texts have no words: no runs, the digest of the empty text. Null
    and repeated doc_ids are rows like any other. Empty table: no rows. Texts are taken in
    pieces of a few MB; a longer text is one piece. Further columns are ignored.
    """
    schema = SCHEMA + (f", runs {RUN}, collapsed string" if with_runs else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            if batch.num_rows:
                yield judged(batch.column("doc_id"), batch.column("text"), source_of, with_runs)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def judged(doc_ids: pa.Array, texts: pa.Array, source_of, with_runs: bool) -> pa.RecordBatch:
    words, counts = words_of(texts)
    distinct, codes = encoded(words)
    if source_of is not None and (source := source_of(doc_ids.to_pylist(), counts)) is not None:
        words, codes = words.take(pa.array(source)), codes[source]
    docs = len(counts)
    # all texts are one stream, each closed by a code of its own, which no run can cross
    begin = offsets_of(counts)[:-1] + np.arange(docs)
    stream = np.empty(len(codes) + docs, np.int64)
    stream[begin + counts] = -1 - np.arange(docs)
    stream[ragged(begin, counts)] = codes
    found = np.array(runs_of(stream), np.int64).reshape(-1, 3)
    place, period = found[:, 0], found[:, 2]
    doc = np.searchsorted(begin, place, side="right") - 1
    start, length = place - begin[doc], found[:, 1] - place
    dropped = np.zeros(len(stream) + 1, np.int64)
    np.add.at(dropped, place + period, 1)
    np.add.at(dropped, found[:, 1], -1)
    kept = np.cumsum(dropped[:-1])[ragged(begin, counts)] == 0
    left = np.diff(np.concatenate(([0], np.cumsum(kept)))[offsets_of(counts)])
    lists = pa.ListArray.from_arrays(pa.array(offsets_of(left), pa.int32()), words.filter(pa.array(kept)).cast(pa.string()))
    collapsed = pc.binary_join(lists, " ")
    texts_of_runs = [""] * docs
    best: list[tuple | None] = [None] * docs
    lines: dict[int, list[str]] = {}
    for d, s, n, q in zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist()):
        lines.setdefault(d, []).append(f"{s},{n},{q}\n")
        if best[d] is None or n * best[d][2] > best[d][1] * q:  # runs come by start and period
            best[d] = (s, n, q)
    for d, some in lines.items():
        texts_of_runs[d] = "".join(some)
    number = np.bincount(doc, minlength=docs)
    nothing = (None, None, None)
    columns = [
        doc_ids,
        pa.array(number, pa.int64()),
        *[pa.array([(b or nothing)[k] for b in best], pa.int64()) for k in range(3)],
        pa.array([None if b is None else 1000 * b[1] // b[2] for b in best], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts_of_runs]),
        pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in collapsed]),
    ]
    names = [f.strip().split(" ")[0] for f in SCHEMA.split(",")]
    if with_runs:
        inner = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], ["start", "length", "period"])
        columns += [pa.ListArray.from_arrays(pa.array(offsets_of(number), pa.int32()), inner), collapsed]
        names += ["runs", "collapsed"]
    return pa.RecordBatch.from_arrays(columns, names)


def planted_tails(doc_ids: Sequence[int | None], counts: np.ndarray) -> np.ndarray:
    """Gives each tenth document (by the CRC-32 of its decimal id) a periodic tail.

    With h the checksum and g = h // 10, words from a = g % n on repeat the p words at a,
    p = 1 + (n - a) // (3 + g % 8). Documents without id or words stay.
    """
    source = np.arange(int(counts.sum()))
    for doc_id, begin, n in zip(doc_ids, offsets_of(counts)[:-1].tolist(), counts.tolist()):
        if doc_id is None or not n:
            continue
        g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
        if rest == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[begin + a : begin + n] = begin + a + np.arange(n - a) % p
    return source
