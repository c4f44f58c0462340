"""Substring dedup by super-k-mer partitioning.

A window is 20 consecutive words. Each window belongs to the least-ranked run of 3 words
inside it, its minimiser; consecutive windows of a document that share a minimiser form a
super-k-mer and travel as one packed string to the minimiser's bucket, where sorting the
windows of all its strings counts them exactly.

Runs of words that are frequent in the corpus rank last, so they are minimisers only of
windows that hold nothing else, and a common phrase does not fill one bucket. Which runs
are frequent comes from one pass over all documents that counts them in a table of fixed
size. Equal super-k-mers are merged where they are found, before they travel: a passage
that a third of all documents hold arrives once per flush of a task, and its other
occurrences are already known to be repeats.

A bucket is sized in bytes, so their number grows with the corpus and a task's memory
does not; a task takes one bucket at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import encoded, offsets_of, pieces, ragged, words_of
from gaugeworks.llm.skew import dealt_anew
from gaugeworks.session import cut_lineage

MER = 3
SLOTS = 1 << 22
FREQUENT = 1e-6
FLUSH_BYTES = 32 << 20
BUCKET_BYTES = 10 << 20
#: Buckets a task works through, one at a time.
TASK_BUCKETS = 8
#: A word travels in about three super-k-mers.
TRAVEL_BYTES = 20
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
NO_ID = -(1 << 63)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * ODD[0]
    return h ^ (h >> np.uint64(29))


def word_hashes(words: pa.Array) -> np.ndarray:
    distinct, place = encoded(words)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w) for w in distinct.cast(pa.large_binary()).to_pylist()), np.uint64, len(distinct))
    return hashes[place]


def mer_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hash of the MER words from each place on."""
    n = max(0, len(hashes) - MER + 1)
    return mixed(sum(hashes[k : k + n] * ODD[k] for k in range(MER))) if n else np.zeros(0, np.uint64)


def slots_of(mers: np.ndarray) -> np.ndarray:
    return (mers & np.uint64(SLOTS - 1)).astype(np.int64)


def _slot_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs counted by slot; slots with a small share of this task's runs are left out.

    A slot whose share of all runs is at least FREQUENT has that share in some task.
    """
    counts, words = np.zeros(SLOTS, np.int64), 0
    for batch in pieces(batches, "text"):
        found, _ = words_of(batch.column("text"))
        mers = mer_hashes(word_hashes(found))
        counts += np.bincount(slots_of(mers), minlength=SLOTS)
        words += len(found)
    slots = np.nonzero(counts >= max(2.0, FREQUENT * counts.sum()))[0]
    for at in range(0, len(slots), 10_000):
        some = slots[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["slot", "n"])
    yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([words], pa.int64())], ["slot", "n"])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    if len(values) < width:
        return values[:0]
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[: len(values) - step], values[step:])
        done += step
    return values


def window_hashes(codes: np.ndarray, span: int) -> np.ndarray:
    """Polynomial hash of ``span`` codes from each place on, by doubling."""
    parts, size = {1: codes}, 1
    base = {1: int(ODD[1])}
    while 2 * size <= span:
        power = np.uint64(base[size])
        half = parts[size]
        parts[2 * size] = half[: len(half) - size] * power + half[size:]
        base[2 * size] = base[size] * base[size] % (1 << 64)
        size *= 2
    out, covered = parts[size], size
    while covered < span:
        size = 1 << ((span - covered).bit_length() - 1)
        n = len(codes) - covered - size + 1
        out = out[:n] * np.uint64(base[size]) + parts[size][covered : covered + n]
        covered += size
    return out


def pack_rows(columns: list[np.ndarray], text: bytes, press: zstandard.ZstdCompressor) -> bytes:
    """Number columns byte by byte place, then the texts, compressed as one string."""
    n = len(columns[0])
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(n, -1).T).tobytes() for c in columns]
    return press.compress(b"".join([n.to_bytes(8, "little"), *planes, text]))


def unpack_rows(payload: bytes, kinds: list, loose: zstandard.ZstdDecompressor) -> tuple[list[np.ndarray], bytes]:
    data = loose.decompress(payload)
    n, at, columns = int.from_bytes(data[:8], "little"), 8, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        plane = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        columns.append(np.ascontiguousarray(plane.T).view(kind).ravel())
        at += n * width
    return columns, data[at:]


#: doc key, tie, first window, words (or windows, for finished runs), bytes of text
KINDS = [np.int64, np.int64, np.int64, np.int64, np.int64]


class Sender:
    """Super-k-mers of a stretch of documents, merged and packed by bucket."""

    def __init__(self, span: int, buckets: int, frequent: np.ndarray):
        self.span, self.buckets, self.frequent = span, buckets, frequent
        self.press = zstandard.ZstdCompressor(level=3)
        self.clear()

    def clear(self) -> None:
        self.kept: dict[bytes, tuple[int, int, int, int, int]] = {}
        self.repeats: list[tuple[int, int, int, int]] = []
        self.size = 0

    def add(self, keys: np.ndarray, ties: np.ndarray, texts: pa.Array) -> None:
        words, counts = words_of(texts)
        if not len(words):
            return
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        line = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string()))
        data = pc.binary_join(line, " ")[0].as_buffer().to_pybytes()
        mers = mer_hashes(word_hashes(words))
        rank = (mers >> np.uint64(1)) | (self.frequent[slots_of(mers)].astype(np.uint64) << np.uint64(63))
        least = sliding_least(rank, self.span - MER + 1)
        doc = np.repeat(np.arange(len(counts)), counts)
        first = offsets_of(counts)[:-1]
        ok = doc[: len(least)] == doc[self.span - 1 : self.span - 1 + len(least)] if len(least) else np.zeros(0, bool)
        window = np.nonzero(ok)[0]
        if not len(window):
            return
        new = np.ones(len(window), bool)
        new[1:] = (np.diff(window) != 1) | (least[window[1:]] != least[window[:-1]]) | (doc[window[1:]] != doc[window[:-1]])
        at = np.nonzero(new)[0]
        number = np.diff(np.append(at, len(window)))
        begin = window[at]
        d = doc[begin]
        bucket = (mixed(least[begin]) % np.uint64(self.buckets)).astype(np.int64)
        last = begin + number + self.span - 2
        kept, repeats = self.kept, self.repeats
        for a, b, bucket_, key, tie, start, n in zip(
            starts[begin].tolist(), ends[last].tolist(), bucket.tolist(), keys[d].tolist(), ties[d].tolist(),
            (begin - first[d]).tolist(), number.tolist(),
        ):
            text = data[a:b]
            held = kept.get(text)
            if held is None:
                kept[text] = (key, tie, start, n, bucket_)
                self.size += b - a
            elif (key, tie, start) < held[:3]:
                kept[text] = (key, tie, start, n, bucket_)
                repeats.append(held[:4])
            elif (key, tie, start) > held[:3]:
                repeats.append((key, tie, start, n))

    def flush(self) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, bytes]] = []
        if self.kept:
            values = np.array(list(self.kept.values()), np.int64)
            sizes = np.fromiter(map(len, self.kept), np.int64, len(self.kept))
            texts, order = list(self.kept), np.argsort(values[:, 4], kind="stable")
            bounds = np.nonzero(np.diff(values[order, 4], prepend=-1, append=-1))[0]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                some = order[a:b]
                v = values[some]
                columns = [np.diff(v[:, 0], prepend=0), v[:, 1].copy(), v[:, 2].copy(), v[:, 3] + self.span - 1, sizes[some]]
                rows.append((int(v[0, 4]), pack_rows(columns, b"".join([texts[i] for i in some.tolist()]), self.press)))
        if self.repeats:
            v = np.array(self.repeats, np.int64)
            mix = mixed(v[:, 0].astype(np.uint64) ^ mixed(v[:, 1].astype(np.uint64)))
            home = self.buckets + (mix % np.uint64(self.buckets)).astype(np.int64)
            order = np.argsort(home, kind="stable")
            bounds = np.nonzero(np.diff(home[order], prepend=-1, append=-1))[0]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                w = v[order[a:b]]
                columns = [np.diff(w[:, 0], prepend=0), w[:, 1].copy(), w[:, 2].copy(), w[:, 3].copy(), np.zeros(len(w), np.int64)]
                rows.append((int(home[order[a]]), pack_rows(columns, b"", self.press)))
        self.clear()
        for at in range(0, len(rows), 256):
            some = rows[at : at + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in some], pa.int64()), pa.array([r[1] for r in some], pa.binary())], ["bucket", "payload"]
            )


def repeats_in(bucket: list[bytes], span: int) -> list[np.ndarray]:
    """Runs (key, tie, start, windows) of windows that also occur earlier, for one bucket."""
    loose = zstandard.ZstdDecompressor()
    columns, texts = [], []
    for payload in bucket:
        cols, text = unpack_rows(payload, KINDS, loose)
        cols[0] = np.cumsum(cols[0])
        columns.append(cols)
        texts.append(text)
    key, tie, start, n, size = (np.concatenate([c[k] for c in columns]) for k in range(5))
    text = pa.py_buffer(b"".join(texts))
    rows = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets_of(size)), text)
    order = np.lexsort((start, tie, key))
    del columns, texts
    words, counts = words_of(rows.take(pa.array(order)))
    del rows, text
    key, tie, start, n = key[order], tie[order], start[order], n[order]
    codes = encoded(words)[1]
    del words
    windows = n - span + 1
    at = ragged(offsets_of(counts)[:-1], windows)  # places of the windows' first words
    hashes = window_hashes(mixed(codes.astype(np.uint64) + np.uint64(1)), span)[at]
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return [key[:0], tie[:0], start[:0], n[:0]]
    spot = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
    some = np.nonzero(twice[spot] == hashes)[0]
    some = some[np.argsort(hashes[some], kind="stable")]
    new = np.ones(len(some), bool)
    new[1:] = hashes[some[1:]] != hashes[some[:-1]]
    lead = some[np.maximum.accumulate(np.where(new, np.arange(len(some)), 0))]
    same = np.ones(len(some), bool)
    for k in range(span):
        same &= codes[at[some] + k] == codes[at[lead] + k]
    if not same.all():  # a hash shared by different windows: compare these words by words
        seen: dict = {}
        bad = np.isin(hashes[some], hashes[some[~same]])
        for i in np.nonzero(bad)[0].tolist():
            w = some[i]
            lead[i] = seen.setdefault(tuple(codes[at[w] : at[w] + span].tolist()), w)
    row = np.repeat(np.arange(len(n)), windows)
    place = np.arange(len(at)) - np.repeat(offsets_of(windows)[:-1], windows) + start[row]
    a, b = row[some], row[lead]
    later = (key[a] != key[b]) | (tie[a] != tie[b]) | (place[some] != place[lead])
    hit = np.sort(some[later])
    new = np.ones(len(hit), bool)
    new[1:] = (np.diff(hit) != 1) | (row[hit[1:]] != row[hit[:-1]])
    first = np.nonzero(new)[0]
    length = np.diff(np.append(first, len(hit)))
    r = row[hit[first]]
    return [key[r], tie[r], place[hit[first]], length]


def _runs(span: int, buckets: int):
    """Rows sorted by bucket in; runs of repeated windows out, a bucket at a time."""

    def solve(bucket: int, payloads: list[bytes]) -> pa.RecordBatch:
        if bucket < buckets:
            columns = repeats_in(payloads, span)
        else:  # found before they travelled
            loose = zstandard.ZstdDecompressor()
            parts = [unpack_rows(p, KINDS, loose)[0] for p in payloads]
            columns = [np.concatenate([np.cumsum(p[0]) for p in parts])]
            columns += [np.concatenate([p[k] for p in parts]) for k in (1, 2, 3)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "tie", "start", "windows"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload")):
                if bucket != now and held:
                    yield solve(now, held)
                    held = []
                now = bucket
                held.append(payload.as_py())
        if held:
            yield solve(now, held)

    return run


def _removed(span: int, with_text: bool):
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words, counts = words_of(batch.column("text"))
            first = offsets_of(counts)
            runs = batch.column("runs")
            marks = np.zeros(len(words) + 1, np.int64)
            if len(runs.flatten()):
                flat = runs.flatten()
                doc = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False))
                begin = first[doc] + flat.field("start").to_numpy()
                np.add.at(marks, begin, 1)
                np.add.at(marks, begin + flat.field("windows").to_numpy() + span - 1, -1)
            stays = np.cumsum(marks[:-1]) == 0
            kept = np.diff(np.concatenate([[0], np.cumsum(stays)])[first])
            lists = pa.ListArray.from_arrays(pa.array(offsets_of(kept), pa.int32()), words.filter(pa.array(stays)).cast(pa.string()))
            texts = pc.binary_join(lists, " ")
            digests = [hashlib.sha256(t.as_buffer()).hexdigest() for t in texts]
            columns = [batch.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array((counts - kept).astype(np.int64)), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [texts] * with_text, names)

    return run


def tie_of(rows: DataFrame, hashed: Callable[[int], Column] = lambda salt: F.xxhash64("text", F.lit(salt))) -> Column:
    """What tells rows ``(key, text)`` of one key apart: nothing if no key repeats, else a hash.

    A hash under which two different texts of one key collide is replaced by another one.
    """
    if rows.groupBy("key").count().filter("count > 1").isEmpty():
        return F.lit(0).cast("long")
    salt = 0
    while True:
        groups = rows.select("key", "text", hashed(salt).alias("tie")).groupBy("key", "tie")
        if groups.agg(F.min("text").alias("a"), F.max("text").alias("b")).filter("a != b").isEmpty():
            return hashed(salt).cast("long")
        salt += 1


def remove_repeats(docs: DataFrame, span: int = 20, with_text: bool = False, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Remove every word covered by a window of ``span`` words that also starts earlier.

    Earlier is a smaller doc_id, or an earlier start in the same document; windows are
    judged on the input. Returns one row per document: ``doc_id, n_words, n_removed,
    kept_sha256`` (of the kept words joined by one space) and, with ``with_text``,
    ``kept_text``.

    Null or empty text has no words. A null doc_id is smaller than any other. Rows that
    share a doc_id are ordered by a hash of their text; rows that share doc_id and text are
    one document given several times, and all of them get its result. Empty table: no rows.
    Further columns of any name are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tie", tie_of(rows))
    tally = cut_lineage(
        rows.select("text").mapInArrow(_slot_counts, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    )
    total = tally.filter("slot < 0").first()
    total = total["n"] if total else 0
    # at most 1 / (4 * FREQUENT) slots can have that share
    common = tally.filter((F.col("slot") >= 0) & (F.col("n") >= 4 * FREQUENT * total)).select("slot").collect()
    table = np.zeros(SLOTS, bool)
    table[[r["slot"] for r in common]] = True
    frequent = spark.sparkContext.broadcast(table)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2 * parts, -(-total * TRAVEL_BYTES // bucket_bytes))

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(span, buckets, frequent.value)
        for batch in pieces(batches, "text"):
            sender.add(batch.column("key").to_numpy(), batch.column("tie").to_numpy(), batch.column("text"))
            if sender.size > FLUSH_BYTES or len(sender.repeats) > FLUSH_BYTES // 64:
                yield from sender.flush()
        yield from sender.flush()

    runs = (
        rows.select("key", "tie", "text")
        .mapInArrow(send, "bucket bigint, payload binary")
        .repartition(max(parts, -(-buckets // TASK_BUCKETS)), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_runs(span, buckets), "key bigint, tie bigint, start bigint, windows bigint")
        .groupBy("key", "tie")
        .agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    )
    runs = runs.select(dealt_anew("key"), "tie", "runs")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * with_text
    return rows.join(runs, ["key", "tie"], "left").select("doc_id", "text", "runs").mapInArrow(_removed(span, with_text), schema)
