"""Arrow helpers used inside tasks: bounded pieces of a batch, words, ragged gathers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 4 << 20


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of one text column."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = int(total[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after another, and how many each text has.

    Words are runs of anything but the six ASCII white-space characters; null has none.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    flat = split.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    seen = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)))
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    return flat.filter(full), np.diff(seen[bounds])


def encoded(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in order of first appearance, and each word's place among them."""
    if not len(words):
        return words, np.zeros(0, np.int64)
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every run, one run after another."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts.astype(np.int64) - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    """0 and the running ends of the runs."""
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
