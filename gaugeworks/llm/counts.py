"""Exact token counts of texts of any length by overlap resynchronisation.

A long text is cut into chunks that overlap, each chunk is encoded on its own with the
offsets of its tokens, and neighbours are spliced at a boundary inside their overlap. The
boundary is chosen from the text alone and proven stable: byte-pair merges join two
neighbouring symbols only if their concatenation is a piece of the vocabulary, so between
two characters that stand next to each other in no piece nothing is ever merged, whatever
stands around them. Tokens on the left and the right of such a place do not depend on the
other side; what a chunk's own cut edges do to its tokens ends at the first such place.

An overlap that holds no stable boundary is widened, twice as far each time, in the last
resort to the end of the text. Both neighbours check that the splice is an end of a token
in their own encoding.

Chunks of one text are dealt over tasks; texts of up to one chunk are encoded whole where
they are read. Token counts of chunks are summed before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import pieces
from gaugeworks.llm.text import filled

SPACE_MARK = "▁"


@dataclass(frozen=True)
class ChunkRules:
    """Characters of a chunk and of the overlap first tried; a text longer than a chunk is cut."""

    size: int = 32_768
    overlap: int = 256


class PieceVocabulary:
    """A sentencepiece BPE model and the pairs of characters that some piece holds side by side."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        self.pairs: set[str] = set()
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                piece = model.id_to_piece(i)
                self.pairs.update(map("".join, zip(piece, piece[1:])))

    def stable(self, text: str, at: int) -> bool:
        """No piece can reach across this place of the text."""
        return text[at - 1 : at + 1].replace(" ", SPACE_MARK) not in self.pairs

    def first_stable(self, text: str, begin: int, end: int) -> int | None:
        return next((p for p in range(begin, end) if self.stable(text, p)), None)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def chunks(self, text: str, rules: ChunkRules) -> Iterator[tuple[int, int, str]]:
        """``(head, tail, chunk)``: of the chunk's tokens those in [head, tail) are the text's.

        Chunk and successor share the text from the border, or from ``rules.overlap``
        characters before the splice, to as many characters after the splice.
        """
        begin = head = 0  # where the chunk begins, and from where on its tokens count
        while (border := head + rules.size) < len(text):
            overlap, splice = rules.overlap, None
            while splice is None:
                end = min(border + overlap, len(text))
                splice = self.first_stable(text, border + 1, end)
                if splice is None and end == len(text):
                    yield head - begin, len(text) - begin, text[begin:]
                    return
                overlap *= 2
            yield head - begin, splice - begin, text[begin : splice + rules.overlap]
            begin, head = max(border, splice - rules.overlap), splice
        yield head - begin, len(text) - begin, text[begin:]

    def count_between(self, head: int, tail: int, chunk: str) -> int:
        """Tokens of the encoded chunk that lie in [head, tail); both must be ends of tokens."""
        at, to = len(chunk[:head].encode()), len(chunk[:tail].encode())
        begins = [piece.begin for piece in self.model.encode(chunk, return_type="proto").pieces]  # in bytes
        if not {at, to} <= {0, len(chunk.encode()), *begins}:
            raise ValueError(f"a token crosses a splice at {head} or {tail} of {len(chunk)} characters")
        return sum(at <= begin < to for begin in begins)


_VOCABULARIES: dict[str, PieceVocabulary] = {}


def vocabulary(path: str) -> PieceVocabulary:
    """One per worker process, kept between tasks."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = PieceVocabulary(path)
    return _VOCABULARIES[path]


def token_counts(
    docs: DataFrame, model_path: str | None = None, limit: int = 4096, rules: ChunkRules = ChunkRules()
) -> DataFrame:
    """Tokens of every whole text as ``SentencePieceProcessor.encode`` gives them.

    One row per document: ``doc_id, n_bytes`` (UTF-8), ``n_tokens, over_limit`` (more than
    ``limit`` tokens). No begin, end or added tokens; strings of special tokens inside a
    text are text.

    Null and empty texts have no bytes and tokens. A text of white space alone has tokens.
    Null and repeated doc_ids are rows like any other. Empty table: no rows. A text without
    any stable boundary is one chunk. Further columns are ignored.
    """
    import public_tokenizers

    path = model_path or public_tokenizers.path("piece_bpe_32k.model")

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = vocabulary(path).counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(found, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    names = ["uid", "doc_id", "n_bytes", "number", "head", "tail", "text"]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, held, size = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            for doc_id, n_bytes, text in zip(*[batch.column(c) for c in ("doc_id", "n_bytes", "text")]):
                for number, (head, tail, chunk) in enumerate(vocabulary(path).chunks(text.as_py(), rules)):
                    held.append((uid, doc_id.as_py(), n_bytes.as_py(), number, head, tail, chunk))
                    size += len(chunk)
                    if size > 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names)
                        held, size = [], 0
                uid += 1
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names)

    def spliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = zip(*[batch.column(c).to_pylist() for c in ("head", "tail", "text")])
            found = [vocabulary(path).count_between(*chunk) for chunk in chunks]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("uid", "doc_id", "n_bytes")], pa.array(found, pa.int64())],
                ["uid", "doc_id", "n_bytes", "n_tokens"],
            )

    text = filled(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    long = F.length("text") > rules.size
    short = rows.filter(~long).mapInArrow(whole, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    chunks = rows.filter(long).mapInArrow(
        cut, "uid bigint, doc_id bigint, n_bytes bigint, number bigint, head bigint, tail bigint, text string"
    )
    sums = (
        chunks.repartition("uid", "number")
        .mapInArrow(spliced, "uid bigint, doc_id bigint, n_bytes bigint, n_tokens bigint")
        .groupBy("uid", "doc_id", "n_bytes")
        .agg(F.sum("n_tokens").alias("n_tokens"))
        .drop("uid")
    )
    return short.unionByName(sums).withColumn("over_limit", F.col("n_tokens") > limit)
