"""Token ids of white-space separated chunks, each distinct chunk encoded once.

The vocabulary ``word_bpe_49k.json`` drops white space and never merges across it, so a
text's ids are its chunks' ids one after another. Chunks in Latin letters are split into
their parts (words, digits, other characters), and all new parts of a batch are merged in
one call: every part is closed by a mark, which stands for the vocabulary's word end and
merges with the byte before it first of all. All other chunks, and chunks that may hold a
special token's string, go through the tokenizer's full ``encode``.
"""

from __future__ import annotations

import json

import numpy as np
import regex

PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
LATIN = regex.compile(r"[\x21-\x7E¡-ſ]+")
WORD_END = "</w>"
#: Stands for the word end; no chunk that is printable or Latin holds it.
MARK = "\x01"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def marked_ranks(model: dict) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """Merge ranks over marked bytes, and by rank the vocabulary's id and whether a part ends there.

    Ranks: the bytes, the bytes with the mark, then the merges in their order. Lowest rank
    first gives the vocabulary's own merges if every token's last merge is the listed one
    (``tests`` hold this for all of them): a merge of two other neighbours to the same
    token would need another way of merging the token's own bytes.
    """
    value = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}

    def marked(token: str) -> bytes:
        text = token.removesuffix(WORD_END)
        return b"".join(map(value.__getitem__, text)) + MARK.encode() * (text != token)

    singles = [bytes([b]) for b in range(256)]
    order = [*singles, *[b + MARK.encode() for b in singles]]
    for merge in model["merges"]:
        first, second = merge.split(" ") if isinstance(merge, str) else merge
        order.append(marked(first) + marked(second))
    ranks = {token: rank for rank, token in enumerate(order)}
    ids = np.zeros(len(order), np.uint32)
    for token, number in model["vocab"].items():
        if set(token.removesuffix(WORD_END)) <= value.keys() and (at := ranks.get(marked(token))) is not None:
            ids[at] = number
    return ranks, ids, np.array([t.endswith(MARK.encode()) and len(t) > 1 for t in order])


class ChunkVocabulary:
    """Ids of every chunk seen, as one flat array with a start and a length per chunk."""

    def __init__(self, path: str, extra: tuple[int, ...] = (), most: int = 300_000):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ranks, self.id_of, self.ends = marked_ranks(json.loads(self.tokenizer.to_str())["model"])
        self.merger = tiktoken.Encoding("marked", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks=ranks, special_tokens={})
        self.most, self.extra = most, extra
        self.clear()

    def clear(self) -> None:
        """Forget all chunks but the extra ids, which stay at place 0."""
        self.places: dict[str, int] = {}
        self.ids = np.array(self.extra, np.uint32)
        self.starts, self.lengths = np.zeros(1, np.int64), np.full(1, len(self.extra), np.int64)

    def parts(self, chunk: str) -> list[str] | None:
        """What is merged on its own; None if the chunk needs the full tokenizer."""
        plain = chunk.isascii() and chunk.isprintable() or LATIN.fullmatch(chunk)
        if not plain or "<|" in chunk:
            return None
        text = chunk.lower()  # composed letters of this range need no other normalisation
        return [text] if text.isalpha() else PARTS.findall(text)

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after another, and how many each has."""
        found = list(map(self.parts, chunks))
        flat = [part for parts in found if parts for part in parts]
        merged = np.array(self.merger.encode_ordinary(MARK.join([*flat, ""])), np.int64)
        ends = np.concatenate(([0], np.nonzero(self.ends[merged])[0] + 1))
        counts = np.array([len(parts) if parts else 0 for parts in found], np.int64)
        bounds = ends[np.concatenate(([0], np.cumsum(counts)))]
        lengths, ids = np.diff(bounds), self.id_of[merged]
        others = [k for k, parts in enumerate(found) if parts is None]
        if others:
            pieces, at = [], 0
            for k in others:
                own = self.tokenizer.encode(chunks[k], add_special_tokens=False).ids
                pieces += [ids[at : bounds[k]], np.array(own, np.uint32)]
                lengths[k], at = len(own), bounds[k]
            ids = np.concatenate([*pieces, ids[at:]])
        return ids, lengths

    def places_of(self, chunks: list[str]) -> np.ndarray:
        """Places of the chunks; starts, lengths and ids then cover them all.

        The store is emptied first when it holds more than ``most`` chunks, so its size is
        bounded by that and one call's chunks.
        """
        if len(self.places) > self.most:
            self.clear()
        known = self.places
        new = [chunk for chunk in dict.fromkeys(chunks) if chunk not in known]
        if new:
            known.update(zip(new, range(len(known) + 1, len(known) + 1 + len(new))))
            ids, lengths = self.encode(new)
            begin = len(self.ids)
            self.starts = np.concatenate([self.starts, begin + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, ids])
        return np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))


_VOCABULARIES: dict[tuple[str, tuple[int, ...]], ChunkVocabulary] = {}


def vocabulary(path: str, extra: tuple[int, ...]) -> ChunkVocabulary:
    """One vocabulary per worker process, kept between tasks."""
    if (path, extra) not in _VOCABULARIES:
        _VOCABULARIES[path, extra] = ChunkVocabulary(path, extra)
    return _VOCABULARIES[path, extra]
