"""Hidden Markov language model with tied emissions.

A latent state emits one of a fixed number of word classes, a class emits its words by
their smoothed corpus counts: p(w | state) = p(class of w | state) * p(w | class). Words
fall into classes by a hash of their ending, so unseen and rare words share what was
learned of words like them, and the state parameters have a fixed size whatever the
vocabulary; the counts of the words themselves stay distributed.

Training: one pass writes the class of every token of every training text, whole, as a
compressed table; further passes read that. They count classes and, for the start values,
which frequent classes each class follows. Then Baum-Welch: every pass sends each
partition's expected counts (states x classes, states x states) to one aggregation, whose
result has the fixed size of the parameters and is what the driver sees. Forward and
backward are scaled, so likelihoods are exact at any length; the texts of a batch advance
together, one token position at a time, and stretches of a long text advance side by side.

Scoring needs the count of every token of a text. Texts are dealt into chunks; a chunk
asks for the counts of its distinct tokens, packed by token bucket, gets them back in the
order it asked, and looks them up locally. No vocabulary is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.batches import encoded, offsets_of, pieces, ragged, words_of
from gaugeworks.session import cut_lineage, written

CHUNK_BYTES = 12 << 20
LINE_TOKENS = 1_500_000
#: Tokens of a long text that are one lane of the recursion.
STRETCH = 1024
#: Tokens between two rescalings of a stretch's products.
RESCALE = 8
END = 0  # the class of the end token, which no word has


@dataclass(frozen=True)
class HmmRules:
    """Size of the model and of its training."""

    states: int = 6
    classes: int = 1 << 13
    anchors: int = 2048
    context: int = 32
    gain: float = 0.03
    stay: float = 0.9
    floor: float = 0.05
    piece_bytes: int = 8 << 20


@dataclass(frozen=True)
class Model:
    """Start, transition and class emission probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def class_of(distinct: pa.Array, classes: int, tail: int = 3) -> np.ndarray:
    """Class of each word, by a hash of its last bytes; never END."""
    digest = xxhash.xxh64_intdigest
    words = distinct.cast(pa.large_binary()).to_pylist()
    return 1 + np.fromiter((digest(w[-tail:], 9) % (classes - 1) for w in words), np.int64, len(words))


def tokens_of(texts: pa.Array, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of every token of the texts, the end of each included, and tokens per text."""
    words, counts = words_of(pc.ascii_lower(pc.fill_null(texts, "")))
    distinct, place = encoded(words)
    found = class_of(distinct, classes)[place] if len(words) else np.zeros(0, np.int64)
    return np.insert(found, np.cumsum(counts), END), counts + 1


class Lanes:
    """Stretches of a piece's texts, longest first: position t of all that have one is a slice.

    A text longer than ``most`` tokens is several stretches, so that a long text does not
    make the others wait; ``number`` counts the stretches of a text.
    """

    def __init__(self, lengths: np.ndarray, most: int = STRETCH):
        parts = np.maximum(1, -(-lengths // most))
        text = np.repeat(np.arange(len(lengths)), parts)
        number = ragged(np.zeros(len(parts), np.int64), parts)
        size = np.minimum(most, lengths[text] - number * most)
        order = np.argsort(-size, kind="stable")
        self.texts, self.text, self.number = len(lengths), text[order], number[order]
        self.lengths, self.last = size[order], (number + 1 == parts[text])[order]
        self.first = (offsets_of(lengths)[:-1][text] + number * most)[order]
        longest = int(self.lengths[0]) if len(order) else 0
        # stretches with more than t tokens, for every t
        self.width = np.searchsorted(-self.lengths, -np.arange(longest), side="left")
        self.base = offsets_of(self.width)
        # lanes of texts of several stretches, and the lane before each of theirs
        self.linked = np.nonzero(~(self.last & (self.number == 0)))[0]
        lane = np.empty(len(order), np.int64)
        lane[order] = np.arange(len(order))
        self.before = np.where(self.number > 0, lane[order - 1], -1)

    def places(self) -> np.ndarray:
        """Token number, in text order, of every (position, stretch) in slice order."""
        lane = np.arange(int(self.base[-1])) - np.repeat(self.base[:-1], self.width)
        return self.first[lane] + np.repeat(np.arange(len(self.width)), self.width)


def joints(model: Model, lanes: Lanes, emitted: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
    """State before every stretch, and with ``back`` the scaled beta after its last token.

    Stretches of one text are advanced side by side from every state at once; what that
    gives, the probability of a stretch's tokens and its last state by the state before, is
    then multiplied through the text from its start and from its end.
    """
    states = len(model.start)
    entry = np.tile(model.start, (len(lanes.lengths), 1))
    ahead = np.ones((len(lanes.lengths), states))
    some = lanes.linked
    if not len(some):
        return entry, ahead
    through = np.empty((len(some), states, states))
    logs = np.zeros((len(some), states))
    width = np.searchsorted(-lanes.lengths[some], -np.arange(int(lanes.lengths[some[0]])), side="left")
    begin = np.where((lanes.number[some] == 0)[:, None, None], np.eye(states), model.move)
    for t, w in enumerate(width.tolist()):
        now = emitted[int(lanes.base[t]) + some[:w]][:, None, :]
        part = through[:w]
        if t == 0:
            np.multiply(begin, now, out=part)
        else:  # one product of (stretch and state before, state) with the moves
            np.multiply((part.reshape(-1, states) @ model.move).reshape(part.shape), now, out=part)
        if t % RESCALE == RESCALE - 1 or t + 1 == len(width):
            scale = part.sum(axis=2)
            part /= scale[:, :, None]
            logs[:w] += np.log(scale)
    scale = through.sum(axis=2)  # stretches end between two rescalings
    through /= scale[:, :, None]
    logs += np.log(scale)
    logs -= logs.max(axis=1, keepdims=True)
    through *= np.exp(logs)[:, :, None]
    row = np.full(len(lanes.lengths), -1)
    row[some] = np.arange(len(some))
    numbers = lanes.number[some]
    for k in range(1, int(numbers.max()) + 1):
        now = some[numbers == k]
        before = lanes.before[now]
        found = np.einsum("nk,nkj->nj", entry[before], through[row[before]])
        entry[now] = found / found.sum(axis=1, keepdims=True)
    for k in range(int(numbers.max()), 0, -1) if back else ():
        now = some[numbers == k]
        found = np.einsum("nkj,nj->nk", through[row[now]], ahead[now])
        ahead[lanes.before[now]] = found / (found * entry[now]).sum(axis=1, keepdims=True)
    return entry, ahead


def forward(
    model: Model, lanes: Lanes, emitted: np.ndarray, keep: bool, entry: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward recursion over slice-ordered emissions (tokens, states).

    Returns log10 likelihoods by text and, with ``keep``, the scaled alphas with the scales
    in the last column.
    """
    if entry is None:
        entry, _ = joints(model, lanes, emitted, back=False)
    total = np.zeros(len(lanes.lengths))
    states = emitted.shape[1]
    alphas = np.empty((len(emitted), states + 1)) if keep else np.empty((0, 0))
    alpha = np.where((lanes.number == 0)[:, None], entry, entry @ model.move)
    for t, width in enumerate(lanes.width.tolist()):
        base = int(lanes.base[t])
        now = emitted[base : base + width]
        alpha = alpha * now if t == 0 else (alpha[:width] @ model.move) * now
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        total[:width] += np.log10(scale)
        if keep:
            alphas[base : base + width, :states] = alpha
            alphas[base : base + width, states] = scale
    return np.bincount(lanes.text, total, lanes.texts), alphas


def expected(model: Model, lanes: Lanes, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """State posteriors in slice order, expected moves and starts, and the log10 likelihood."""
    states = emitted.shape[1]
    entry, ends = joints(model, lanes, emitted, back=True)
    total, alphas = forward(model, lanes, emitted, True, entry)
    moves = np.zeros((states, states))
    beta = np.empty((0, states))
    for t in range(len(lanes.width) - 1, -1, -1):
        base, width = int(lanes.base[t]), int(lanes.width[t])
        following = len(beta)
        here = ends[:width].copy()
        alpha = alphas[base : base + width, :states]
        if following:
            after = int(lanes.base[t + 1])
            ahead = emitted[after : after + following] * beta / alphas[after : after + following, states][:, None]
            moves += alpha[:following].T @ ahead
            here[:following] = ahead @ model.move.T
        beta = here
        if t == 0:  # moves into the first tokens of later stretches
            later = lanes.number > 0
            moves += entry[later].T @ (emitted[:width] * beta / alphas[:width, states][:, None])[later]
        alphas[base : base + width, :states] = alpha * beta
    moves *= model.move
    gamma = alphas[:, :states]
    starts = gamma[: len(lanes.lengths)][lanes.number == 0].sum(axis=0)
    return gamma, moves, starts, float(total.sum())


def is_training(doc_id) -> F.Column:
    """All but a fifth of the documents, by a checksum of the id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != 1


CODED = "codes binary, lengths binary"


def _coded(rules: HmmRules):
    """Class codes and lengths of the texts of a piece, compressed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", rules.piece_bytes):
            classes, lengths = tokens_of(batch.column("text"), rules.classes)
            kinds = ("<u4" if rules.classes > 1 << 16 else "<u2", "<i8")
            packed = [zstandard.compress(x.astype(kind).tobytes(), 1) for x, kind in zip((classes, lengths), kinds)]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], ["codes", "lengths"])

    return run


def decoded(batches: Iterable[pa.RecordBatch], rules: HmmRules) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(class of every token, tokens per text) of every piece."""
    for batch in batches:
        for codes, lengths in zip(batch.column("codes"), batch.column("lengths")):
            classes = np.frombuffer(zstandard.decompress(codes.as_py()), "<u4" if rules.classes > 1 << 16 else "<u2")
            yield classes.astype(np.int64), np.frombuffer(zstandard.decompress(lengths.as_py()), "<i8")


def _class_counts(rules: HmmRules):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(rules.classes, np.int64)
        for classes, _ in decoded(batches, rules):
            counts += np.bincount(classes, minlength=rules.classes)
        yield from sparse_rows(np.arange(rules.classes), counts[:, None].astype(float))

    return run


def _beside_counts(rules: HmmRules, common: np.ndarray):
    """Per anchor class: how often it stands next to each of the first classes of ``common``."""
    row = np.full(rules.classes, -1, np.int64)
    row[common] = np.arange(len(common))
    width = min(rules.context, len(common))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(common) * width, np.int64)
        for classes, counts in decoded(batches, rules):
            inner = np.ones(max(0, len(classes) - 1), bool)
            inner[np.cumsum(counts)[:-1] - 1] = False  # not across texts
            for a, b in ((classes[:-1], classes[1:]), (classes[1:], classes[:-1])):
                anchor, near = row[b], row[a]
                ok = inner & (anchor >= 0) & (near >= 0) & (near < width)
                seen += np.bincount(anchor[ok] * width + near[ok], minlength=len(seen))
        yield from sparse_rows(common, seen.reshape(len(common), width).astype(float))

    return run


def sparse_rows(keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (key, values) that are not all zero."""
    some = np.nonzero(values.any(axis=1))[0]
    width = values.shape[1]
    for at in range(0, len(some), 4096):
        part = some[at : at + 4096]
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(values[part]).ravel())
        )
        yield pa.RecordBatch.from_arrays([pa.array(keys[part]), lists], ["key", "values"])


def _expected_counts(rules: HmmRules, model: Model):
    """One Baum-Welch pass over a partition: expected counts by class, then moves, starts and the likelihood."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = rules.states
        emissions = np.zeros((rules.classes, states))
        moves, starts, gained = np.zeros((states, states)), np.zeros(states), np.zeros(states)
        for classes, lengths in decoded(batches, rules):
            lanes = Lanes(lengths)
            token = classes[lanes.places()]
            gamma, some_moves, some_starts, likelihood = expected(model, lanes, model.emit.T[token])
            gained[0] += likelihood
            for k in range(states):
                emissions[:, k] += np.bincount(token, weights=gamma[:, k], minlength=rules.classes)
            moves += some_moves
            starts += some_starts
        yield from sparse_rows(np.arange(rules.classes), emissions)
        yield from sparse_rows(-1 - np.arange(states + 2), np.vstack([moves, starts, gained]))

    return run


def gathered(rows: DataFrame, width: int) -> dict[int, np.ndarray]:
    """Sums of (key, values) rows over all partitions; as many keys as the model has classes."""
    summed = rows.groupBy("key").agg(F.array(*[F.sum(F.get("values", F.lit(k))) for k in range(width)]).alias("values"))
    return {r["key"]: np.array(r["values"]) for r in summed.collect()}


def start_model(counts: np.ndarray, anchors: np.ndarray, beside: np.ndarray, rules: HmmRules) -> Model:
    """States from clusters of anchor classes that stand beside the same frequent classes.

    Weighted k-means on the square roots of the rows' shares, seeded farthest-first from the
    most frequent class: no randomness. Other classes start alike in all states.
    """
    k = rules.states
    soft = np.full((rules.classes, k), 1 / k)
    weight = np.where(beside.sum(axis=1) > 0, counts[anchors], 0.0)
    if weight.sum() > 0:
        shares = np.sqrt((beside + 0.01) / (beside + 0.01).sum(axis=1, keepdims=True))
        chosen = [int(np.argmax(weight))]
        heavy = np.arange(min(len(anchors), 8 * rules.context))
        while len(chosen) < k:
            away = np.min([((shares[heavy] - shares[c]) ** 2).sum(axis=1) for c in chosen], axis=0)
            chosen.append(int(heavy[np.argmax(away * np.sqrt(weight[heavy] + 1e-9))]))
        centres = shares[chosen].copy()
        for _ in range(20):
            near = np.argmax(shares @ centres.T / np.linalg.norm(centres, axis=1), axis=1)
            for c in range(k):
                mine = near == c
                if weight[mine].sum() > 0:
                    centres[c] = np.average(shares[mine], axis=0, weights=weight[mine])
        fit = shares @ centres.T / np.linalg.norm(centres, axis=1)
        fit = np.exp(16 * (fit - fit.max(axis=1, keepdims=True)))
        soft[anchors] = fit / fit.sum(axis=1, keepdims=True)
    emit = (soft.T + rules.floor) * (counts + 0.1)
    move = np.full((k, k), (1 - rules.stay) / max(1, k - 1))
    np.fill_diagonal(move, rules.stay if k > 1 else 1.0)
    return Model(np.full(k, 1 / k), move, emit / emit.sum(axis=1, keepdims=True))


def train(texts: DataFrame, rules: HmmRules = HmmRules()) -> Model:
    """Baum-Welch over all rows of the column ``text``.

    Rounds go on until the log10 likelihood a token gains less than ``rules.gain``.
    """
    coded = written(texts.select("text").mapInArrow(_coded(rules), CODED), "coded")
    counts = np.zeros(rules.classes)
    for key, value in gathered(coded.mapInArrow(_class_counts(rules), "key bigint, values array<double>"), 1).items():
        counts[key] = value[0]
    anchors = np.argsort(-counts, kind="stable")[: rules.anchors]
    width = min(rules.context, len(anchors))
    beside = np.zeros((rules.classes, width))
    for key, value in gathered(coded.mapInArrow(_beside_counts(rules, anchors), "key bigint, values array<double>"), width).items():
        beside[key] = value
    model = start_model(counts, anchors, beside[anchors], rules)
    prior = (counts + 0.5) / (counts + 0.5).sum()
    before = -math.inf
    while counts.sum():
        sums = gathered(coded.mapInArrow(_expected_counts(rules, model), "key bigint, values array<double>"), rules.states)
        emit, move, start = np.zeros((rules.classes, rules.states)), np.zeros((rules.states,) * 2), np.zeros(rules.states)
        likelihood = 0.0
        for key, value in sums.items():
            if key >= 0:
                emit[key] = value
            elif -1 - key < rules.states:
                move[-1 - key] = value
            elif -1 - key == rules.states:
                start = value
            else:
                likelihood = value[0]
        # the prior lends every class a little mass, so no word is impossible in a state
        emit = emit.T + 5.0 * prior
        move, start = move + 0.1, start + 0.1
        model = Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))
        if likelihood - before < rules.gain * counts.sum():
            break
        before = likelihood
    return model


def homes_of(distinct: pa.Array, classes: np.ndarray, rules: HmmRules, buckets: int) -> np.ndarray:
    """Bucket of each word; a class lies in one bucket, or in whole buckets of its own."""
    if buckets <= rules.classes:
        return classes % buckets
    share = buckets // rules.classes
    digest = xxhash.xxh64_intdigest
    words = distinct.cast(pa.large_binary()).to_pylist()
    return classes * share + np.fromiter((digest(w, 11) % share for w in words), np.int64, len(words))


def by_bucket(home: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of each bucket's words, in order of appearance."""
    order = np.argsort(home, kind="stable")
    bounds = np.nonzero(np.diff(home[order], prepend=-1, append=-1))[0]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield int(home[order[a]]), order[a:b]


def by_chunk(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Table]]:
    """Rows sorted by chunk come in; parts of about CHUNK_BYTES of text of one chunk go out.

    Where a part ends depends on the rows alone, not on how they are batched.
    """
    held, now, part, size = [], None, 0, 0
    for batch in batches:
        chunks = batch.column("chunk").to_numpy()
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(chunks):
            if chunks[at] != now:
                if held:
                    yield now, part, pa.Table.from_batches(held)
                held, now, part, size = [], int(chunks[at]), 0, 0
            elif size > CHUNK_BYTES:
                yield now, part, pa.Table.from_batches(held)
                held, part, size = [], part + 1, 0
            end = at + int(np.searchsorted(chunks[at:], now, side="right"))
            room = np.searchsorted(np.cumsum(sizes[at:end]), max(0, CHUNK_BYTES - size), side="right") + 1
            end = min(end, at + int(room))
            held.append(batch.slice(at, end - at))
            size += int(sizes[at:end].sum())
            at = end
    if held:
        yield now, part, pa.Table.from_batches(held)


def lowered(part: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct folded words of a part, each word's place among them, and words per text."""
    words, counts = words_of(pc.ascii_lower(pc.fill_null(part.column("text").combine_chunks(), "")))
    distinct, place = encoded(words)
    return distinct, place, counts


def planes(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unplaned(payload: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(payload), np.uint8).reshape(8, -1).T).view("<i8").ravel()


ASK = "chunk bigint, part int, bucket bigint, words binary, counts binary"
ANSWER = "chunk bigint, part int, bucket bigint, payload binary, key bigint, values array<double>"


def _asks(rules: HmmRules, buckets: int):
    """What each part asks of each bucket: its distinct words and their training counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, part, rows in by_chunk(batches):
            distinct, place, counts = lowered(rows)
            if not len(distinct):
                continue
            train = np.repeat(rows.column("train").to_numpy(zero_copy_only=False), counts)
            seen = np.bincount(place[train], minlength=len(distinct))
            homes = homes_of(distinct, class_of(distinct, rules.classes), rules, buckets)
            words = distinct.cast(pa.large_binary()).to_pylist()
            out = [
                (bucket, zstandard.compress(b"\n".join([words[i] for i in some.tolist()]), 1), planes(seen[some]))
                for bucket, some in by_bucket(homes)
            ]
            for at in range(0, len(out), 512):
                rows_ = out[at : at + 512]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * len(rows_), pa.int64()), pa.array([part] * len(rows_), pa.int32()),
                        pa.array([r[0] for r in rows_], pa.int64()), pa.array([r[1] for r in rows_], pa.binary()),
                        pa.array([r[2] for r in rows_], pa.binary()),
                    ],
                    ["chunk", "part", "bucket", "words", "counts"],
                )

    return run


def _answers(rules: HmmRules):
    """Rows sorted by bucket; each ask gets the words' corpus counts, each class its totals."""

    def solve(bucket: int, asks: list[tuple]) -> pa.RecordBatch:
        lists = [zstandard.decompress(a[2]).split(b"\n") for a in asks]
        sizes = np.array([len(x) for x in lists], np.int64)
        distinct, place = encoded(pa.array([w for x in lists for w in x], pa.large_binary()))
        totals = np.zeros(len(distinct), np.int64)
        np.add.at(totals, place, np.concatenate([unplaned(a[3]) for a in asks]))
        cuts = offsets_of(sizes)
        found = totals[place]
        payloads = [planes(found[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        classes, of = np.unique(class_of(distinct, rules.classes), return_inverse=True)
        sums = np.stack([np.bincount(of, weights=totals), np.bincount(of, weights=totals > 0)], axis=1)
        n, m = len(asks), len(classes)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([a[0] for a in asks] + [None] * m, pa.int64()), pa.array([a[1] for a in asks] + [None] * m, pa.int32()),
                pa.array([bucket] * (n + m), pa.int64()), pa.array(payloads + [None] * m, pa.binary()),
                pa.array([None] * n + classes.tolist(), pa.int64()), pa.array([None] * n + sums.tolist(), pa.list_(pa.float64())),
            ],
            ["chunk", "part", "bucket", "payload", "key", "values"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, *ask in zip(*(batch.column(c).to_pylist() for c in ("bucket", "chunk", "part", "words", "counts"))):
                if bucket != now and held:
                    yield solve(now, held)
                    held = []
                now = bucket
                held.append(ask)
        if held:
            yield solve(now, held)

    return run


@dataclass(frozen=True)
class Totals:
    """Sizes of the training text: tokens, distinct tokens, ends, and both by class."""

    tokens: float
    distinct: float
    ends: int
    by_class: np.ndarray


def _scores(rules: HmmRules, buckets: int, model: Model, totals: Totals):
    """Answers of a chunk come first, then its texts; scores go out."""
    size = math.log10(totals.tokens + 0.5 * (totals.distinct + 1))
    of_class = np.log10(totals.by_class[:, 0] + 0.5 * (totals.by_class[:, 1] + 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: dict[tuple[int, int], dict[int, bytes]] = {}

        def texts() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                is_answer = pc.is_valid(batch.column("payload"))
                told = batch.filter(is_answer)
                for chunk, part, bucket, payload in zip(*(told.column(c).to_pylist() for c in ("chunk", "part", "bucket", "payload"))):
                    answers.setdefault((chunk, part), {})[bucket] = payload
                yield batch.filter(pc.invert(is_answer))

        for chunk, part, rows in by_chunk(texts()):
            distinct, place, counts = lowered(rows)
            told = answers.pop((chunk, part), {})
            classes = class_of(distinct, rules.classes)
            known = np.zeros(len(distinct), np.int64)
            for bucket, some in by_bucket(homes_of(distinct, classes, rules, buckets)) if len(distinct) else ():
                known[some] = unplaned(told[bucket])
            doc = np.repeat(np.arange(len(counts)), counts)
            plain = np.log10(known + 0.5)
            base = np.bincount(doc, plain[place], len(counts)) + math.log10(totals.ends + 0.5)
            inside = np.bincount(doc, (plain - of_class[classes])[place], len(counts))
            seen = np.bincount(doc, (known > 0)[place], len(counts)) + (totals.ends > 0)
            tokens = counts + 1
            stream = np.insert(classes[place], np.cumsum(counts), END)
            score, at, bounds = np.zeros(len(counts)), 0, offsets_of(tokens)
            while at < len(counts):
                upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + LINE_TOKENS, side="right")) - 1)
                lanes = Lanes(tokens[at:upto])
                line = stream[bounds[at] : bounds[upto]]
                total, _ = forward(model, lanes, model.emit.T[line[lanes.places()]], keep=False)
                score[at:upto] = total
                at = upto
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").combine_chunks(), pc.invert(rows.column("train").combine_chunks()),
                    pa.array(tokens.astype(np.int64)), pa.array(np.rint(seen).astype(np.int64)),
                    pa.array(np.full(len(counts), int(totals.tokens), np.int64)),
                    pa.array(base - tokens * size), pa.array(score + inside),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def score(docs: DataFrame, rules: HmmRules = HmmRules()) -> DataFrame:
    """Train on all but a fifth of the documents and score every whole text.

    Tokens are the words of the text with A-Z lower-cased and one end. Returns one row per
    document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score`` (smoothed
    unigram) and ``score`` (the model's log10 probability of the text).

    Null or empty text is the end token alone. A null doc_id counts as the empty string in
    the split. Repeated rows are documents of their own. Empty table: no rows. Further
    columns of any name are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        is_training(F.col("doc_id")).alias("train"),
    )
    sizes = rows.agg(F.count_if("train"), F.sum(F.octet_length("text"))).first()
    ends, size = sizes[0], sizes[1] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(parts, -(-size // CHUNK_BYTES))
    buckets = max(parts, size // (8 * CHUNK_BYTES))
    buckets = buckets if buckets <= rules.classes else -(-buckets // rules.classes) * rules.classes
    chunked = rows.withColumn("hash", F.xxhash64("doc_id", "text")).withColumn("chunk", F.pmod("hash", F.lit(chunks)))
    order = ["chunk", "doc_id", "hash"]
    # a task gets a few chunks or one bucket at a time, however many there are
    tasks = max(parts, -(-chunks // 4))
    asks = chunked.repartition(tasks, "chunk").sortWithinPartitions(*order).select("chunk", "text", "train").mapInArrow(_asks(rules, buckets), ASK)
    answers = cut_lineage(asks.repartition(max(parts, buckets), "bucket").sortWithinPartitions("bucket").mapInArrow(_answers(rules), ANSWER))
    by_class = np.zeros((rules.classes, 2))
    for key, value in gathered(answers.filter("key is not null").select("key", "values"), 2).items():
        by_class[key] = value
    tokens, distinct = by_class.sum(axis=0)
    by_class[END] = (ends, 0)
    totals = Totals(tokens + ends, distinct + (ends > 0), ends, by_class)
    model = train(rows.filter("train"), rules)
    told = answers.filter("key is null").select("chunk", "part", "bucket", "payload")
    both = chunked.unionByName(told, allowMissingColumns=True)
    lined = both.repartition(tasks, "chunk").sortWithinPartitions("chunk", F.col("payload").isNull(), "doc_id", "hash")
    return lined.mapInArrow(
        _scores(rules, buckets, model, totals),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
