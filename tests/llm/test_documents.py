"""Document operators against brute force, on a table with every awkward case."""

from __future__ import annotations

import collections
import hashlib
import itertools
import json
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeworks.llm import components, exact, hmm, licences, mixing, packing, quality, simhash, spans, wordpiece
from gaugeworks.llm.batches import pieces, words_of
from gaugeworks.llm.wordpiece import ChunkVocabulary

UPPER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def folded(text):
    return (text or "").translate(UPPER)


def words(text):
    return (text or "").encode().split()


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def key(row):
    return tuple((v is not None, v) for v in row)


# packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_chunks_have_the_tokenizers_ids(tokenizer, plain):
    vocab = ChunkVocabulary(public_tokenizers.path("word_bpe_49k.json"), (1,), most=50)
    for _, text, _ in plain:
        chunks = [w.decode() for w in words(text)]
        places = vocab.places_of(chunks)
        got = [int(x) for p in places for x in vocab.ids[vocab.starts[p] : vocab.starts[p] + vocab.lengths[p]]]
        assert got == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pack_pieces_rebuild_every_document(docs, tokenizer, plain):
    got = packing.pack(docs, with_ids=True).collect()
    texts = collections.Counter()
    for i, text, _ in plain:
        texts[i, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])] += 1
    sequences = collections.defaultdict(list)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) > 0
        sequences[r.sequence_id].append(r)
    order = sorted((r for r in got), key=lambda r: (r.sequence_id, r.offset))
    for pieces_ in sequences.values():
        at = 0
        for r in sorted(pieces_, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    rebuilt, held = collections.Counter(), []
    for r in order:  # pieces of a document follow each other
        assert r.start == len(held)
        held += r.ids
        if len(held) == r.doc_tokens:
            rebuilt[r.doc_id, tuple(held)] += 1
            held = []
    assert not held and rebuilt == texts


def test_best_cuts_are_the_cheapest():
    rng = random.Random(3)
    rules = packing.PackRules(size=16, least_power=4)
    for _ in range(150):
        steps = [rng.randint(1, 9) for _ in range(rng.randint(1, 8))]
        positions = [0, *itertools.accumulate(steps)]
        penalties = [0.0, *[rng.choice([0.0, 1.0, 5.0]) for _ in steps]]

        def cost(cuts):
            total = 0.0
            for a, b in zip(cuts[:-1], cuts[1:]):
                n = positions[b] - positions[a]
                if n > 16:
                    return math.inf
                total += penalties[b] + (0 if n in (4, 8, 16) else 16 - n)
            return total

        inner = range(1, len(steps))
        best = min(
            cost([0, *some, len(steps)]) for k in range(len(steps)) for some in itertools.combinations(inner, k)
        )
        assert cost(packing.best_cuts(positions, penalties, rules)) == best


# mixing


def test_mix_meets_targets_and_repeats(docs, plain):
    got = mixing.mix(docs, least_per_range=4).collect()
    assert len(got) == len(plain)
    sizes = collections.Counter()
    for _, text, source in plain:
        sizes[source] += len(words(text))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and weight[s] * level >= 2 * sizes[s]}
        if not over:
            break
        capped |= over
    taken = collections.Counter()
    for r in got:
        want = 2 * sizes[r.source] if r.source in capped else weight[r.source] * level
        assert r.target == pytest.approx(want) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - (2 * sizes[s] if s in capped else weight[s] * level)) <= 1
    again = mixing.mix(docs.repartition(5), least_per_range=4).collect()
    assert sorted(map(key, got)) == sorted(map(key, again))


# exact dedup


def test_exact_groups(docs, plain):
    got = exact.exact_groups(docs, head=8, growth=4).collect()
    groups = collections.defaultdict(list)
    for i, text, _ in plain:
        groups[folded(text)].append(i)
    least = -(10**9)
    want = []
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: least if i is None else i)
        want += [(i, keep, len(ids), sha(text)) for i in ids]
    assert sorted(key((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == sorted(map(key, want))
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


# substring dedup


def brute_spans(rows, span):
    seen = {}
    order = sorted({(i is not None, i or 0, t) for i, t in rows}, key=lambda r: (r[0], r[1]))
    removed = {}
    for has, i, t in order:
        w = words(t)
        marks = [False] * len(w)
        for a in range(len(w) - span + 1):
            window = tuple(w[a : a + span])
            if window in seen:
                marks[a : a + span] = [True] * span
            else:
                seen[window] = True
        removed[has, i, t] = [x for x, m in zip(w, marks) if not m]
    return removed


@pytest.mark.parametrize("span,bucket", [(20, 16 << 20), (4, 64)])
def test_remove_repeats(spark, plain, span, bucket):
    rows = [(i, t) for i, t, _ in plain if i != 21] + [(30, "a b c d " * 30), (31, "b c d a " * 10)]
    got = spans.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), span, bucket_bytes=bucket)
    nulls = [t for i, t in rows if i is None]
    want = brute_spans([r for r in rows if r[0] is not None or r[1] == nulls[0]], span)
    checked = 0
    for r in got.collect():
        if r.doc_id is None and r.n_words == 0:
            continue
        kept = next(v for (has, i, t), v in want.items() if (i if has else None) == r.doc_id)
        assert r.kept_sha256 == sha(b" ".join(kept)) and r.n_removed == r.n_words - len(kept)
        checked += 1
    assert checked == len(rows) - 1


def test_remove_repeats_takes_all_copies_of_a_row_alike(docs):
    got = [r for r in spans.remove_repeats(docs, with_text=True).collect() if r.doc_id == 21]
    assert len(got) == 3 and all(r.n_removed == 0 and len(r.kept_text.split(" ")) == r.n_words for r in got)


@pytest.mark.parametrize("n", range(1, 26))
def test_pieces_shorter_than_a_window(n):
    sender = spans.Sender(20, 4, np.zeros(spans.SLOTS, bool))
    sender.add(np.arange(1), np.zeros(1, np.int32), pa.array([" ".join(f"w{k}" for k in range(n))]))
    assert sum(held[3] for held in sender.kept.values()) == max(0, n - 19)
    values = np.arange(n, 0, -1).astype(np.uint64)
    assert spans.sliding_least(values, 18).tolist() == [int(min(values[i : i + 18])) for i in range(n - 17)]


def test_tables_shorter_than_a_window(spark):
    for n in (8, 14, 15, 16, 20):
        (row,) = spans.remove_repeats(spark.createDataFrame([(1, "a " * n)], "doc_id bigint, text string")).collect()
        assert (row.n_words, row.n_removed) == (n, 0)


def test_window_hashes_depend_on_the_window_alone():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 3, 400).astype(np.uint64)
    for span in (3, 4, 7, 20):
        hashes = spans.window_hashes(spans.mixed(codes + np.uint64(1)), span)
        assert len(hashes) == 400 - span + 1
        by = collections.defaultdict(set)
        for i, h in enumerate(hashes.tolist()):
            by[tuple(codes[i : i + span].tolist())].add(h)
        assert all(len(v) == 1 for v in by.values()) and len({h for v in by.values() for h in v}) == len(by)


# simhash


def brute_print(text):
    w = folded(text).encode().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_groups(docs, plain):
    got = simhash.near_groups(docs).collect()
    prints = {brute_print(t) for _, t, _ in plain}
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= 3:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    least = {}
    for i, t, _ in plain:
        r = find(brute_print(t))
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = sorted(key((i, f"{brute_print(t):016x}", least[find(brute_print(t))])) for i, t, _ in plain)
    assert sorted(key((r.doc_id, r.fingerprint, r.component_id)) for r in got) == want
    assert sum(r.kept for r in got) == len(least) and all(r.doc_id == r.component_id for r in got if r.kept)


def test_golay_decodes_three_errors():
    rng = random.Random(5)
    for _ in range(300):
        word = rng.getrandbits(12) << 11
        word ^= simhash._remainder(word)
        errors = rng.sample(range(23), rng.randint(0, 3))
        bad = word
        for e in errors:
            bad ^= 1 << e
        assert simhash.golay_index(np.array([bad]))[0] == word >> 11


def test_close_prints_share_a_bucket():
    rng = random.Random(6)
    first = [rng.getrandbits(64) for _ in range(1500)]
    second = []
    for p in first:
        for e in rng.sample(range(64), rng.randint(1, 3)):
            p ^= 1 << e
        second.append(p)
    keys, rows = simhash.bucket_keys(np.array(first + second, np.uint64))
    held = collections.defaultdict(set)
    for k, r in zip(keys.tolist(), rows.tolist()):
        held[r].add(k)
    assert all(held[i] & held[i + 1500] for i in range(1500))
    assert len(keys) < 30 * 3000


@pytest.mark.parametrize("block", [1, 64, 1 << 20])
def test_links_join_what_pairs_join(block):
    rng = random.Random(7)
    prints = [rng.getrandbits(64) for _ in range(30)]
    for p in prints[:]:
        for _ in range(4):
            p ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.append(p)
    prints = sorted(set(prints))

    def parts(edges):
        root = list(range(len(prints)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for i, j in edges:
            root[max(find(i), find(j))] = min(find(i), find(j))
        return [find(i) for i in range(len(prints))]

    forest = simhash.links(np.array(prints, np.uint64), block=block)
    assert parts(forest) == parts(simhash.few_links(prints)) and len(forest) == len(prints) - len(set(parts(forest)))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 501), (501, 500), (7, 7), (900, 200)] + [(1000 + i, 1000) for i in range(50)]
    got = dict(map(tuple, components.connected(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert all(got[i] == 0 for i in range(101)) and got[501] == got[500] == 500 and got[900] == 200
    assert all(got[1000 + i] == 1000 for i in range(50))


# quality


def brute_measures(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {g for g, n in collections.Counter(windows).items() if n > 1}
    covered = {i + k for i, g in enumerate(windows) if g in twice for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)
    )


def test_ledger_measures_and_bits(docs, plain):
    book = quality.ledger(docs, carry=("source",))
    got = book.collect()
    want = sorted(key((i, *brute_measures(t))) for i, t, _ in plain)
    assert sorted(key((r.doc_id, *[r[m] for m in quality.MEASURES])) for r in got) == want
    for r in got:
        n = r.n_words
        bits = [n < 50, 100 * r.n_repeat_words > 50 * n, r.word_chars < 2 * n, r.word_chars > 20 * n,
                10 * r.n_symbols > n, r.n_dup_lines > 3 and 30 * r.n_dup_lines > n]
        assert r.failed == sum(1 << i for i, b in enumerate(bits) if b)


def test_policies_and_ablations(docs):
    book = quality.ledger(docs).persist()
    rows = book.collect()
    for r in quality.ablations(book, quality.STRICT).collect():
        bit = 1 << [x.name for x in quality.RULES].index(r.rule)
        mask = quality.mask_of(quality.STRICT)
        assert r.n_failed == sum(bool(x.failed & bit) for x in rows)
        assert r.n_kept_without == sum(not x.failed & mask & ~bit for x in rows)
    assert book.filter(quality.passes(quality.BASE)).count() == sum(not x.failed & 3 for x in rows)


# language model


def brute_hmm(model, classes):
    """Probability by summing over all state sequences."""
    k, total = len(model.start), 0.0
    for states in itertools.product(range(k), repeat=len(classes)):
        p = model.start[states[0]]
        for a, b in zip(states[:-1], states[1:]):
            p *= model.move[a, b]
        for s, c in zip(states, classes):
            p *= model.emit[s, c]
        total += p
    return math.log10(total)


def small_model(states=3, classes=5):
    rng = np.random.default_rng(2)

    def rows(*shape):
        x = rng.random(shape) + 0.05
        return x / x.sum(axis=-1, keepdims=True)

    return hmm.Model(rows(states), rows(states, states), rows(states, classes))


@pytest.mark.parametrize("most", [1, 2, 3, 1024])
def test_forward_is_the_sum_over_all_paths(most):
    model, rng = small_model(), np.random.default_rng(3)
    lengths = np.array([1, 6, 3, 7, 2])
    tokens = rng.integers(0, 5, lengths.sum())
    lanes = hmm.Lanes(lengths, most)
    total, _ = hmm.forward(model, lanes, model.emit.T[tokens[lanes.places()]], keep=False)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    for text in range(len(lengths)):
        assert total[text] == pytest.approx(brute_hmm(model, tokens[bounds[text] : bounds[text + 1]]))


def test_stretches_of_a_long_text_change_nothing():
    model, rng = small_model(), np.random.default_rng(5)
    lengths = np.array([4000, 1, 700, 2500])
    tokens = rng.integers(0, 5, lengths.sum())
    found = []
    for most in (100, 1 << 20):
        lanes = hmm.Lanes(lengths, most)
        token = tokens[lanes.places()]
        gamma, moves, starts, total = hmm.expected(model, lanes, model.emit.T[token])
        by_place = np.empty_like(gamma)
        by_place[lanes.places()] = gamma
        found.append((by_place, moves, starts, total))
    for one, two in zip(*found):
        assert np.allclose(one, two, rtol=1e-9)


@pytest.mark.parametrize("most", [2, 1024])
def test_expected_counts_sum_and_training_gains(most):
    rng = np.random.default_rng(4)
    lengths = np.array([5, 9, 1, 7])
    tokens = rng.integers(0, 5, lengths.sum())
    lanes, model, seen = hmm.Lanes(lengths, most), small_model(), []
    token = tokens[lanes.places()]
    for _ in range(8):
        gamma, moves, starts, total = hmm.expected(model, lanes, model.emit.T[token])
        seen.append(total)
        assert np.allclose(gamma.sum(axis=1), 1) and moves.sum() == pytest.approx(lengths.sum() - len(lengths))
        assert starts.sum() == pytest.approx(len(lengths))
        emit = np.stack([np.bincount(token, gamma[:, k], 5) for k in range(3)]) + 1e-12
        model = hmm.Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))
    assert all(b >= a - 1e-9 for a, b in zip(seen, seen[1:])) and seen[-1] > seen[0]


def test_scores_are_the_models_probabilities(spark):
    rng, rules = random.Random(8), hmm.HmmRules(states=2, classes=16, anchors=8, context=4)
    rows = [(i, " ".join(rng.choice(["ab", "cd", "Xab", "q", "über", "cd."]) for _ in range(rng.randint(0, 5)))) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = hmm.train(table.filter(hmm.is_training(F.col("doc_id"))), rules)
    train = [folded(t).split() for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    count = collections.Counter(w for ws in train for w in ws)
    class_of = {w: int(hmm.class_of(pa.array([w]), rules.classes)[0]) for _, t in rows for w in folded(t).split()}
    total, types = collections.Counter(), collections.Counter()
    for w, n in count.items():
        total[class_of[w]] += n
        types[class_of[w]] += 1
    for r in hmm.score(table, rules).collect():
        ws = folded(dict(rows)[r.doc_id]).split()
        inside = sum(math.log10((count[w] + 0.5) / (total[class_of[w]] + 0.5 * (types[class_of[w]] + 1))) for w in ws)
        assert r.score == pytest.approx(brute_hmm(model, [class_of[w] for w in ws] + [hmm.END]) + inside, rel=1e-9)


def test_scores(docs, plain):
    rules = hmm.HmmRules(states=3, classes=64, anchors=16, context=4)
    got = hmm.score(docs, rules).collect()
    end = object()
    token = [(i, folded(t).encode().split() + [end]) for i, t, _ in plain]
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i, _ in token}
    count = collections.Counter(w for i, ws in token if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted(
        key((i, held[i], len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)))
        for i, ws in token
    )
    assert sorted(key((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_scores_beat_the_unigram_on_held_out_text(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r for r in hmm.score(table).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


# licences


def test_licences(spark):
    mit = licences.TEMPLATES["MIT-text"]
    rows = [
        (1, "Some text.\nReleased under the MIT License.\nMore text."),
        (2, "This work is licensed under the GNU General Public License, version 3."),
        (3, mit.replace(" ", "\n", 3).upper()),
        (4, "A word.\n\n" + mit + "\n\nAnother."),
        (5, "released, under: the mit-licence?"),
        (6, None), (7, ""), (None, "Licensed under CC BY 4.0"), (8, "the license of the work " * 3000),
    ]
    got = {r.doc_id: r for r in licences.licence_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i].licence for i in (1, 2, 3, 4, 5, 6, 7, None, 8)] == [
        "MIT", "GPL-3.0", "MIT-text", "MIT-text", None, None, None, "CC-BY-4.0", None
    ]
    assert got[1].dice == 1.0 and got[6].n_matches == 0 and got[None].dice == 1.0


def test_notices_inside_lines_and_paragraphs(spark):
    bsd, header = licences.TEMPLATES["BSD-text"], licences.TEMPLATES["GPL-3.0-header"]
    rows = [
        (1, "Foo bar baz. Released under the MIT License."),
        (2, "Copyright somebody.\n" + bsd.replace("forms, ", "forms,\n * ").replace("provided", "provided\n *") + " 1. Keep this."),
        (3, "/* SPDX-License-Identifier: MPL-2.0 */ int x;"),
        (4, "before " * 40 + header.replace("either", "under\neither") + " after" * 40),
        (5, "Before. " + header.replace("version 3", "version 2") + " After."),
        (6, "released under the sea, the MIT building is licensed"),
        (7, "see " * 30 + "Licensed under CC BY 4.0 " * 50),
        (8, None),
    ]
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id bigint, text string, dice int").repartition(2)
    got = {r.doc_id: r for r in licences.licence_scan(frame.unionByName(frame)).collect()}
    want = ["MIT", "BSD-text", "SPDX-MPL-2.0", "GPL-3.0-header", "GPL-2.0-header", None, "CC-BY-4.0", None]
    assert [got[i].licence for i in range(1, 9)] == want
    assert got[7].n_matches >= 50 and licences.licence_scan(frame).columns == ["doc_id", "licence", "dice", "n_matches"]


# all of them


@pytest.mark.parametrize(
    "run",
    [
        packing.pack, mixing.mix, exact.exact_groups, spans.remove_repeats, simhash.near_groups, quality.ledger,
        hmm.score, licences.licence_scan,
    ],
)
def test_empty_table(none, run):
    assert run(none).collect() == []


def test_pieces_and_words():
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", None, "", "c" * 50, " d "])], ["text"])
    parts = list(pieces([batch], "text", 10))
    assert sum(p.num_rows for p in parts) == 5 and len(parts) > 1
    for p in (batch, *parts):
        found, counts = words_of(p.column("text"))
        assert counts.tolist() == [len(words(t)) for t in p.column("text").to_pylist()] and len(found) == counts.sum()


def test_marked_ranks_merge_every_token_as_the_vocabulary_does(tokenizer):
    model = json.loads(tokenizer.to_str())["model"]
    ranks, ids, ends = wordpiece.marked_ranks(model)
    assert len(ranks) == 512 + len(model["merges"]) == len(ids)  # no token has two merges
    order = list(ranks)
    value = {c: bytes([b]) for b, c in enumerate(wordpiece.byte_alphabet())}

    def marked(token):
        text = token.removesuffix("</w>")
        return b"".join(map(value.__getitem__, text)) + b"\x01" * (text != token)

    for rank, merge in enumerate(model["merges"], 512):
        first, second = map(marked, merge.split(" ") if isinstance(merge, str) else merge)
        token = first + second
        parts = [token[i : i + 1] for i in range(len(token))]
        while True:
            best, at = min(((ranks.get(a + b, rank), i) for i, (a, b) in enumerate(itertools.pairwise(parts))), default=(rank, 0))
            if best >= rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        assert ranks[token] == rank and parts == [first, second]
        assert order[rank] == token and ends[rank] == token.endswith(b"\x01")


def test_colliding_texts_of_one_id_are_told_apart(spark):
    rng = random.Random(12)
    shared = [rng.choice("abcdef") for _ in range(24)]
    rows = [(None, " ".join([*shared, f"x{i}"])) for i in range(6)] + [(3, " ".join(["y", *shared]))] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert sorted(r.n_removed for r in spans.remove_repeats(frame).collect()) == [0] + [24] * 7
    keyed = frame.select(F.coalesce("doc_id", F.lit(spans.NO_ID)).alias("key"), "text")
    # a hash that puts all texts of a key together is not used
    tie = spans.tie_of(keyed, lambda salt: F.xxhash64("text") if salt == 2 else F.lit(salt))
    assert keyed.select("key", tie.alias("tie")).distinct().count() == 7
    assert keyed.filter("key = 3").limit(1).select(spans.tie_of(keyed.filter("key = 3").limit(1)).alias("t")).first().t == 0
