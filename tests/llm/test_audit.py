"""Merkle manifest, token counts and periodic runs against plain Python."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from gaugeworks.llm import counts, manifest, runs
from gaugeworks.llm.queries import QUERIES
from gaugeworks.llm.text import folded as folded_column

UPPER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest int, tree int, rank int, _now int, uid int"
CLASH = (1, 2, 3, 4, 5)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


# Merkle manifest


def leaf_of(doc_id, source, lang, n_chars, text):
    parts = [None if v is None else str(v).encode() for v in (doc_id, source, lang, n_chars, text)]
    return sha(b"".join(b"-" if p is None else b"%d:%s" % (len(p), p) for p in parts))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def walked(levels, place, value):
    """Siblings on the way up, and what the value becomes."""
    others = []
    for level in levels[:-1]:
        first = place // 8 * 8
        run = level[first : first + 8]
        others += run[: place - first] + run[place - first + 1 :]
        value = sha("".join([*run[: place - first], value, *run[place - first + 1 :]]))
        place //= 8
    return others, value


def brute_manifest(rows):
    """Rows (doc_id, text, lang, source, n_chars); every third id by its checksum is tampered with."""
    groups = collections.defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        now = text
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
            now = text.translate(UPPER)
        leaf, found = (leaf_of(doc_id, source, lang, n_chars, t) for t in (text, now))
        groups[lang].append(((doc_id is not None, doc_id or 0), leaf, found, doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for lang in order:
        groups[lang].sort(key=lambda r: r[:2])
        trees.append(levels_of([r[1] for r in groups[lang]]))
    crown = levels_of([t[-1][0] for t in trees]) if trees else [[None]]
    root, out = crown[-1][0], []
    for g, lang in enumerate(order):
        for place, (_, leaf, found, doc_id) in enumerate(groups[lang]):
            low, value = walked(trees[g], place, found)
            high, value = walked(crown, g, value)
            out.append((doc_id, leaf, trees[g][-1][0], root, sha("".join(low + high)), value, value == root))
    return collections.Counter(out)


def manifest_of(frame, **more):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return manifest.manifest(frame, F.when(tampered, folded_column(F.col("text"))).otherwise(F.col("text")), **more)


def many(langs, each, seed=1):
    rng = random.Random(seed)
    out = []
    for g, lang in enumerate(langs):
        for i in range(each[g % len(each)]):
            out.append((10_000 * g + i if rng.random() > 0.01 else None, rng.choice(["Ab", "c", None, "", "É Z"]), lang, rng.choice(["s", None]), i, *CLASH))
    return out


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(5, "Aa", "en", "s", 2, *CLASH)],
        many([None, "", "b", "a", "é", "B"], [1, 7, 8, 9, 65, 3]),
        many(["en", None], [1500, 513]),  # several blocks a tree
        many([f"l{i}" for i in range(521)] + [None], [1, 2, 9]),  # several blocks of subroots
        [(3, "A", "x", None, None, *CLASH)] * 20,
    ],
)
def test_manifest_equals_brute_force(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = manifest_of(frame)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert collections.Counter(map(tuple, got.collect())) == brute_manifest([r[:5] for r in rows])


def test_manifest_of_awkward_rows(docs):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    assert collections.Counter(map(tuple, manifest_of(docs).collect())) == brute_manifest(rows)


def test_proofs_lead_to_the_root_and_a_changed_row_does_not(spark):
    rows = many(["a", "b", "c"], [600, 20, 1])
    got = manifest_of(spark.createDataFrame(rows, SCHEMA), with_proof=True).collect()
    changed = 0
    for r in got:
        value, others = r.leaf, ""
        for position, siblings in r.proof:
            others += "".join(siblings)
            value = sha("".join([*siblings[:position], value, *siblings[position:]]))
        assert value == r.root and r.proof_sha256 == sha(others)
        changed += not r.verified
    assert 0 < changed < len(got)
    assert all(r.verified for r in manifest.manifest(spark.createDataFrame(rows, SCHEMA)).collect())


def test_queue_holds_few_messages():
    nodes = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(512)]
    for n in (1, 2, 8, 9, 64, 65, 511, 512):
        block = manifest.Block(n, manifest.height(n))
        assert block.forward(nodes[:n], keep=True).hex() == levels_of([x.hex() for x in nodes[:n]])[-1][0]
        assert [leaf for leaf, *_ in block.backward(b"", b"")] == list(range(n))[::-1]


# token counts


@pytest.fixture(scope="module")
def pieces_model():
    return SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


SCRAPS = [
    "the ", "and", "  ", "\n", "\t", "x", "é", "中文字", "😀", "①", "▁", " ", "aaaa", "0123", "ing", "<s>", "</s>",
    "\x00", "ſ", "é", "<0x0A>", "　", "ﬁ", "-----", "....", "ЖЩ",
]


def test_spliced_chunks_count_like_whole_texts(pieces_model):
    vocab, rng = counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model")), random.Random(4)
    for turn in range(800):
        text = "".join(rng.choice(SCRAPS) for _ in range(rng.randint(1, 200)))
        if turn % 5 == 0:
            text = rng.choice("x -0") * rng.randint(1, 400) + text  # nothing stable for long
        rules = counts.ChunkRules(rng.choice([5, 20, 60]), rng.choice([1, 4, 16]))
        chunks = list(vocab.chunks(text, rules))
        assert sum(vocab.count_between(*c) for c in chunks) == len(pieces_model.encode(text)), (text, rules)
        assert "".join(c[head:tail] for head, tail, c in chunks) == text


def test_a_wrong_splice_is_noticed():
    vocab = counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    with pytest.raises(ValueError):
        vocab.count_between(0, 3, "hello world")


@pytest.mark.parametrize("rules", [counts.ChunkRules(), counts.ChunkRules(50, 8), counts.ChunkRules(1000, 1)])
def test_token_counts_of_awkward_rows(docs, none, pieces_model, plain, rules):
    got = counts.token_counts(docs, limit=100, rules=rules)
    want = collections.Counter()
    for doc_id, text, _ in plain:
        n = len(pieces_model.encode(text or ""))
        want[doc_id, len((text or "").encode()), n, n > 100] += 1
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert collections.Counter(map(tuple, got.collect())) == want
    assert counts.token_counts(none).collect() == []


def test_a_very_long_text_without_any_boundary(spark, pieces_model):
    texts = ["x" * 100_000, "中" * 70_000, " " * 70_000, "ab cd " * 30_000]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in counts.token_counts(frame).collect()}
    assert got == {i: len(pieces_model.encode(t)) for i, t in enumerate(texts)}


# periodic runs


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                part = w[i : j + q]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, w):
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *best, milli, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_of_codes_in_any_stretches():
    rng = random.Random(5)
    for _ in range(1500):
        w, letters = [], rng.choice([1, 2, 3, 5])
        while len(w) < rng.choice([0, 5, 30, 120]):
            w += [rng.randrange(letters) for _ in range(rng.randint(1, 9))] * rng.randint(1, 12)
        want = brute_runs(w)
        for stretch in (1, 7, 50, 1000):
            got = [(s, e - s, q) for s, e, q in runs.runs_of(np.array(w, np.int64), stretch)]
            assert got == want, (w, stretch)


def test_long_runs_are_caught_once():
    for period, n in ((1, 70_000), (7001, 70_000), (101, 50_000)):
        assert runs.runs_of(np.arange(n) % period) == [(0, n, period)]
    nested = np.tile(np.r_[np.zeros(100, np.int64), 1], 300)
    assert len(runs.runs_of(nested, 4096)) == 301


def periodic_rows():
    rng, out = random.Random(6), []
    for i in range(300):
        w = []
        while len(w) < rng.choice([3, 20, 200]):
            w += [rng.choice("ab") + rng.choice(["", "", "é"]) for _ in range(rng.randint(1, 9))] * rng.choice([1, 1, 3, 5, 9])
        out.append((i, rng.choice([" ", "\n", " \t "]).join(w)))
    return out


def test_periodic_runs_equal_brute_force(spark, docs, none, plain):
    rows = periodic_rows()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for some, source in ((rows, frame), ([p[:2] for p in plain], docs)):
        got = runs.periodic_runs(source)
        want = collections.Counter(brute_row(i, words(t)) for i, t in some)
        assert collections.Counter(map(tuple, got.collect())) == want
    assert runs.periodic_runs(none).collect() == []


def test_runs_and_collapsed_texts_are_returned(spark):
    frame = spark.createDataFrame([(1, "x " + "a b " * 5 + "c"), (2, None)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in runs.periodic_runs(frame, with_runs=True).collect()}
    assert [tuple(r) for r in got[1].runs] == [(1, 10, 2)] and got[1].collapsed == "x a b c"
    assert got[2].runs == [] and got[2].collapsed == ""


def test_the_query_plants_tails(spark, tmp_path):
    rows = periodic_rows() + [(None, "a " * 9), (1000, None), (-7, "a b c d e f " * 30)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = collections.Counter()
    for doc_id, text in rows:
        w = words(text)
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        g = h // 10
        if doc_id is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        want[brute_row(doc_id, w)] += 1
    assert collections.Counter(map(tuple, QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect())) == want
