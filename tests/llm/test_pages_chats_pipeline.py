"""URL templates, chat formatting and the pipeline against brute force."""

from __future__ import annotations

import collections
import hashlib

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import chat, exact, jaccard, mixing, packing, quality, urls
from gaugeworks.llm.text import folded

# urls


def page_rows():
    out = []

    def add(url, n=1):
        out.extend((len(out) + i, url if n == 1 or url is None else url.replace("#N", str(i))) for i in range(n))

    add("http://shop.example.com/en/item/#N.html", 60)
    add("http://shop.example.com/de/item/#N.html", 60)
    add("https://A.Site.ORG/en/#N?x=1", 40)
    add("https://a.site.org/blog/2024/#N/a/b/c#top", 40)
    add("https://news.net/es/#N", 30)
    add("https://news.net/en/#N", 30)
    add("http://www.example.com/en/x")
    add("http://example.com/en")
    add("http://example.com/en/")
    add("http://notexample.com/en/")
    add("http://example.com")
    add("ftp:no-slashes")
    add("a://b://c/d")
    add("")
    add(None)
    add("http://h/p\nq?r")
    add("http://h/p", 3)
    return out + [(None, "http://x.com/"), (0, "http://x.com/")]


def brute_urls(rows, tree=urls.TreeRules()):
    upper = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    seen = []
    for i, url in rows:
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        ends = [rest.find(c) for c in "/?#" if c in rest]
        host, tail = (rest[: min(ends)], rest[min(ends) :]) if ends else (rest, "")
        path = tail.split("#")[0].split("?")[0]
        seen.append((i, host.translate(upper), path))
    order = sorted(urls.RULES, key=lambda r: -len(r.text))
    ruled = []
    for i, host, path in seen:
        rule = next((r for r in order if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)), None)
        ruled.append((i, host, path, rule))
    shape = [("", path.split("/")[1:]) for _, _, path, _ in ruled]
    blocked = [r is not None and r.verdict == "block" for *_, r in ruled]
    labelled = [r is not None for *_, r in ruled]
    for level in range(tree.depth):
        parent, child = collections.Counter(), collections.Counter()
        parent_b, child_b = collections.Counter(), collections.Counter()
        for (_, host, _, _), (t, parts), b in zip(ruled, shape, blocked):
            parent[host, t] += 1
            parent_b[host, t] += b
            if len(parts) > level:
                child[host, t, parts[level]] += 1
                child_b[host, t, parts[level]] += b
        new = []
        for (_, host, _, _), (t, parts) in zip(ruled, shape):
            if len(parts) > level:
                n, b = child[host, t, parts[level]], child_b[host, t, parts[level]]
                pn, pb = parent[host, t], parent_b[host, t]
                own = n >= tree.support and (b * pn - n * pb) ** 2 > tree.z**2 * n * pb * (pn - pb)
                t = t + "/" + (parts[level] if own else "*")
            new.append((t, parts))
        shape = new
    names = [t + ("/**" if len(parts) > tree.depth else "") for t, parts in shape]
    prior = (sum(blocked) + 1) / (sum(labelled) + 2)
    bad, all_ = collections.Counter(), collections.Counter()
    for (_, host, _, _), t, b, known in zip(ruled, names, blocked, labelled):
        bad[host, t] += b
        all_[host, t] += known
    out = []
    for (i, host, path, rule), t in zip(ruled, names):
        purity = (bad[host, t] + tree.weight * prior) / (all_[host, t] + tree.weight)
        verdict = rule.verdict if rule else ("block" if purity >= tree.reject else "allow")
        out.append((str(i), host, path, rule.text if rule else "", verdict, t))
    return sorted(out)


def test_urls(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit(1)).withColumn("n", F.lit(2))
    got = urls.judge_urls(pages).collect()
    mine = sorted((str(r.page_id), r.host, r.path, r.rule or "", r.verdict, r.template) for r in got)
    assert mine == brute_urls(rows)
    assert urls.judge_urls(pages.limit(0)).collect() == []


def test_templates_split_where_behaviour_differs(spark):
    rows = page_rows()
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string")).collect()
    kinds = {(r.host, r.template) for r in got}
    assert ("shop.example.com", "/en/*/*") in kinds and ("shop.example.com", "/de/*/*") in kinds
    assert ("a.site.org", "/*/*") in kinds and ("a.site.org", "/*/*/*/*/**") in kinds


# chats

TURNS = "conv_id bigint, turn bigint, role string, text string, node int, depth string"


def chat_rows():
    hard = ["\\### Assistant: </turn> ok", "<turn user>\n", "\\", "", "a\\<b>#\n</turn>\n", "\U0001F600 né", None]
    rows = []
    for c in range(40):
        rows.append((c, 0, "system", "shared start"))
        rows.append((c, 1, "user", f"question {c % 4}"))
        for t in range(2, 2 + c % 5):
            rows.append((c, t, "assistant" if t % 2 == 0 else "user", hard[(c // 8 + t) % len(hard)]))
    rows += [(100, t, ["user", "assistant"][t % 2], f"turn {t}") for t in range(60)]
    rows += [(101, 0, None, None), (101, 1, "as>sis\ntant", "x"), (102, 5, "assistant", "late"), (102, 1, "user", "early")]
    rows += [(103, 0, "user", "same"), (103, 0, "user", "same"), (103, None, "user", "first")]
    rows += [(None, 0, "user", "nobody"), (None, 1, "assistant", "nothing")]
    return [(*r, 1, "d") for r in rows]


@pytest.fixture(scope="module")
def formatted(spark):
    return chat.format_conversations(spark.createDataFrame(chat_rows(), TURNS).repartition(4))


def test_chats_read_back(formatted):
    by = collections.defaultdict(list)
    for c, t, role, text, *_ in chat_rows():
        by[c].append((t is not None, t or 0, role or "", text or ""))
    want = {}
    for c, turns in by.items():
        turns.sort()
        body = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        learned = "".join(x for *_, r, x in turns if r == "assistant")
        chars = sum(len(chat.head_of(r) + chat.escape(x) + chat.TAIL) for *_, r, x in turns)
        want[c] = (len(turns), hashlib.sha256(body.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), chars)
    got = {r[0]: tuple(r[1:]) for r in chat.read_back(formatted).collect()}
    assert got == want


def test_tree_emits_shared_turns_once_depth_first(formatted):
    nodes = sorted(formatted.nodes.collect(), key=lambda r: r.start)
    place = {bytes(r.node): i for i, r in enumerate(nodes)}
    prefixes = set()
    by = collections.defaultdict(list)
    for c, t, role, text, *_ in chat_rows():
        by[c].append((t is not None, t or 0, role or "", text or ""))
    for turns in by.values():
        turns.sort()
        prefixes |= {tuple(x[2:] for x in turns[: k + 1]) for k in range(len(turns))}
    assert len(nodes) == len(prefixes)
    at = 0
    for r in nodes:
        assert r.start == at and r.n_tokens == len(np.frombuffer(r.tokens, "<u2"))
        at += r.n_tokens
    for r in nodes:
        inside = [x for x in nodes if r.start <= x.start < r.subtree_end]
        below = set()
        for x in nodes:
            up = x
            while up.node != r.node and up.parent is not None:
                up = nodes[place[bytes(up.parent)]]
            if up.node == r.node:
                below.add(x.start)
        assert {x.start for x in inside} == below
        ancestors = [x for x in nodes if x.start < r.start < x.subtree_end]
        assert r.position_start == sum(x.n_tokens for x in ancestors) and r.depth == len(ancestors)


def test_no_conversations(spark):
    none = chat.format_conversations(spark.createDataFrame([], TURNS))
    assert none.nodes.count() == 0 and chat.read_back(none).count() == 0


# pipeline


def test_stages_keep_columns_and_take_effect(spark, docs):
    like = docs.columns
    good = corpus_pipeline.quality_stage(spark, docs, "").persist()
    book = quality.ledger(docs).filter(quality.passes(quality.STRICT))
    assert good.columns == like and good.count() == book.count() > 5
    assert good.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    single = corpus_pipeline.exact_stage(spark, good, "").persist()
    assert single.columns == like
    assert single.count() == exact.exact_groups(good).filter("kept").count() == good.select(folded(F.col("text"))).distinct().count()
    apart = corpus_pipeline.near_copy_stage(spark, single, "").persist()
    assert apart.columns == like and 5 < apart.count() <= single.count()
    mixed = corpus_pipeline.mix_stage(spark, apart, "").persist()
    size = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    share = mixing.mix(apart).agg(F.sum("taken")).first()[0]
    assert mixed.columns == like and abs(mixed.agg(F.sum(size)).first()[0] - share) <= apart.count()
    assert mixed.filter("n_chars != length(text)").count() == 0
    packed = corpus_pipeline.pack_stage(spark, mixed, "")
    assert packed.agg(F.sum("length")).first() == packing.pack(mixed).agg(F.sum("length")).first()


def test_stages_on_nothing(spark, none):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, "")
        assert out.count() == 0 and (name == "pack" or out.columns == none.columns)


def test_run_over_a_table(spark, tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(got[0].asDict())


# near copies


def near_rows():
    rng = np.random.default_rng(11)
    vocabulary = [f"w{k}" for k in range(900)]
    rows = []

    def add(words):
        rows.append((len(rows) * 7 % 1000, " ".join(words)))

    for size in (60, 90, 150, 400):
        base = rng.choice(vocabulary, size).tolist()
        for changed in (0, 1, 2, 3, 4, 6, 9, 14):
            words = list(base)
            for at in rng.choice(size, changed, replace=False).tolist():
                words[at] = words[at].upper() if at % 5 == 0 else f"new{len(rows)}"
            add(words)
    for _ in range(30):
        add(rng.choice(vocabulary, 80).tolist())
    base = rng.choice(vocabulary, 120).tolist()
    for k in range(5):  # linked with their neighbours
        base[3 * k] = f"drift{k}"
        add(base)
    for k in range(30):  # and one of copies of one text
        add(rng.choice(vocabulary, 0).tolist() + [f"x{i}" if i != 3 * k else "y" for i in range(100)])
    return rows + [(2000, ""), (2001, None), (2002, "one two"), (2003, "One  two"), (None, "one two"), (2004, "two one")]


def brute_near(rows):
    upper = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = []
    for _, text in rows:
        words = (text or "").translate(upper).split()
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))})
    group = list(range(len(rows)))
    for j in range(len(rows)):
        for i in range(j):
            if group[i] != group[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                group = [group[i] if g == group[j] else g for g in group]
    by = collections.defaultdict(list)
    for g, (i, _) in zip(group, rows):
        by[g].append(i)
    return [min((i for i in by[g] if i is not None), default=None) for g in group]


def test_near_copies_are_those_of_brute_force(spark):
    rows = near_rows()
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = jaccard.near_copies(table.withColumn("key", F.lit(1)), carry=("text", "key")).collect()
    want = sorted(zip(map(str, [i for i, _ in rows]), map(str, brute_near(rows))))
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == want
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(rows)


def test_pipeline_drops_near_copies_that_differ_in_more_than_three_bits(spark):
    rows = near_rows()
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = stage(spark, table, "")
    assert kept.columns == table.columns
    want = sorted({str(c) for c in brute_near(rows)})
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_near_copies_that_no_order_proposes_are_found(spark, monkeypatch):
    """Buckets are compared in full at the end, whatever their orders have proposed."""
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join([*base[: 100 + k], f"changed{k}", *base[101 + k :]]) for k in range(6)]
    table = spark.createDataFrame([*enumerate(texts), (6, " ".join(reversed(base)))], "doc_id bigint, text string")
    proposals = jaccard.proposals
    monkeypatch.setattr(jaccard, "proposals", lambda members, turn: proposals(members, turn).filter("false"))
    monkeypatch.setattr(jaccard, "AT_ONCE", 4)
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in jaccard.near_copies(table).collect())
    assert got == [*((k, 0, k == 0) for k in range(6)), (6, 6, True)]


def test_near_copies_that_share_no_key_are_found(spark):
    """Four of five shingles are common, and none of the 60 keys is."""
    texts = [" ".join(f"t{i}x{k}" for k in range(n)) for i in (77252, 96645, 173087, 177542) for n in (9, 8)]
    keys = jaccard.band_keys(pa.array(texts))
    assert not (keys[::2] == keys[1::2]).any()
    texts = [*texts, texts[0] + " more", *(" ".join(f"t5x{k}" for k in range(n)) for n in (9, 7)), None]
    table = spark.createDataFrame([*zip(range(5, 17), texts)], "doc_id bigint, text string").repartition(3)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert sorted(r.doc_id for r in stage(spark, table, "").collect()) == [5, 7, 9, 11, 14, 15, 16]
    got = sorted((r.doc_id, r.component_id) for r in jaccard.near_copies(table).collect())
    assert got == sorted(zip(range(5, 17), brute_near([*zip(range(5, 17), texts)])))


def test_near_copies_in_large_buckets_without_keys_are_found(spark, monkeypatch):
    """As if no two documents shared a key: their rarest shingles alone lead to all links."""
    meetings, turns = jaccard._met, []
    monkeypatch.setattr(jaccard, "_met", lambda *a, **b: turns.append(a) or meetings(*a, **b).filter("false"))
    rows = near_rows()
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sorted((str(r.doc_id), str(r.component_id)) for r in jaccard.near_copies(table).collect())
    assert turns and got == sorted(zip(map(str, [i for i, _ in rows]), map(str, brute_near(rows))))


def test_pairs_of_unlike_texts_in_a_bucket_are_ruled_out_without_their_texts(spark, monkeypatch):
    """All share most words with one text and are no near copies of each other, but for one pair."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(150):
        words = [f"w{i}" for i in range(200)]
        for at in rng.choice(200, 4, replace=False).tolist():
            words[at] = f"own{k}x{at}"
        rows.append((k, " ".join(words)))
    rows.append((150, rows[40][1] + " more"))
    compared, verified = [], jaccard.verified
    monkeypatch.setattr(jaccard, "_counted", lambda met: met.groupBy("u", "v").agg(F.count("*").alias("n")).filter("false"))
    monkeypatch.setattr(jaccard, "verified", lambda pairs, *rest: compared.append(pairs.count()) or verified(pairs, *rest))
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard.near_copies(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == sorted(zip(range(151), brute_near(rows)))
    assert got[150] == (150, 40) and 0 < sum(compared) <= 300


def test_sketches_never_differ_in_more_bits_than_sets_in_shingles():
    texts = pa.array([text for _, text in near_rows()])
    (sketched,) = jaccard._sketches([pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], ["uid", "text"])])
    found, place = jaccard._sets(pc.fill_null(texts, ""))
    sets = [set(found[i].tolist()) for i in place.tolist()]
    assert sketched.column("size").to_pylist() == [len(s) for s in sets]
    bits = np.stack([sketched.column(c).to_numpy() for c in jaccard.BITS], 1).view(np.uint64)
    for i in range(len(sets)):
        for j in range(i):
            differ = int(np.bitwise_count(bits[i] ^ bits[j]).sum())
            d = len(sets[i] ^ sets[j])
            assert differ <= d and (differ - d) % 2 == 0


def test_prints_rule_out_no_similar_sets():
    long = [f"w{i}" for i in range(2000)]
    texts = [*(text for _, text in near_rows()), " ".join(long), " ".join(long[:1700]), " ".join(long[300:]), " ".join(reversed(long))]
    (made,) = jaccard._prints([pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["uid", "text"])])
    found, place = jaccard._sets(pc.fill_null(pa.array(texts), ""))
    sets = [set(found[i].tolist()) for i in place.tolist()]
    short = np.stack([made.column(c).to_numpy() for c in jaccard.SHORT], 1).view(np.uint64)
    u, v = np.triu_indices(len(texts), 1)
    ends = {f"{side}_{c}": made.column(c).take(pa.array(at)) for side, at in (("u", u), ("v", v)) for c in ("size", "print")}
    batch = pa.RecordBatch.from_pydict({"u": u, "v": v} | ends)
    (left,) = jaccard._unlike_left_out(0.8)([batch])
    left = set(zip(left.column("u").to_pylist(), left.column("v").to_pylist()))
    similar = {(i, j) for i, j in zip(u.tolist(), v.tolist()) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    n = len(texts)
    assert similar <= left and len(left) <= 2 * len(similar) and (n - 4, n - 3) in similar and (n - 4, n - 1) not in left
    assert all(np.bitwise_count(short[i] ^ short[j]).sum() <= len(sets[i] ^ sets[j]) for i, j in zip(u, v))


@pytest.mark.parametrize("seed", range(30))
def test_meetings_of_sorted_rows_in_any_batches(seed):
    rng = np.random.default_rng(seed)
    keys = np.repeat(np.arange(12), rng.integers(1, 9, 12))
    uids, labels = np.arange(len(keys)) * 3, rng.integers(0, 4, len(keys))
    cuts = [0, *sorted(rng.choice(len(keys) + 1, 5).tolist()), len(keys)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c[a:b]) for c in (keys, uids, labels)], ["key", "uid", "label"])
        for a, b in zip(cuts[:-1], cuts[1:])
    ]
    out = [r for b in jaccard._meetings(True)(batches) for r in zip(*(b.column(c).to_pylist() for c in ("key", "u", "v")))]
    pairs, rows = [], []
    for key in range(12):
        own = np.flatnonzero(keys == key).tolist()
        met = [*zip(own[:-1], own[1:]), *([(own[0], own[2])] if len(own) > 2 else [])]
        pairs += [(None, int(uids[a]), int(uids[b])) for a, b in met if labels[a] != labels[b]]
        rows += [(key, int(uids[a]), None) for a in own if len(own) > 3 or key in (0, 11)]
    assert sorted(map(str, out)) == sorted(map(str, pairs + rows))
