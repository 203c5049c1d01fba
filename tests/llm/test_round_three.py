"""Exact dedup, prefix trie and filter audit against brute force, on the awkward cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from ontime.llm import (byte_bpe, chat, exact_dedup, filter_audit, langid, learn, near_dedup, packing, prefix_trie, quality_rules,
                        queries, topk, url_filter)
from ontime.llm import words as W

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

DOCS = "doc_id long, text string, lang string, id string, digest string, part int, mask string, n int, range int"


def docs(spark, rows):
    """Rows (doc_id, text, lang) with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", "y", 1, "m", 7, 0) for r in rows], DOCS)


def sample_rows(seed, n=300):
    r = random.Random(seed)
    texts = ["", " ", "a  b", "a b", "a\tb", "a b", "x" * 40_000, "x" * 40_000 + "y", "é é", "E" * 200, "$ " * 150,
             " ".join(f"w{k}" for k in range(120)), " ".join(f"w{k}" for k in range(121))]
    rows = [(k, r.choice(texts) if r.random() < 0.7 else "hot text", r.choice(["en", "fr", None])) for k in range(n)]
    r.shuffle(rows)
    return [*rows, (n, None, "en"), (n, None, "en"), (None, "hot text", "fr"), (None, None, None), (7, rows[0][1], "en")]


@pytest.mark.parametrize("counters", [1, 2, 5, 4096])
def test_exact_dedup_matches_brute_force(spark, counters):
    rows = sample_rows(counters)
    groups = defaultdict(list)
    for i, text, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    found = exact_dedup.mark(docs(spark, rows).repartition(7), counters=counters).collect()
    want = Counter()
    for plain, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        digest = hashlib.sha256(plain.encode()).hexdigest()
        want.update((i, ids[0], len(ids), k == 0, digest) for k, i in enumerate(ids))
    assert Counter(tuple(r) for r in found) == want
    assert found[0].asDict().keys() == {"doc_id", "keep_id", "group_size", "kept", "text_sha256"}


def test_misra_gries_keeps_every_frequent_digest():
    r = random.Random(3)
    heavy = [b"h%d" % k for k in range(4)]
    rows = [r.choice(heavy) if r.random() < 0.8 else b"%d" % r.randrange(10**9) for _ in range(20_000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[k:k + 700])], names=["d"]) for k in range(0, len(rows), 700)]
    out = pa.Table.from_batches(list(exact_dedup.misra_gries(9, iter(batches)))).to_pydict()
    true = Counter(rows)
    assert set(heavy) <= set(out["digest"]) and len(out["digest"]) <= 9
    for d, n in zip(out["digest"], out["n"], strict=True):
        assert true[d] - len(rows) / 10 <= n <= true[d]


def test_heavy_texts_are_found_and_settled_by_broadcast(spark):
    rows = docs(spark, [(k, "hot" if k % 3 else str(k), "en") for k in range(999)]).repartition(5)
    heavy = exact_dedup.frequent(exact_dedup.digests(rows, "doc_id", "text"), 4).collect()
    assert [bytes(r.digest) for r in heavy] == [hashlib.sha256(b"hot").digest()]


@pytest.mark.parametrize("op", [exact_dedup.mark, lambda d: filter_audit.failed_masks(d, queries.audit_filters(d.text))])
def test_empty_documents(spark, op):
    assert op(docs(spark, [])).collect() == []


def brute_masks(rows):
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, part in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 bool(re.search(r"[#$%&*|]", t)), i is not None and i > least[t])
        out.append((i, part or "", fails))
    return out


LABELS = [(k, k % 2, int(k % 5 == 0)) for k in range(0, 300, 3)] + [(3, 0, 1), (None, 1, 1), (6, None, None)]


@pytest.mark.parametrize("parts", [1, 9])
def test_filter_audit_matches_brute_force(spark, parts):
    rows = sample_rows(parts)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    d = docs(spark, rows).repartition(parts)
    got = {(r.part, r.filter_order, r.step): r.asDict() for r in
           filter_audit.audit(d, labels, queries.audit_filters(d.text)).collect()}
    good, toxic = ({x[0] for x in LABELS if x[0] is not None and x[k] == 1} for k in (1, 2))
    masks = brute_masks(rows)
    want = {}
    for part in {m[1] for m in masks}:
        own, shapley = [m for m in masks if m[1] == part], Counter()
        for order in permutations(range(5)):
            left, name = own, "".join("ABCDE"[k] for k in order)
            for step, k in enumerate(order):
                gone = [m for m in left if m[2][k]]
                left = [m for m in left if not m[2][k]]
                shapley[k] += len(gone)
                want[part, name, step + 1] = {
                    "kept": len(left), "removed": len(gone), "redundant": sum(m[2][k] for m in own) - len(gone),
                    "unique_fails": sum(m[2][k] and sum(m[2]) == 1 for m in own), "k": k,
                    "good_lost": sum(m[0] in good for m in gone), "toxic_lost": sum(m[0] in toxic for m in gone)}
        for key, row in want.items():
            if key[0] == part:
                row["shapley"] = shapley[row.pop("k")]
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert {c: got[key][c] for c in row} == row, key


def test_trie_and_ranges():
    r = random.Random(1)
    texts = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 12))) for _ in range(500)] + [b"p" * 2000 + bytes([k]) for k in range(200)]
    trie, least = filter_audit.Trie(), {}
    ends = [trie.insert(t, k) for k, t in reversed(list(enumerate(texts)))][::-1]
    for k, t in enumerate(texts):
        least.setdefault(t, k)
    assert [e.least for e in ends] == [least[t] for t in texts]
    ranges = filter_audit.make_ranges([t[:filter_audit.PREFIX_BYTES] for t in texts], 16)
    place = [ranges.of(t) for t in texts]
    assert max(place) < ranges.count <= 40
    assert max(Counter(place).values()) < 150  # the texts with one long opening are dealt by hash
    cold = sorted(t for t in set(texts) if len(t) < 1000 and t not in ranges.hot)
    assert [ranges.of(t) for t in cold] == sorted(ranges.of(t) for t in cold)
    assert filter_audit.make_ranges([], 4).of(b"any") == 0


TURNS = "conv_id long, turn long, role string, text string, place int, a int, depth int"


def brute_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    members = defaultdict(set)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
    out = set()
    for node, who in members.items():
        tree = [n for n in members if n[:len(node)] == node]
        kids = [n for n in tree if len(n) == len(node) + 1]
        leaves = sum(not any(m[:len(n)] == n and len(m) > len(n) for m in tree) for n in tree)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in tree if n)
        ends = ",".join(map(str, sorted(c for c in who if len(built[c]) == len(node))))
        out.add((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids), leaves, saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations(seed):
    r = random.Random(seed)
    said = [("user", "hi"), ("user", None), (None, "é🙂"), ("assistant", "ok"), ("", "hi"), ("us", "erhi")]
    rows = [(c, t, *r.choice(said)) for c in [0, 1, 2, 5, 99, 100, 101, 102, 250, 251, 300, -1, -105, *range(400, 460)]
            for t in range(r.randint(1, 7))]
    rows += [(3, None, "user", "first"), (3, 0, "user", "b"), (3, 0, "user", "a"), (None, 0, "user", "lost"), (1, 0, "user", "hi")]
    rows += [(c, t, "user", "hi") for c in range(500, 540) for t in range(3)] + [(600, t, "user", "long" * 50) for t in range(60)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [None, 1, 4, 30])
def test_prefix_trie_matches_brute_force(spark, limit):
    rows = conversations(limit or 0)
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURNS).repartition(5)
    found = [tuple(r) for r in prefix_trie.prefix_trie(prefix_trie.shared_openings(table), limit).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute_trie(rows)


def test_prefix_trie_of_nothing(spark):
    table = spark.createDataFrame([], TURNS)
    assert prefix_trie.prefix_trie(prefix_trie.shared_openings(table)).collect() == []


def test_slots_are_minimal_and_verified():
    r = np.random.default_rng(5)
    a, b = r.integers(-2**63, 2**63 - 1, (2, 5000))
    slots = prefix_trie.Slots(a, b)
    assert sorted(slots.find(a, b)) == list(range(5000))
    assert (slots.find(a, b + 1) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.Slots(np.array([1, 1]), np.array([2, 2]))
    assert len(prefix_trie.Slots(a[:0], b[:0]).find(a[:0], b[:0])) == 0


def thue_morse(n):
    s = "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return s


def test_complementary_words_are_told_apart(spark):
    """Words that collide under every polynomial hash modulo 2**64: right ids, sets and repeat counts."""
    one = thue_morse(2048)
    other = one.translate(str.maketrans("ab", "ba"))
    texts = [f"{one} {other}", f"{other} {one}", f"{one} {one}", one, other, f"{one}\n{other}"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    codec = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    for r in byte_bpe.round_trip(table, RANKS, public_tokenizers.PATTERN).collect():
        assert r.ids == plain.encode_ordinary(texts[r.doc_id])
    kept = {r.doc_id: r.kept for r in near_dedup.near_duplicates(table).collect()}
    assert kept == {0: True, 1: True, 2: True, 3: True, 4: True, 5: False}  # 5 has the words of 0
    rules = {r.doc_id: r for r in quality_rules.apply(table).collect()}
    assert [rules[k].n_dup_lines for k in range(6)] == [0] * 6


def test_cache_never_gives_another_words_ids():
    """Even if every hash is the same."""
    class Same(W.Texts):
        def hashes(self, starts, ends):
            return np.zeros(len(starts), np.uint64)

    cache = W.IdCache(lambda words: (np.array([len(w) for w in words], "<u4"), np.ones(len(words), np.int64)), 100)
    for text in ("one", "three four", "four three", "one"):
        x = next(W.slices(pa.array([text])))
        x = Same(x.data, x.offsets, 0)
        assert cache.lookup(x, *x.spans(W.NOT_SPACE[x.data]))[0].tolist() == [len(w) for w in text.split()]


@pytest.mark.parametrize("text", ["ab" * 500_000, "".join(random.Random(2).choices("acgt", k=300_000)), "=-" * 200_000, "日本" * 50_000])
def test_long_runs_equal_tiktoken(text):
    codec = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    ids, begins = codec.encode(next(W.slices(pa.array([text]))))
    assert ids.tolist() == plain.encode_ordinary(text) and begins.tolist() == [0, len(ids)]


def test_loss_is_read_by_place(spark):
    """Spans that point elsewhere give another text, so the digest is of what the mask covers."""
    rows = [(1, 0, "user", "ask", "x"), (1, 1, "assistant", "said & done", "y")]
    turns = spark.createDataFrame(rows, "conv long, turn long, role string, text string, tree string")
    nodes = chat.reply_chain(turns, "conv", ["turn"])
    made = chat.format_paths(chat.best_paths(nodes.select("tree", "node", "parent", "score")), nodes)
    moved = F.transform("loss", lambda s: F.struct((s["start"] - 2).alias("start"), s["end"].alias("end")))
    r = made.select(chat.loss_text(F.col("formatted"), F.col("loss")).alias("a"), chat.loss_text(F.col("formatted"), moved).alias("b")).first()
    assert r.a == "said & done" and r.b != r.a


def test_top_k_repeated_ids_huge_components_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.5, 0.25]), (3, [9.0, 9.0]), (4, [0.0, 1.0])]
    v = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, e array<double>, id int, rank int")
    v = v.select("vec_id", topk.quantize(F.col("e")).alias("vector"))
    got = topk.top_k(v, v, 2).collect()
    assert len(got) == 10 and len({(r.query_id, r.vec_id) for r in got}) == 10
    top, low = 2**63 - 1, -(2**63)
    q = {0: [256, 512], 1: [top, 0], 2: [low, 256], 3: [128, 64], 4: [0, 256]}
    for k, x in q.items():
        every = sorted((-min(max(sum(a * b for a, b in zip(x, y)), low), top), j) for j, y in q.items() if j != k)
        assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == k] == every[:2]
    none = v.limit(0)
    assert topk.top_k(none, v, 2).collect() == topk.top_k(v, none, 2).collect() == []


def test_first_level_grows_with_the_universe(spark):
    listed = spark.createDataFrame([("k3",), ("k77",)], "key string")
    for n in (100, 20_000):
        universe = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"))
        cascade = url_filter.fit_cascade(listed, universe)
        assert universe.where(cascade.contains(F.col("key"))).count() == 2
        passed = universe.where(url_filter.in_filter(*cascade.levels[0], 0, F.col("key"))).count()
        assert passed <= 30  # a few of them by mistake, however many keys there are
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(spark, pages, queries.RULES).collect() == []


def test_sample_takes_one_row_of_an_id(spark):
    many = spark.range(5000).select((F.col("id") % 3).alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    got = {r.doc_id: r.text for r in learn.labelled_sample(many, labels, "quality", 100).collect()}
    assert got == {0: "t0", 1: "t1", 2: "t1001"}


def test_language_limits_are_checked_before_anything_is_collected(spark):
    rows = spark.createDataFrame([(f"text {k}", f"l{k}") for k in range(5)], "text string, lang string")
    with pytest.raises(ValueError, match="5 languages"):
        langid.fit(rows, max_languages=4)


def test_pipeline_without_languages_keeps_documents(spark, tmp_path):
    import corpus_pipeline

    table = spark.range(6).select(F.col("id").alias("doc_id"), F.lit("some words of a text").alias("text"), F.lit(None).cast("string").alias("lang"),
                                  F.lit("s").alias("source"), F.lit(20).cast("long").alias("n_chars"), F.lit(1).alias("keys"))
    kept = corpus_pipeline.language_stage(spark, table, "")
    assert kept.count() == 6 and kept.columns == list(corpus_pipeline.COLUMNS)
    table.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_patterns_place_most_pieces(spark):
    r = np.random.default_rng(3)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lengths = [x.length for x in packing.tokenize(table, public_tokenizers.path("word_bpe_49k.json")).select("length").collect()]
    for sizes, share in ((lengths, 0.8), (r.integers(1, 500, 20_000), 0.95), (r.lognormal(6, 1, 20_000).astype(int).clip(1, 4096), 0.8)):
        count = np.bincount(sizes, minlength=4097)
        made = packing.plan(count)
        assert made.by_pattern >= share * count[:4096].sum()
        assert made.sequences == -(-int(count @ np.arange(4097)) // 4096)  # the bound
    same = packing.plan(np.bincount([1000] * 999, minlength=4097))  # no pattern fills a sequence
    assert same.by_pattern == 0 and same.sequences == 250
