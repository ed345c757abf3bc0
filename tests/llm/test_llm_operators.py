"""Operators against plain versions, exact round trips and held-out accuracy."""

import functools
import hashlib
import heapq
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from brute import dedup_lines, edits, groups, jaccard_groups, judge, mix_times, near, near_groups, repeated_words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tablewright.llm import bpe, common, exactdedup, linededup, mixing, quality_model, rules, sharding, simhash, tiles, urlfilter
from tablewright.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path(bpe.RANKS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def plain(docs):
    return [(r["doc_id"], r["text"], r["source"]) for r in docs.orderBy("doc_id").collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    n = 400
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [
        (700, i) for i in range(600, 700)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    nodes = sorted({x for e in links if e[0] != e[1] for x in e})
    have = {frozenset(e) for e in links}
    want = groups(len(nodes), lambda i, j: frozenset((nodes[i], nodes[j])) in have)
    assert got == {v: nodes[w] for v, w in zip(nodes, want)}


@functools.cache
def whole():
    return bpe.encoder(RANKS)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB1 \n\t'sé漢。,.\u00a0\u2003\x1c\x85🎉٣"), max_size=80), st.integers(1, 9))
def test_pieces_encode_like_the_whole(text, size):
    parts = list(bpe.pieces(text, size))
    assert "".join(parts) == text
    ids = [t for ids in bpe.encode(whole(), text, size) for t in ids]
    assert ids == whole().encode_ordinary(text)
    assert whole().decode_bytes(ids) == text.encode()


def test_bpe_query(spark, plain):
    got = {r["doc_id"]: r for r in QUERIES["op3_byte_bpe"](spark, SF).collect()}
    for doc_id, text, _ in plain:
        ids = whole().encode_ordinary(text)
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_tokenized_round_trip(docs):
    for r in bpe.tokenized(docs.limit(20), RANKS, keep=("doc_id", "text")).collect():
        assert bytes(r["decoded"]).decode() == r["text"]
        assert r["ids"] == whole().encode_ordinary(r["text"])


def test_rank_file_is_a_parameter(docs):
    other = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert isinstance(bpe.encoder(other), tiktoken.Encoding)
    row = bpe.token_digests(docs.limit(1), other).first()
    assert row["decoded_sha256"] == docs.limit(1).select(F.sha2("text", 256)).first()[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 50)), max_size=12), st.integers(1, 9))
def test_deal_is_largest_first_by_heap(lots, shards):
    lots = sorted(lots, key=lambda x: -x[1])
    quotas = sharding.deal([(n, float(s)) for n, s in lots], shards)
    assert [sum(q) for q in quotas] == [n for n, _ in lots]
    heap = [0] * shards
    for n, s in lots:
        for _ in range(n):
            heapq.heapreplace(heap, heap[0] + s)
    loads = [sum(q[i] * s for q, (_, s) in zip(quotas, lots)) for i in range(shards)]
    assert sorted(loads) == sorted(heap)


def test_lots_grow_with_size(spark):
    sizes = [*range(1, 5000), *(3**i for i in range(8, 39))]
    rows = spark.createDataFrame([(s,) for s in sizes], "s bigint").select("s", sharding.lot_of(F.col("s")).alias("lot")).collect()
    lots = [r["lot"] for r in sorted(rows)]
    assert lots == sorted(lots) and len(set(lots[:2047])) == 2047


def test_shard_query(spark, plain):
    rows = {r["doc_id"]: r for r in QUERIES["op2_shard_groups"](spark, SF).collect()}
    text, size = {d: t for d, t, _ in plain}, {}
    for d, t in text.items():
        assert rows[d]["size"] == len(t.encode()) + 1
        size[t] = size.get(t, 0) + rows[d]["size"]
    assert len({(t, rows[d]["shard"]) for d, t in text.items()}) == len(size)
    heap = [0] * 8
    for s in sorted(size.values(), reverse=True):
        heapq.heapreplace(heap, heap[0] + s)
    loads = [sum(r["size"] for r in rows.values() if r["shard"] == k) for k in range(8)]
    assert max(loads) - min(loads) <= max(heap) - min(heap) + 0.01 * max(heap)
    for k in range(8):
        slots = sorted(r["slot"] for r in rows.values() if r["shard"] == k)
        assert slots == list(range(len(slots)))


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=400), st.binary(max_size=400))
def test_polynomials_combine(left, right):
    poly = exactdedup.Polynomial(chunk=37)
    joined = tuple(
        (a + b) % p for a, b, p in zip(poly.shift(poly.of(left), len(right)), poly.of(right), poly.primes))
    assert joined == poly.of(left + right)


def test_colliding_fingerprints_are_told_apart(spark):
    """With tiny primes nearly all texts of a length collide; pieces of three bytes."""
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.choice([4, 7])))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in exactdedup.exact_duplicates(df, primes=(2, 3), bases=(1, 1), size=3).collect()}
    for i, text in rows:
        same = [j for j, t in rows if t == text]
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (max(same), len(same), i == max(same))


def test_cascade_is_exact_over_its_universe(spark):
    keys = [(f"host{i}.example/", i % 7 == 0) for i in range(3000)]
    cascade = urlfilter.build_cascade(spark.createDataFrame(keys, "key string, listed boolean"))
    assert len(cascade.levels) > 2
    got = spark.createDataFrame(keys, "key string, listed boolean").select(
        "listed", cascade.contains(F.col("key")).alias("hit")).where("listed <> hit").count()
    assert got == 0


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=40), st.text("abc", max_size=40), st.sampled_from([0.5, 0.8, 0.9]))
def test_edit_similarity(a, b, least):
    assert linededup.edit_similar(a, b, least) == (edits(a, b) <= int((1 - least) * max(len(a), len(b)) + 1e-9))


def test_line_simhash():
    rng = np.random.default_rng(1)
    counts = np.array([1, 3, 254, 255, 256, 600, 2])
    hashes = rng.integers(0, 2**64, counts.sum(), np.uint64)
    at = 0
    for n, fp in zip(counts, linededup.simhashes(hashes, counts)):
        part = [int(h) for h in hashes[at : at + n]]
        at += n
        assert int(fp) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in part) > n)


def clusters(rng, n, size):
    out = []
    for _ in range(n):
        base = rng.getrandbits(64)
        for _ in range(size):
            x = base
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
            out.append(x)
    return out


@pytest.mark.parametrize("tile", [40, 1 << 15])
def test_tiles_lose_no_link(spark, tile):
    rng = random.Random(5)
    fps = list({*clusters(rng, 25, 12), *(rng.getrandbits(64) for _ in range(300)), 0, 2**64 - 1})
    signed = [(int(np.uint64(x).astype(np.int64)),) for x in fps]
    links = tiles.near_links(spark.createDataFrame(signed, "fp bigint"), 4, size=tile)
    assert links.count() < 3 * len(fps) * (1 if tile > 40 else len(fps) / tile)
    got = {r["node"]: r["component"] for r in common.components(links).collect()}
    want = groups(len(fps), lambda i, j: near(fps[i], fps[j], 4))
    for i, j in ((i, w) for i, w in enumerate(want)):
        a, b = signed[i][0], signed[j][0]
        assert got.get(a, a) == got.get(b, b)
    assert len({got.get(a, a) for (a,) in signed}) == len(set(want))


@pytest.mark.parametrize("tile", [5, 1 << 15])
def test_buckets_lose_no_link(spark, tile):
    """A bucket of near hashes larger than a tile goes on in tile pairs."""
    rng = random.Random(6)
    base = rng.getrandbits(64)
    fps = list({*clusters(rng, 25, 12), *(base ^ 1 << a ^ 1 << b for a in range(9) for b in range(9)),
                *(rng.getrandbits(64) for _ in range(200))})
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    links = linededup.hash_links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), 3, tile)
    got = {r["node"]: r["component"] for r in common.components(links).collect()}
    want = groups(len(fps), lambda i, j: near(fps[i], fps[j], 3))
    assert len({got.get(a, a) for a in signed}) == len(set(want))
    for i, w in enumerate(want):
        assert got.get(signed[i], signed[i]) == got.get(signed[w], signed[w])


def test_large_groups_of_lines_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(linededup, "_PART", 4)
    words = [f"word{chr(97 + i)}" for i in range(20)]
    rows = [(i, " ".join([*words, "x" * (i % 9), "y" * (i // 9)])) for i in range(60)] + [(99, "something else entirely here")]
    out = linededup.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r["row"]["doc_id"]: r["clean"] for r in out.collect()}
    assert [got[i] for i, _ in rows] == dedup_lines(rows)
    assert sum(v != "" for v in got.values()) < 30


def test_line_query(spark, plain):
    got = {r["doc_id"]: r["clean_sha256"] for r in QUERIES["op8_line_dedup"](spark, SF).collect()}
    want = dedup_lines([(d, t) for d, t, _ in plain])
    assert got == {d: hashlib.sha256(t.encode()).hexdigest() for (d, *_), t in zip(plain, want)}


def test_simhash_query(spark, plain):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op9_simhash"](spark, SF).collect()}
    fps, roots = near_groups([t for _, t, _ in plain])
    assert got == {d: (f"{fp:016x}", plain[r][0]) for (d, *_), fp, r in zip(plain, fps, roots)}


@pytest.mark.parametrize("width", [1, 4])
def test_segments_change_nothing(monkeypatch, width):
    text = ("alpha Beta  gamma\ndelta " * 50 + "É" * 30 + " end").encode()
    once = simhash.fingerprint(text, width)
    monkeypatch.setattr(simhash, "_SEGMENT", 17)
    assert simhash.fingerprint(text, width) == once


def test_repeated_words(spark):
    texts = ["a b c a b c", "a a a a", "a b", "", "a b c d a b", "x a b c y a b c z", "a b c\na b c"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", rules.repeated_words(F.col("t")).alias("n"))
    assert {r["t"]: r["n"] for r in rows.collect()} == {t: repeated_words(t) for t in texts}


def test_clean_text(docs, plain):
    got = {r["doc"]["doc_id"]: (r["kept"], r["clean"]) for r in rules.judge(docs).collect()}
    assert got == {d: judge(t) for d, t, _ in plain}


def test_mix_near_targets(spark, docs, plain):
    target, times = mix_times(plain)
    rows = {r["doc_id"]: r for r in mixing.mix_report(docs).collect()}
    for (d, t, s), k in zip(plain, times):
        assert rows[d]["taken"] == k * rows[d]["size"]
        assert rows[d]["target"] == pytest.approx(target[s])
    largest = max(r["size"] for r in rows.values())
    for s in target:
        taken = sum(rows[d]["taken"] for d, _, x in plain if x == s)
        assert abs(taken - target[s]) <= 2 * largest
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_report(docs.repartition(5)).collect()}
    assert again == {d: r["taken"] for d, r in rows.items()}


@pytest.mark.parametrize("others", [0, 3, 40])
def test_mix_of_repeated_rows(spark, others):
    """A source of equal rows is taken up to its target, not whole or twice."""
    rows = [(1, "a b c d e f g h i j", "a")] * 100 + [(2, "x y z", "b")] * 7
    rows += [(10 + i, "w " * (5 + i % 9), "b") for i in range(others)] + [(None, "n n", None)] * 30
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    target, times = mix_times(rows)
    report = mixing.mix_report(df).collect()
    assert sorted((r["doc_id"] or 0, r["taken"]) for r in report) == sorted(
        (d or 0, k * len(t.split())) for (d, t, _), k in zip(rows, times))
    for s in target:
        taken = sum(r["taken"] for r in report if r["source"] == s)
        assert abs(taken - target[s]) <= 20
    assert sorted(r["doc_id"] or 0 for r in mixing.mixed(df).collect()) == sorted(
        d or 0 for (d, *_), k in zip(rows, times) for _ in range(k))


@pytest.mark.parametrize("run", ["\n", " ", "\u3000", " \n", "a", "7", "!", "é"])
def test_long_runs_are_encoded(run):
    """Runs of two million signs end no worker; short ones of the same kind agree with the tokenizer."""
    for tail in ("", "x", " x", "!", "7"):
        text = "go" + run * 2500 + tail
        ids = [t for part in bpe.encode(whole(), text) for t in part]
        assert ids == whole().encode_ordinary(text)
        text = "go" + run * 5000 + tail
        assert [t for part in bpe.encode(whole(), text) for t in part] == whole().encode_ordinary(text)
    long = "go" + run * (2_000_000 // len(run)) + " end"
    ids = [t for part in bpe.encode(whole(), long) for t in part]
    assert whole().decode_bytes(ids) == long.encode()


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op7_quality_model"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    scores = [(r["score"], r["quality"], r["predicted"]) for r in rows.collect()]
    pairs = [(a > b) + 0.5 * (a == b) for a, q, _ in scores if q for b, p, _ in scores if not p]
    assert sum(pairs) / len(pairs) > 0.95
    assert sum(p == q for _, q, p in scores) / len(scores) > 0.95


def test_rules_are_paths():
    rule = (("symbols", False, 0.1), ("log_words", True, 3.0))
    ensemble = quality_model.Ensemble(0.5, ((rule, -2.0),))
    assert re.search(r">\(symbols, 0.1\).*<=\(log_words, 3.0\).* THEN -2.0", str(ensemble.score()))


def test_pipeline(spark, plain):
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect())
    rows = [(d, clean, s) for d, t, s in plain for kept, clean in [judge(t)] if kept]
    rows = [(d, t, s) for (d, _, s), t in zip(rows, dedup_lines([(d, t) for d, t, _ in rows]))]
    roots = jaccard_groups([t for _, t, _ in rows])
    rows = [r for i, r in enumerate(rows) if roots[i] == i]
    want = []
    for (d, t, _), k in zip(rows, mix_times(rows)[1]):
        ids = whole().encode_ordinary(t)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want += [(d, len(ids), sha(" ".join(map(str, ids)).encode()), sha(t.encode()))] * k
    assert got == sorted(want)
