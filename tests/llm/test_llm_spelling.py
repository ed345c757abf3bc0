"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import spelling
from tablewright.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


def counted(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {tuple(r) for r in QUERIES["op13_spelling_variants"](spark, SF).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    want = plain(counted(docs))
    assert got == want and any(r[1] != r[2] and r[1] for r in want)


@pytest.mark.parametrize("size", [7, 4096])
def test_dense_words(spark, size, monkeypatch):
    """Words of few letters: many partners, ties, long chains of forms, tiles that hold one length or several."""
    monkeypatch.setattr(spelling, "SMALL", 5)
    monkeypatch.setattr(spelling, "BLOCK", 4)
    monkeypatch.setattr(spelling, "_CHUNK", 50)
    rng = random.Random(2)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(300)}
    counts = {w: rng.choice([1, 1, 2, 4, 8, 16, 32, 64]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert {tuple(r) for r in spelling.variants(df, size).collect()} == plain(counts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abÿ", min_size=1, max_size=7), min_size=2, max_size=12, unique=True), st.booleans(), st.integers(1, 8))
def test_prefix_and_suffix(words, first, level):
    """A bucket compared row against shifted row and block by block gives the pairs that belong to it."""
    words = [w for w in words if len(w) in (level - 1, level)]
    half = level // 2
    key = (lambda w: w[:half]) if first else (lambda w: w[len(w) - half :])
    words = [w for w in words if key(w) == key(words[0])]
    if len(words) < 2:
        return
    x = spelling.Chunk([level] * len(words), [first] * len(words), words)
    rows, one = np.arange(len(words)), np.zeros(len(words))
    want = {
        frozenset((a, b)) for a in words for b in words
        if one_edit(a, b) and max(len(a), len(b)) == level and (first or a[:half] != b[:half])
    }
    for found in (x.small(one, one == 0), x.large(rows, rows)):
        got = [frozenset((words[a], words[b])) for i, j in found for a, b in zip(i, j)]
        assert set(got) == want and len(got) == len(want)


def test_edges(edge, nothing, spark, monkeypatch):
    monkeypatch.setattr(spelling, "_SEGMENT", 11)
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    got = {tuple(r) for r in spelling.variants(spelling.word_counts(edge, spelling.misspelt)).collect()}
    assert got == plain(counted(rows)) and got
    assert spelling.variants(spelling.word_counts(nothing, spelling.misspelt)).collect() == []


def test_long_runs(spark):
    long = "x" * 30_000
    rows = [(1, f"{long} {long} {long} {long}y {long}y {long}y {long}y {long}y {long}y ÀÉ×÷ß")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["word"], r["form"]) for r in spelling.variants(spelling.word_counts(df)).collect()}
    assert got == {(long, long + "y"), (long + "y", None)}
