"""Fingerprints of documents: trees, likeness, and the next document in order."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import merkle
from tablewright.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
TEXT = st.text("ab7 \n.é", max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT, TEXT)
def test_roots_test_equality(a, b):
    one, two = merkle.tree(a), merkle.tree(b)
    assert (one.root == two.root) == (a == b) == (str(one) == str(two))
    near = merkle.likeness(one, two)
    assert 0 <= near <= 1 and near == merkle.likeness(two, one) and (a != b or near == 1)
    assert merkle.Tree.parse(str(one)) == one


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=400))
def test_cuts_are_in_order(data):
    at, lines = merkle.cuts(data)
    assert at[0] == 0 and at[-1] == len(data) and (0 < np.diff(at)).all() and (np.diff(at) <= merkle.LONGEST).all()
    assert set(lines) <= set(at) and [data[s:e] for s, e in zip(lines, lines[1:])] == data.splitlines(True) or b"\r" in data


def test_cuts_are_local():
    rng = random.Random(1)
    text = "\n".join(" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(40)) for _ in range(30))
    half = len(text) // 2
    changed = text[:half] + "X" + text[half + 1 :]
    one, two = merkle.tree(text), merkle.tree(changed)
    assert 0.98 < merkle.likeness(one, two) < 1
    found = merkle.edits(one, two)
    line = text[:half].count("\n")
    assert {f[0] for f in found} == {"a", "b"} and len(found) <= 4 and {f[2] for f in found} == {line}
    assert merkle.edits(one, one) == []
    # a block moved as a whole costs little
    lines = text.split("\n")
    assert merkle.likeness(one, merkle.tree("\n".join(lines[15:] + lines[:15]))) > 0.9
    # sections end at blank lines
    assert len(merkle.tree("a\nb\n\nc\n \n\nd\n").sections) == 3


def plain(rows):
    """[(doc_id, text)] sorted -> (doc_id, n_chars, edited text, next text)"""
    out = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        k = len(t) // 2
        out.append((i, len(t), t[: len(t) - k] + u[:k], t, u))
    return out


def test_query(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in QUERIES["op11_merkle_fingerprints"](spark, SF).collect()}
    assert len(got) == len(docs)
    closer = 0
    for i, n, edited, text, after in plain(docs):
        r, one = got[i], merkle.tree(text)
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (str(one), str(merkle.tree(edited)))
        assert r["near_edited"] == merkle.likeness(one, merkle.tree(edited))
        assert r["near_next"] == merkle.likeness(one, merkle.tree(after))
        closer += r["near_edited"] > r["near_next"] or text == after or n < 100
    assert closer > 0.98 * len(docs)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_edges(edge, nothing, spark, ranges):
    rows = [(r["doc_id"], r["text"] or "") for r in edge.select("doc_id", "text").collect()]
    hashes = {r["text"]: r["h"] for r in edge.selectExpr("coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS h").collect()}
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]]))
    want = [(i, n, hashlib.sha256(e.encode()).hexdigest(), merkle.tree(t).root) for i, n, e, t, _ in plain(rows)]
    got = merkle.compared_with_next(edge, ranges).collect()
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"].split("/")[0])) for r in got)
    assert merkle.compared_with_next(nothing, ranges).collect() == []
    alone = merkle.compared_with_next(spark.createDataFrame([("x", "abcd")], "doc_id string, text string"), ranges).collect()
    assert [r["edited_sha256"] for r in alone] == [hashlib.sha256(b"abab").hexdigest()]
    assert len(merkle.fingerprints(edge, keep=("doc_id", "key", "text")).collect()) == 11


def test_many_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(2000), "w" * rng.randrange(9) + str(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    hashes = {r["text"]: r["h"] for r in df.selectExpr("text", "xxhash64(text) AS h").collect()}
    rows.sort(key=lambda r: (r[0], hashes[r[1]]))
    want = sorted((i, n, hashlib.sha256(e.encode()).hexdigest()) for i, n, e, _, _ in plain(rows))
    assert sorted(tuple(r)[:3] for r in merkle.compared_with_next(df, 20).collect()) == want
