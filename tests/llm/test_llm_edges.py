"""Every operator on empty tables and on rows with nulls, ties, repeats, long texts and clashing names."""

import hashlib
import zlib

import public_tokenizers
import pytest

from tablewright.llm import (
    bpe, exactdedup, license, linededup, mixing, quality_model, rules, sharding, simhash, urlfilter,
)

RANKS = public_tokenizers.path(bpe.RANKS)
NARROW = {
    "mix_report": mixing.mix_report,
    "sharded": sharding.sharded,
    "token_digests": lambda d: bpe.token_digests(d, RANKS),
    "tokenized": lambda d: bpe.tokenized(d, RANKS),
    "judge": rules.judge,
    "exact_duplicates": exactdedup.exact_duplicates,
    "license_hits": license.license_hits,
    "near_duplicates": simhash.near_duplicates,
    "deduplicated": linededup.deduplicated,
    "without_repeated_lines": linededup.without_repeated_lines,
}
ROWS = {
    "passing": rules.passing,
    "mixed": mixing.mixed,
    "representatives": simhash.representatives,
    "distinct_documents": exactdedup.distinct_documents,
    "without_repeated_lines": linededup.without_repeated_lines,
}


@pytest.mark.parametrize("name", sorted(NARROW))
def test_empty_table(nothing, name):
    assert NARROW[name](nothing).collect() == []


@pytest.mark.parametrize("name", sorted(ROWS))
def test_empty_table_keeps_columns(nothing, name):
    out = ROWS[name](nothing)
    assert out.columns == nothing.columns and out.collect() == []


@pytest.mark.parametrize("name", sorted(NARROW))
def test_one_row_each(edge, name):
    assert len(NARROW[name](edge).collect()) == 11


@pytest.mark.parametrize("name", sorted(ROWS))
def test_columns_stay(edge, name):
    out = ROWS[name](edge)
    assert out.columns == edge.columns
    assert [f.dataType for f in out.schema] == [f.dataType for f in edge.schema]
    for r in out.collect():
        assert (r["size"], r["kept"]) == (2, 13)


def test_exact_edges(edge):
    rows = exactdedup.exact_duplicates(edge).collect()
    plain = [r for r in rows if r["text_sha256"] == hashlib.sha256(b"Plain text of five words.").hexdigest()]
    assert {(r["keep_id"], r["group_size"]) for r in plain} == {(6, 4)} and sum(r["kept"] for r in plain) == 1
    empty = [r for r in rows if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert {(r["keep_id"], r["group_size"]) for r in empty} == {(3, 3)} and sum(r["kept"] for r in empty) == 1
    assert len(exactdedup.distinct_documents(edge).collect()) == 6


def test_shard_edges(edge):
    rows = sharding.sharded(edge).collect()
    assert len({r["shard"] for r in rows if r["text_crc32"] == zlib.crc32(b"Plain text of five words.")}) == 1
    assert sorted(r["size"] for r in rows)[:3] == [1, 1, 1]
    for s in {r["shard"] for r in rows}:
        mine = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert mine == list(range(len(mine)))


def test_mix_edges(edge):
    rows = mixing.mix_report(edge).collect()
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["size"] == 0) <= (r["taken"] == 0)
        assert r["target"] <= 2 * r["source_size"]
    assert {r["source"] for r in rows} == {"", "a", "b", None}
    assert {(r["source"], r["weight"]) for r in rows} == {("", 5), ("a", 2), ("b", 1), (None, 5)}


def test_simhash_edges(edge):
    rows = simhash.near_duplicates(edge).collect()
    zero = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {2}
    kept = simhash.representatives(edge).collect()
    assert sum(r["text"] == "Plain text of five words." for r in kept) == 1
    assert [r["doc_id"] for r in kept if r["text"] == "Plain text of five words."] == [1]


def test_line_edges(edge):
    rows = {(r["row"]["doc_id"], r["row"]["text"]): r for r in linededup.deduplicated(edge).collect()}
    assert rows[2, None]["clean"] is None and rows[3, ""]["clean"] == "" and rows[4, " \n\t\n"]["clean"] == " \n\t\n"
    assert rows[1, "Plain text of five words."]["clean"] == "Plain text of five words."
    assert rows[6, "Plain text of five words."]["clean"] == rows[None, "Plain text of five words."]["clean"] == ""
    noticed = [r for (i, t), r in rows.items() if i == 7 and t.startswith("All")]
    assert noticed[0]["clean"] == "All rights reserved.\nOne, two 🎉 three\u00a0four."


def test_rule_edges(edge):
    kept = [r["doc"]["doc_id"] for r in rules.judge(edge).collect() if r["kept"]]
    assert kept == [5]
    row = [r for r in rules.judge(edge).collect() if r["doc"]["text"] is None][0]
    assert (row["n_words"], row["word_chars"], row["base_failed"]) == (0, 0, True)


def test_licence_edges(edge):
    rows = {(r["doc_id"], r["n_license_lines"]): r for r in license.license_hits(edge).collect()}
    assert rows[7, 2]["line_licenses"] == "all-rights-reserved" and rows[7, 2]["whole_license"] is None
    assert (2, 0) in rows and (None, 0) in rows


def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://", "http://NET/", "http://a.net", "x://a.b.net/p?q#f", "http://net.example.com/de/x",
            "a://b.org/fr/?u=http://c.net/", "http://example.net/en/1", "http://example.net/en", "http://notexample.net/en/",
            "http://a.net:80/", "http://a.net/", "http://a.net/", "http://x.net/" + "a/" * 50_000, "http://" + "a." * 20_000 + "net/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").selectExpr(
        "*", "1 AS host", "2 AS path", "3 AS rule", "4 AS verdict", "5 AS key", "6 AS row")
    rows = sorted(urlfilter.judge_urls(df, urlfilter.RULES).collect(), key=lambda r: r["row"]["page_id"])
    want = [None, None, None, None, "net/", None, "net/", "example.com/de/", "org/fr/", "example.net/en/", "net/", "net/",
            None, "net/", "net/", "net/", "net/"]
    assert [r["rule"] for r in rows] == want
    assert [r["verdict"] for r in rows] == [
        "allow" if w in (None, "org/fr/", "example.net/en/") else "block" for w in want]
    assert (rows[6]["host"], rows[6]["path"], rows[4]["host"]) == ("a.b.net", "/p", "net")
    assert {r["rule"] for r in urlfilter.judge_urls(df, []).collect()} == {None}
    assert urlfilter.judge_urls(df.limit(0), urlfilter.RULES).collect() == []


def test_quality_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (7, None)], "doc_id bigint, quality int")
    rows = quality_model.quality_scores(edge, labels).collect()
    assert len(rows) == 11 and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_model.quality_scores(nothing, labels).collect() == []
    assert len(quality_model.quality_scores(edge, labels.limit(0)).collect()) == 11
    ids = {r["doc_id"]: r["held_out"] for r in rows}
    assert all(held == (zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 0) for i, held in ids.items())
