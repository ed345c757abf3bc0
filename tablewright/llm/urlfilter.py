"""URL filters: host and path rules looked up in a cascade of Bloom filters.

A rule names a host (with its subdomains) and a path prefix. Its key is the
two written together, ``example.net/en/``. The keys a url could match are its
host's suffixes combined with its path's prefixes, of no more labels and no
longer than the rules have. All these candidates of the corpus are the key
universe. Level 0 of the cascade encodes the listed keys; each further level
encodes the keys of the other side that the level before let through wrongly,
until a level lets none through. Over that universe membership is then exact,
so a url is judged by bit tests in its own row: no join, no shuffle.

The universe is made distinct once (partial sums, so a hot host is one row per
task), written, and read once per level. Only filters reach the driver. A
level has 2 + 1.44 log2(others / own) bits per key, so it lets through about
a quarter as many others as it has keys: the filters together take a few bytes
per rule and per doubling of the universe.

Defined results: a null url, or one without ``://``, has an empty host and
path and matches nothing. An empty rule list matches nothing. Of several
rules that fit, the longest key wins, then the smaller key; a key listed
twice must have one action. Unmatched urls get ``default``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.arrays import let
from tablewright.llm.common import discard, staged
from tablewright.llm.registry import query

Rule = tuple[str, str, str]  # host, path, action

#: The rules of the registered query.
RULES: list[Rule] = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

_ASCII_UPPER, _ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(
        F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _ASCII_UPPER, _ASCII_LOWER
    )


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidates(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Every key this url could match, without null."""
    labels = max((h.count(".") + 1 for h, _, _ in rules), default=0)
    lengths = sorted({len(p) for _, p, _ in rules})
    suffixes = [F.substring_index(host, ".", -k) for k in range(1, labels + 1)]
    prefixes = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]
    keys = [F.when((s != "") & p.isNotNull(), F.concat(s, p)) for s in suffixes for p in prefixes]
    return F.array_distinct(F.array_compact(F.array(*keys))) if keys else F.array().cast("array<string>")


def _positions(key: Column, seed: int, n_bits: int, hashes: int) -> list[Column]:
    """Bit numbers of a key: two hashes, combined."""
    one, two = (F.pmod(F.xxhash64(F.lit(2 * seed + i), key), F.lit(2**40)) for i in range(2))
    return [F.pmod(one + F.lit(i) * two, F.lit(n_bits)) for i in range(hashes)]


def bit_is_set(table: Column, p: Column) -> Column:
    """Bit ``p`` of a binary, counted as bitmap_construct_agg does."""
    octet = F.conv(F.hex(F.substring(table, (F.shiftright(p, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", octet, p.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1


class Cascade:
    """Exact membership of the universe's keys in the list, as bit tests."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, int, bytes]] = []  # bits, hashes, filter

    def add(self, keys: DataFrame, count: int, others: int) -> int:
        """Encode ``keys`` as the next level; only its bytes reach the driver."""
        bits = 2 + math.ceil(1.44 * math.log2(max(2.0, others / count)))
        seed, n_bits = len(self.levels), max(64, 8 * math.ceil(count * bits / 8))
        hashes = max(1, round(bits * math.log(2)))
        bit = F.explode(F.array(*_positions(F.col("key"), seed, n_bits, hashes))).alias("p")
        pages = (
            keys.select(bit)
            .groupBy(F.shiftright("p", 15).alias("page"))
            .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(0x7FFF))).alias("bits"))
        )
        table = bytearray(n_bits // 8)
        for row in pages.toLocalIterator():
            at = row["page"] << 12
            table[at : at + 4096] = row["bits"][: len(table) - at]
        self.levels.append((n_bits, hashes, bytes(table)))
        return seed

    def passes(self, key: Column, level: int) -> Column:
        n_bits, hashes, table = self.levels[level]
        out = F.lit(True)
        for p in _positions(key, level, n_bits, hashes):
            out = out & bit_is_set(F.lit(table), p)
        return out

    def contains(self, key: Column) -> Column:
        """Listed keys stop at an odd level, others at an even one; past the last the side is certain."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            out = F.when(~self.passes(key, level), F.lit(level % 2 == 1)).otherwise(out)
        return out


def build_cascade(universe: DataFrame) -> Cascade:
    """Cascade over ``universe`` (key, listed), one row per key."""
    cascade, listed = Cascade(), True
    left = universe
    while True:
        ours = left.where(F.col("listed") == listed)
        sizes = dict(left.groupBy("listed").count().collect())  # two rows
        if not sizes.get(listed):
            return cascade
        level = cascade.add(ours, sizes[listed], sizes.get(not listed, 0))
        # what the new level lets through: all of our side, and mistakes of the other
        left = left.where((F.col("listed") == listed) | cascade.passes(F.col("key"), level))
        listed = not listed


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """(row, host, path, rule, verdict) of every page, all input columns inside ``row``."""
    rules = [(h.lower(), p, a) for h, p, a in rules]
    actions = {h + p: a for h, p, a in rules}
    if len(actions) < len({(h + p, a) for h, p, a in rules}):
        raise ValueError("a rule is listed with two actions")
    rows = pages.select(
        F.struct("*").alias("row"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")
    )
    if not rules:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    spark = pages.sparkSession
    cascades: dict[str, Cascade] = {}
    seen = rows.select(F.explode(candidates(F.col("host"), F.col("path"), rules)).alias("key")).distinct()
    seen = staged(seen, "keys")
    for action in sorted(set(actions.values())):
        listed = spark.createDataFrame([(k,) for k, a in actions.items() if a == action], "key string")
        both = seen.withColumn("listed", F.lit(False)).unionByName(listed.withColumn("listed", F.lit(True)))
        universe = staged(both.groupBy("key").agg(F.max("listed").alias("listed")), "universe")
        cascades[action] = build_cascade(universe)
        discard(universe)
    discard(seen)

    def hit(action: str, cascade: Cascade) -> Column:
        """Longest candidate listed for the action, the smaller key on a tie; null if there is none."""
        listed = lambda keys: F.array_min(
            F.transform(
                F.filter(keys, cascade.contains),
                lambda k: F.struct((-F.length(k)).alias("n"), k.alias("key"), F.lit(action).alias("action")),
            )
        )
        return let(candidates(F.col("host"), F.col("path"), rules), listed)

    hits = [hit(a, c) for a, c in cascades.items()]
    rows = rows.select("*", F.array_min(F.array(*hits)).alias("winner"))
    return rows.select(
        "row", "host", "path", F.col("winner.key").alias("rule"),
        F.coalesce(F.col("winner.action"), F.lit(default)).alias("verdict"),
    )


@query(
    "op4_url_filter",
    r"""
    WITH p AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ),
    h AS (
        SELECT page_id,
            translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM p
    ),
    r(host, path, action) AS (
        VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
               ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
    ),
    m AS (
        SELECT h.page_id, h.host, h.path, r.host || r.path AS rule, r.action,
            row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.host || r.path) DESC) AS k
        FROM h LEFT JOIN r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path)
    )
    SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE k = 1
    """,
)
def op4_url_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, RULES).select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")
