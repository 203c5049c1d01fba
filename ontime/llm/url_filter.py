"""URL rules by Bloom filter cascades, with DataFrame functions only.

A rule names a host and a path prefix. A page's candidate keys are its host suffixes joined to
its path prefixes, for the label counts and path lengths that occur in rules; all candidate
keys of all pages are the key universe. A cascade encodes the listed keys in a Bloom filter,
the universe's false positives of that in a second, the listed keys that the second lets
through by mistake in a third, and so on until a level has no false positives. Over the universe its answers
are exact, and each is a chain of bit tests on literals: pages need no join.

A filter has at most ``max_bits`` bits (checked); it is made by Spark as grouped ``bit_or`` and only its
words reach the driver.

Defined cases: null urls and urls without ``://`` have empty host and path; an unlisted page
gets the default verdict; of several rules the longest wins, then the longer host; a key listed
to both allow and block is blocked; with no rules or pages nothing is listed; other columns
pass through and an input column with a result's name is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_HASHES = 40


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, both empty where there is no ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"(?s)^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


@dataclass
class Cascade:
    """Bloom filters, each as its words; a key is listed when the first to lack it is an odd one."""

    levels: list[tuple[list[int], int]]  # words and hashes of each level

    def contains(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            answer = F.when(in_filter(*self.levels[i], i, key), answer).otherwise(F.lit(i % 2 == 1))
        return answer


def positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * MOST_HASHES + k)), F.lit(bits)) for k in range(hashes)]


def in_filter(words: list[int], hashes: int, level: int, key: Column) -> Column:
    held = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")  # folded to a literal
    found = F.lit(True)
    for p in positions(key, level, 64 * len(words), hashes):
        found &= F.getbit(F.get(held, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1
    return found


def make_filter(keys: DataFrame, count: int, level: int, hashes: int, max_bits: int) -> list[int]:
    bits = 64
    while bits < math.ceil(1.5 * hashes) * count:  # a share of 2 ** -hashes passes by mistake
        bits *= 2
    if bits > max_bits:
        raise ValueError(f"{count} keys need {bits} bits, more than max_bits")
    spots = keys.select(F.explode(F.array(*positions(F.col("key"), level, bits, hashes))).alias("p"))
    words = spots.groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("v"))
    out = [0] * (bits // 64)
    for row in words.collect():  # at most max_bits / 64 rows
        out[row["w"]] = row["v"]
    return out


def fit_cascade(listed: DataFrame, universe: DataFrame, max_bits: int = 1 << 24) -> Cascade:
    """The cascade of the ``key`` column of ``listed``, exact for every key of either input.

    The first level has enough bits that about as many keys of the universe pass it by mistake as are listed, whatever the
    universe's size, so every level is about the size of the list.
    """
    include = cut_lineage(listed.select("key").distinct())
    exclude = cut_lineage(universe.select("key").distinct().join(include, "key", "left_anti"))
    levels: list[tuple[list[int], int]] = []
    others = exclude.count()
    while (count := include.count()) or not levels:
        level = len(levels)
        hashes = min(MOST_HASHES, max(3, math.ceil(math.log2(1 + others / max(count, 1)))))
        levels.append((make_filter(include, count, level, hashes, max_bits), hashes))
        wrong = cut_lineage(exclude.where(in_filter(*levels[-1], level, F.col("key"))))
        others = count
        include, exclude = wrong, include
    return Cascade(levels)


def candidates(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Array of (size, host size, key): every key of the page that a rule could name."""
    labels = F.size(F.split(host, r"\."))
    found = []
    for n in sorted({r.host.count(".") + 1 for r in rules}):
        for size in sorted({len(r.path) for r in rules}):
            suffix = F.substring_index(host, ".", -n)
            key = F.concat(suffix, F.left(path, F.lit(size)))
            fits = (host != "") & (labels >= n) & (F.length(path) >= size)
            found.append(F.when(fits, F.struct(F.length(key).alias("size"), F.length(suffix).alias("host_size"), key.alias("key"))))
    return F.array_compact(F.array(*found))


def judge(spark: SparkSession, pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict."""
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = split_url(F.col(url))
    split = pages.select(*own, host.alias("host"), path.alias("path"))
    if not rules:
        return split.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    keys = candidates(F.col("host"), F.col("path"), rules)
    universe = cut_lineage(split.select(F.explode(keys).alias("k")).select("k.key").distinct())
    cascades = {}
    for verdict in ("allow", "block"):
        listed = spark.createDataFrame([(r.host + r.path,) for r in rules if r.verdict == verdict], "key string")
        cascades[verdict] = fit_cascade(listed, universe)

    def verdict_of(key: Column) -> Column:
        return F.when(cascades["block"].contains(key), "block").when(cascades["allow"].contains(key), "allow")

    hit = F.array_max(F.filter(keys, lambda k: verdict_of(k["key"]).isNotNull()))
    return split.withColumn("rule", hit["key"]).withColumn("verdict", F.coalesce(verdict_of(F.col("rule")), F.lit(default)))
