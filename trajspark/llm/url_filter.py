"""URL filters with a cascade of Bloom filters; DataFrame functions only.

A rule is a host, a path and a verdict; it fits its host and all subdomains when the url's path starts with its path, and the longest
fitting rule wins. Every url has a few candidate keys: the suffixes of its host times the beginnings of its path that are as
long as some rule's path. All candidate keys of the corpus are the key universe.

The first level of a cascade encodes the listed keys of the universe, the second the universe's false positives of the
first, the third the listed keys that the second holds wrongly, and so on until a level has none. A key is listed when the first level that
lacks it is an even one, so membership is exact for every key of the universe, without a join. The first level is sized so that
its false positives are about as many as the listed keys; the whole cascade then takes a few bytes a listed key. Lists whose
cascades would take more than ``max_filter_bytes`` are dealt by a hash of the key into shards that don't, with a cascade each: every key of a
site is asked in its own shard, one pass a shard over the keys dealt to it, and the longest hit of the site wins.

Defined results: a url that is null or has no ``://`` has an empty host and path and no rule; without a rule the verdict is
``default``. A key listed to be blocked and allowed is blocked. Repeated rows are judged alike, an empty table gives no rows,
an empty rule list gives ``default`` throughout, other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajspark.llm.common import ascii_lower, constant_array, saved

MAX_FILTER_BYTES = 16 << 20


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty when there is none."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Host suffixes of at most ``labels`` labels, each with the beginnings of the path that have one of ``lengths``."""
    parts = F.split(host, r"\.", -1)
    last = F.least(F.size(parts), F.lit(labels))
    suffixes = F.transform(F.sequence(F.lit(1), last), lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    fitting = F.filter(F.lit(lengths), lambda n: n <= F.length(path))
    starts = F.transform(fitting, lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: 64-bit words, bits, probes, and the number that seeds its hashes."""

    words: list[int]
    bits: int
    probes: int
    seed: int

    def has(self, key: Column) -> Column:
        if not self.words:
            return F.lit(False)
        words = constant_array(self.words, "bigint")
        hit = F.lit(True)
        for at in positions(key, self.bits, self.probes, self.seed):
            word = F.get(words, F.shiftright(at, 6).cast("int"))
            hit = hit & (F.bit_get(word, (at % 64).cast("int")) == 1)
        return hit


def positions(key: Column, bits: int, probes: int, seed: int) -> list[Column]:
    size = F.lit(bits).cast("long")
    first, step = F.pmod(F.xxhash64(key, F.lit(2 * seed)), size), F.pmod(F.xxhash64(key, F.lit(2 * seed + 1)), size)
    return [F.pmod(first + F.lit(i) * step, size) for i in range(probes)]


def build_level(keys: DataFrame, count: int, false_rate: float, seed: int) -> Level:
    """A filter over the ``key`` column. The driver gets the words of the filter, whose number the size bound covers."""
    if count == 0:
        return Level([], 0, 0, seed)
    bits = filter_bits(count, false_rate)
    probes = max(1, round(math.log2(1 / false_rate)))
    at = F.explode(F.array(*positions(F.col("key"), bits, probes, seed))).alias("at")
    words = (
        keys.select(at)
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))).alias("bits"))
        .collect()
    )
    filled = [0] * (bits // 64)
    for row in words:
        filled[row["word"]] = row["bits"]
    return Level(filled, bits, probes, seed)


def filter_bits(count: int, false_rate: float) -> int:
    return 64 * math.ceil(count * math.log2(1 / false_rate) * 1.4427 / 64 + 1)


@dataclass(frozen=True)
class Cascade:
    levels: list[Level]

    def has(self, key: Column) -> Column:
        """Exact for the keys of the universe the cascade was built over."""
        found = F.lit(len(self.levels) % 2 == 1)
        for depth, level in reversed(list(enumerate(self.levels, 1))):
            found = F.when(~level.has(key), F.lit(depth % 2 == 0)).otherwise(found)
        return found


def build_cascade(listed: DataFrame, others: DataFrame) -> Cascade:
    """A cascade that holds the ``key`` rows of ``listed`` and none of ``others``.

    Both are distinct and disjoint. Each level halves the keys that are still told apart wrongly, so the number of levels is
    logarithmic in the listed keys.
    """
    n_in, n_out = listed.count(), others.count()
    if n_in == 0:
        return Cascade([Level([], 0, 0, 1)])
    rate = first_rate(n_in, n_out)
    levels: list[Level] = []
    inside, outside, count = listed, others, n_in
    while count:
        seed = len(levels) + 1
        level = build_level(inside, count, rate, seed)
        levels.append(level)
        outside = saved(outside.filter(level.has(F.col("key"))), f"cascade-{seed}")
        inside, outside, rate = outside, inside, 0.5
        count = inside.count()
    return Cascade(levels)


def first_rate(listed: int, others: int) -> float:
    """False positives of the first level: about as many as the listed keys."""
    return min(0.5, max(2.0**-40, listed * math.sqrt(0.5) / max(1, others)))


def shards_for(listed: int, others: int, max_filter_bytes: int) -> int:
    """Shards whose cascades stay within the bound; the levels after the first take less than three times as much as it."""
    if not listed:
        return 1
    return min(listed, 1 + filter_bits(listed, first_rate(listed, others)) // 8 * 4 // max_filter_bytes)


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", *, default: str = "allow",
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """One row per page: page_id, host, path, rule (its key or null), verdict.

    ``rules`` has host, path and verdict (``block`` or ``allow``). Its longest host in labels and the lengths of its paths are
    the only things that bound the candidate keys of a url.
    """
    listed = rules.select(F.concat(ascii_lower(F.col("host")), F.coalesce("path", F.lit(""))).alias("key"), "verdict").filter("key is not null")
    shape = rules.agg(
        F.max(F.size(F.split("host", r"\.", -1))).alias("labels"), F.collect_set(F.length(F.coalesce("path", F.lit("")))).alias("lengths"),
    ).first()
    split = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if shape["labels"] is None:
        return split.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keys = candidate_keys(F.col("host"), F.col("path"), shape["labels"], sorted(shape["lengths"]))
    universe = saved(split.select(F.explode(keys).alias("key")).distinct(), "url-universe")
    sets, shards, total = {}, 1, universe.count()
    for verdict in ("block", "allow"):
        own = listed.filter(F.col("verdict") == verdict).select("key").distinct()
        sets[verdict] = saved(universe.join(own, "key", "left_semi"), f"url-{verdict}"), own
        n = sets[verdict][0].count()
        shards = max(shards, shards_for(n, total - n, max_filter_bytes))
    if shards > 1:
        return _judge_by_shards(split, keys, universe, sets, shards, default)
    cascades = {v: build_cascade(inside, universe.join(own, "key", "left_anti")) for v, (inside, own) in sets.items()}
    matched = F.filter(keys, lambda k: cascades["block"].has(k) | cascades["allow"].has(k))
    longest = F.array_max(F.transform(matched, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))["key"]
    ruled = split.withColumn("rule", longest)
    verdict = F.when(F.col("rule").isNull(), default).when(cascades["block"].has(F.col("rule")), "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def _judge_by_shards(split: DataFrame, keys: Column, universe: DataFrame, sets: dict, shards: int, default: str) -> DataFrame:
    """The same with a cascade for each shard of the keys."""

    def of(df: DataFrame, number: int) -> DataFrame:
        return df.filter(F.pmod(F.xxhash64("key", F.lit("shard")), F.lit(shards)) == number)

    sites = saved(split.select("host", "path").distinct(), "url-sites")
    asked = saved(sites.select("host", "path", F.explode(keys).alias("key")), "url-asked")
    hits = []
    for number in range(shards):
        cascades = {v: build_cascade(of(inside, number), of(universe, number).join(own, "key", "left_anti")) for v, (inside, own) in sets.items()}
        told = of(asked, number).withColumns({v: c.has(F.col("key")) for v, c in cascades.items()})
        hits.append(saved(told.filter("block or allow").select("host", "path", "key", F.col("block").alias("blocked")), f"url-hits-{number}"))
    best = functools.reduce(DataFrame.unionByName, hits).groupBy("host", "path").agg(
        F.max(F.struct(F.length("key").alias("n"), "key", "blocked")).alias("best"))
    found = split.join(best, ["host", "path"], "left")
    verdict = F.when(F.col("best").isNull(), default).when(F.col("best.blocked"), "block").otherwise("allow")
    return found.select("page_id", "host", "path", F.col("best.key").alias("rule"), verdict.alias("verdict"))
