"""URL verdicts: suffix rules first, then exact membership in a list by a cascade of Bloom filters.

Level 0 holds the listed keys. Keys of the universe that it takes for listed though they are not go into level 1, listed keys that
level 1 takes for those go into level 2, and so on until a level is wrong about no key. For every key of the universe the
first level that misses it decides: even levels hold listed keys, odd levels others. So the answer is exact with a few bits a key
and without a join.

The universe is the distinct keys of the corpus itself, aggregated where they are read, so that a host with a third of the rows
is one key. A filter is an array of 64-bit words, read as a scalar subquery. Its size is known before it is read: keys are dealt by
hash into as many shards as keep a shard's level 0 below ``max_words``, and the shards of a cascade are applied one after the other, each a
projection over the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.llm.scratch import saved

BITS_PER_KEY, PROBES = 12, 6


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path; both empty for a null url or one without ``://``."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as ``host/path`` and its verdict; null where none fits.

    ``rules`` are (host, path, verdict), a short list that becomes a CASE expression.
    """

    def fits(rule: tuple[str, str, str]) -> Column:
        return ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])

    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(ordered):
        name = F.when(fits(rule), rule[0] + rule[1]).otherwise(name)
        verdict = F.when(fits(rule), rule[2]).otherwise(verdict)
    return name, verdict


@dataclass
class Level:
    """One filter of one shard: a one-row table with the array ``words`` of ``size`` words."""

    words: DataFrame
    size: int
    number: int


def _probe(key: Column, size: int, level: int, k: int) -> Column:
    """Bit of probe ``k``, by two hashes; shifted so that the sum cannot overflow."""
    first, second = F.xxhash64(key, F.lit(level)), F.xxhash64(F.lit(level), key)
    return F.pmod(F.shiftrightunsigned(first, 2) + F.lit(k) * F.shiftrightunsigned(second, 6), F.lit(size * 64))


def _level(keys: DataFrame, count: int, number: int) -> Level:
    size = max(1, -(-count * BITS_PER_KEY // 64))
    bits = keys.select(F.explode(F.array(*[_probe(F.col("key"), size, number, k) for k in range(PROBES)])).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("word")
    )
    # At most ``size`` rows, which the caller has bounded.
    one = words.agg(F.map_from_entries(F.collect_list(F.struct("at", "word"))).alias("m"))
    full = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at("m", i.cast("long")), F.lit(0)))
    return Level(saved(one.select(full.alias("words")), "filter"), size, number)


def _hit(key: Column, level: Level) -> Column:
    """Whether a level takes ``key`` for one of its own."""
    words = level.words.scalar()
    bits = [_probe(key, level.size, level.number, k) for k in range(PROBES)]
    tests = [F.getbit(F.get(words, F.shiftright(b, 6).cast("int")), F.pmod(b, F.lit(64)).cast("int")) == 1 for b in bits]
    return reduce(lambda a, b: a & b, tests)


@dataclass
class Cascade:
    shards: int
    levels: list[list[Level]]

    def listed(self, key: Column) -> Column:
        """Whether ``key``, of the universe the cascade was built on, is listed."""
        answer = F.lit(False)
        for shard, levels in enumerate(self.levels):
            # The first level that misses decides; one that all hold ends on the last level's side.
            held = F.lit(bool(levels) and levels[-1].number % 2 == 0)
            for level in reversed(levels):
                held = F.when(_hit(key, level), held).otherwise(F.lit(level.number % 2 == 1))
            mine = F.lit(True) if self.shards == 1 else F.pmod(F.xxhash64(key), F.lit(self.shards)) == shard
            answer = F.when(mine, held).otherwise(answer)
        return F.coalesce(answer, F.lit(False))


def cascade(universe: DataFrame, key: str, listed: str, max_words: int = 1 << 17) -> Cascade:
    """Filters for the keys of ``universe``, whose boolean column ``listed`` says which are on the list.

    A key repeated in ``universe`` is listed if one of its rows is; a null key never is. ``max_words`` bounds a filter of one
    shard, by default at 1 MB.
    """
    keys = universe.select(F.col(key).alias("key"), F.coalesce(F.col(listed), F.lit(False)).alias("listed")).filter("key is not null")
    keys = saved(keys.groupBy("key").agg(F.max("listed").alias("listed")), "keys")
    total = keys.filter("listed").count()
    shards = max(1, -(-total * BITS_PER_KEY // (64 * max_words)))
    out = []
    for shard in range(shards):
        mine = keys.filter(F.pmod(F.xxhash64("key"), F.lit(shards)) == shard)
        inside, outside = mine.filter("listed").select("key"), mine.filter("not listed").select("key")
        levels: list[Level] = []
        count = inside.count()
        while count:
            level = _level(inside, count, len(levels))
            levels.append(level)
            inside, outside = saved(outside.filter(_hit(F.col("key"), level)), "false-positives"), inside
            count = inside.count()
        out.append(levels)
    return Cascade(shards, out)


def judged(pages: DataFrame, url: str, rules: list[tuple[str, str, str]], listed: Column) -> DataFrame:
    """``pages`` with host, path, rule and verdict; existing columns of these names are replaced.

    Hosts for which ``listed``, an expression on ``host``, is true are blocked where no rule fits, all others allowed. Each row is judged by itself, repeated rows alike;
    an empty host is not on any list.
    """
    names = ("host", "path", "rule", "verdict")
    if url in names:
        raise ValueError(f"the url column may not be called {url}")
    host, path = host_and_path(url)
    df = pages.drop(*names).select("*", host.alias("host"), path.alias("path"))
    keys = df.select("host", (listed & (F.col("host") != "")).alias("listed"))
    filters = cascade(keys, "host", "listed")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(filters.listed(F.col("host")), "block").otherwise("allow")
    return df.select("*", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))
