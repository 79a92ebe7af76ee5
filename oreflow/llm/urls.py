"""URL filters as Bloom filter cascades (operator 8).

A list of keys is encoded against all keys that the corpus can ask for. Level 0 is a Bloom filter of
the listed keys; level 1 one of the corpus's keys that level 0 takes for listed ones; level 2 one
of the listed keys that level 1 holds too, and so on until a level makes no mistake. A key is listed
if the first level that does not hold it is an odd one. Over the corpus's keys this is exact, and
testing a row joins nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import fresh, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A cascade's bits travel with the plan, so their number has a limit; see Cascade.
MAX_BITS = 1 << 22


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    """A rule's host and path: ``example.net/en/`` covers that host, its subdomains and paths from ``/en/`` on."""
    host, slash, path = rule.partition("/")
    if not host:
        raise ValueError(f"a rule needs a host: {rule!r}")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path


def keys_of(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Every key that a rule for this url could have, longest first, then the longer host first.

    A key is a suffix of the host at a dot, and a prefix of the path that is as long as some rule's
    path. No host, no keys.
    """
    labels = F.split(host, r"\.")
    n = F.size(labels)
    hosts = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, n), "."))
    wanted = F.filter(
        F.array(*[F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in sorted(set(lengths))]),
        lambda p: p.isNotNull(),
    )
    pairs = F.flatten(F.transform(hosts, lambda h: F.transform(wanted, lambda p: F.struct(
        (-F.length(h) - F.length(p)).alias("a"), (-F.length(h)).alias("b"), F.concat(h, p).alias("key")
    ))))
    keys = F.transform(F.sort_array(pairs), lambda x: x["key"])
    return F.when(F.length(host) > 0, keys).otherwise(F.array().cast("array<string>"))


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    seed: int
    words: tuple[int, ...]

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed), F.lit(k)), F.lit(self.bits)) for k in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        """Every bit of the key is set."""
        words = F.lit(list(self.words)) if self.words else F.array().cast("array<bigint>")
        found = F.lit(True)
        for place in self.positions(key):
            word = F.get(words, F.shiftright(place, 6).cast("int"))
            bit = F.call_function("shiftright", word, F.pmod(place, F.lit(64)).cast("int"))
            found = found & (bit.bitwiseAND(F.lit(1)) == 1)
        return found


@dataclass(frozen=True)
class Cascade:
    """Membership in a list, exact for the keys it was built over.

    Level 0's rate of mistakes is chosen as listed / (sqrt(2) * others), later levels' as one half, so a
    cascade takes about 1.44 * log2(others / listed) + 4 bits a listed key: it grows with the list, and
    with the corpus only by the logarithm. ``build`` refuses a list that would need more than
    ``MAX_BITS``; cut such a list by a hash of the key and filter by one cascade after the other.
    """

    levels: tuple[Level, ...]

    def lists(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for k, level in reversed(list(enumerate(self.levels))):
            answer = F.when(level.holds(key), answer).otherwise(F.lit(k % 2 == 1))
        return answer


def _level(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """A Bloom filter of ``n`` keys, its bits set by an aggregate and sent back as 64-bit words."""
    hashes = max(1, round(-math.log2(rate)))
    bits = 64 * max(1, math.ceil(n * hashes / math.log(2) / 64))
    if bits > MAX_BITS:
        raise ValueError(f"{n} keys need {bits} bits, over {MAX_BITS}: cut the list by a hash of the key")
    empty = Level(bits, hashes, seed, ())
    place = F.explode(F.array(*empty.positions(F.col("key")))).alias("place")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("place", F.lit(64)).cast("int"))
    word = F.shiftright("place", 6).alias("word")
    rows = keys.select(place).groupBy(word).agg(F.bit_or(bit).alias("set")).collect()
    words = [0] * (bits // 64)
    for row in rows:
        words[row["word"]] = row["set"]
    return Level(bits, hashes, seed, tuple(words))


def build(listed: DataFrame, universe: DataFrame, most_levels: int = 64) -> Cascade:
    """A cascade for the distinct ``key`` column of ``listed`` over that of ``universe``.

    Listed keys outside the universe are left out: nothing can ask for them. The key tables are
    written once; each level reads only what the one before it got wrong.
    """
    all_keys = universe.select("key").distinct()
    ours = listed.select("key").distinct().withColumn("ours", F.lit(True))
    joined = all_keys.join(ours, "key", "left").withColumn("ours", F.col("ours").isNotNull())
    marked = written(joined, "url-keys")
    counts = {row["ours"]: row["n"] for row in marked.groupBy("ours").agg(F.count("*").alias("n")).collect()}
    inside, outside = marked.filter("ours"), marked.filter("NOT ours")
    n, others = counts.get(True, 0), counts.get(False, 0)
    levels: list[Level] = []
    rate = min(0.5, max(n, 1) / (math.sqrt(2) * max(others, 1)))
    while n:
        level = _level(inside, n, rate, len(levels))
        levels.append(level)
        wrong = outside.filter(level.holds(F.col("key")))
        inside, outside = wrong, inside
        n, rate = wrong.count(), 0.5
        if len(levels) > most_levels:
            raise RuntimeError("the levels do not shrink")
    return Cascade(tuple(levels))


def filter_urls(
    pages: DataFrame,
    block: Sequence[str],
    allow: Sequence[str],
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    The longest rule that fits decides; of two that are equally long the one with the longer host; a
    rule on both lists blocks. Without a fitting rule ``rule`` is null and the verdict is ``default``.
    A null url, or one without ``://``, has an empty host and path and fits no rule. Repeated rows are
    judged alike; an empty table gives an empty one. Input columns of the four names are replaced.
    """
    rules = {"block": sorted({"".join(split_rule(r)) for r in block}), "allow": sorted({"".join(split_rule(r)) for r in allow})}
    lengths = [len(split_rule(r)[1]) for some in rules.values() for r in some]
    host, path = host_of(F.col(url)), path_of(F.col(url))
    keys = fresh(pages, "url_keys")
    rows = pages.withColumns({"host": host, "path": path})
    rows = rows.withColumn(keys, keys_of(F.col("host"), F.col("path"), lengths))
    universe = written(rows.select(F.explode(keys).alias("key")).distinct(), "url-universe")

    def listed(some: list[str]) -> DataFrame:
        items = F.array(*map(F.lit, some)) if some else F.array().cast("array<string>")
        return pages.sparkSession.range(1).select(F.explode(items).alias("key"))

    lists = {kind: build(listed(some), universe) for kind, some in rules.items()}
    hit = F.get(F.filter(keys, lambda k: lists["block"].lists(k) | lists["allow"].lists(k)), F.lit(0))
    verdict = F.when(F.col("rule").isNull(), default).when(lists["block"].lists(F.col("rule")), "block")
    judged = rows.withColumn("rule", hit).withColumn("verdict", verdict.otherwise("allow"))
    return judged.drop(keys)
