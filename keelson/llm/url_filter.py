"""Exact URL lists as Bloom filter cascades, with DataFrame functions only.

A cascade holds a list of keys so that membership is exact for every key of a known universe, without a join: level 0 is a
Bloom filter of the listed keys, level 1 one of the universe's keys that pass level 0 wrongly, level 2 one of the listed
keys that pass level 1, and so on until a level has no false positive. Each level is about a hundredth of the one two
before it, so the whole costs little more than level 0: ``BITS_PER_KEY`` bits a listed key. The words of a level are
folded into the plan as an array literal, whose size is checked against ``MAX_BITS``: it depends on the list, never on
the pages.

The universe of a page table is every key its URLs can ask for: each suffix of the host at a dot, joined with each prefix
of the path that is as long as some rule's path.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import bounded_collect, release, stored

BITS_PER_KEY = 12
HASHES = 6
MAX_BITS = 1 << 24
MAX_LEVELS = 64
MAX_PATH_LENGTHS = 1024
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES_SCHEMA = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.regexp_extract(F.regexp_replace(_rest(url), "^[^/?#]*", ""), "^[^?#]*", 0)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


@dataclass(frozen=True)
class Level:
    bits: int
    words: list[int]
    seed: int

    def holds(self, key: Column) -> Column:
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        test = F.lit(True)
        for p in _positions(key, self.bits, self.seed):
            test = test & (F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return test


@dataclass(frozen=True)
class Cascade:
    levels: list[Level]

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe the cascade was built over, and for every listed key."""
        answer: Column | None = None
        for i in reversed(range(len(self.levels))):
            passed = F.lit(i % 2 == 0) if answer is None else answer
            answer = F.when(self.levels[i].holds(key), passed).otherwise(F.lit(i % 2 == 1))
        return F.lit(False) if answer is None else answer


def _positions(key: Column, bits: int, seed: int) -> list[Column]:
    """Two independent hashes give all positions; ``bits`` is a power of two."""
    a = F.xxhash64(key, F.lit(seed)).bitwiseAND(F.lit((1 << 48) - 1))
    b = F.xxhash64(F.lit(seed), key).bitwiseAND(F.lit((1 << 48) - 1))
    return [(a + b * F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


def _encode(keys: DataFrame, seed: int, bits_per_key: int, max_bits: int) -> Level | None:
    n = keys.count()
    if not n:
        return None
    bits = 64
    while bits < n * bits_per_key:
        bits *= 2
    if bits > max_bits:
        raise ValueError(f"{n} keys need a filter of {bits} bits, more than max_bits={max_bits}")
    position = F.explode(F.array(*_positions(F.col("key"), bits, seed)))
    words = keys.select(position.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    filled = [0] * (bits // 64)
    for row in bounded_collect(words, bits // 64, "filter words"):
        filled[row["w"]] = row["bits"]
    return Level(bits, filled, seed)


def build_cascade(listed: DataFrame, universe: DataFrame, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS) -> Cascade:
    """A cascade for the column ``key`` of ``listed`` over that of ``universe``. Null keys take no part; repeats are one.

    The universe is scanned once, filtered by level 0 before anything is shuffled; later levels see only what passed.
    """
    listed = listed.select("key").where(F.col("key").isNotNull()).distinct()
    first = _encode(listed, 0, bits_per_key, max_bits)
    if first is None:
        return Cascade([])
    levels = [first]
    passed = universe.select("key").where(first.holds(F.col("key"))).distinct().join(listed, "key", "left_anti")
    false = stored(passed, "cascade")
    sides = [listed, false]
    while (level := _encode(sides[1], len(levels), bits_per_key, max_bits)) is not None:
        levels.append(level)
        if len(levels) > MAX_LEVELS:
            raise ValueError("the cascade does not end")
        sides = [sides[1], sides[0].where(level.holds(F.col("key")))]
    release(false)
    return Cascade(levels)


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Host suffixes joined with path prefixes of the given lengths; longer hosts first, then longer prefixes."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in sorted(lengths, reverse=True)]), lambda n: n <= F.length(path))
    keys = F.flatten(F.transform(F.filter(suffixes, lambda s: s != ""), lambda s: F.transform(
        fitting, lambda n: F.concat(s, F.substring(path, F.lit(1), n)))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(keys)


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = "allow",
               bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS) -> DataFrame:
    """The verdict of the longest rule that fits each URL: ``id, host, path, rule, verdict``, one row per page row.

    A rule (host, path, verdict ``allow`` or ``block``) fits its host and all subdomains of it, if the URL's path starts
    with the rule's. Of two fitting rules of equal length the one with the longer host wins; a rule listed with both
    verdicts blocks. Rules without a host are ignored, a null path counts as empty. Without a fitting rule the row gets
    ``rule`` null and the verdict ``default``. Null URLs and URLs without ``://`` have empty host and path.
    """
    named = rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where(
        "host <> '' AND verdict IN ('allow', 'block')")
    lengths = [r["n"] for r in bounded_collect(named.select(F.length("path").alias("n")).distinct(), MAX_PATH_LENGTHS, "lengths of rule paths")]
    parsed = pages.select(F.col(id_column), host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path"))
    keys = candidate_keys(F.col("host"), F.col("path"), lengths) if lengths else F.array().cast("array<string>")
    universe = parsed.select(F.explode(keys).alias("key"))
    listed = named.select(F.concat("host", "path").alias("key"), "verdict")
    block, allow = (build_cascade(listed.where(F.col("verdict") == v), universe, bits_per_key, max_bits) for v in ("block", "allow"))
    fitting = F.filter(keys, lambda k: block.contains(k) | allow.contains(k))
    rule = F.aggregate(fitting, F.lit(""), lambda best, k: F.when(F.length(k) > F.length(best), k).otherwise(best))
    judged = parsed.withColumn("rule", F.nullif(rule, F.lit("")))
    return judged.withColumn("verdict", F.when(F.col("rule").isNull(), F.lit(default)).when(
        block.contains(F.col("rule")), F.lit("block")).otherwise(F.lit("allow")))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULES_SCHEMA)
