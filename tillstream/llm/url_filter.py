"""URL filters: a cascade of Bloom filters that is exact over the corpus's keys.

Level 1 encodes the listed keys. Every other key of the corpus that passes it
is encoded in level 2, every listed key that passes level 2 in level 3, and so
on until a level lets nothing wrong through. Over the key universe the cascade
was built for, membership is then exact: a key's answer is the parity of the
first level that rejects it. Judging a row reads only constants, so it needs no
join and no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_LEVEL_BITS = 1 << 27  # 16 MB: what a level may weigh in every task
MAX_BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    words: str  # comma-separated 64-bit words

    def test(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")  # folded to a constant
        return reduce(lambda x, y: x & y, [
            F.getbit(F.get(words, F.floor(p / F.lit(64)).cast("int")), (p % F.lit(64)).cast("int")) == 1
            for p in _places(key, self.number, self.bits, self.hashes)
        ])


def _places(key: Column, number: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def _level(keys: DataFrame, number: int, bits_per_key: int, hashes: int) -> Level | None:
    rows = keys.count()
    if not rows:
        return None
    bits = -(-rows * bits_per_key // 64) * 64
    if bits > MAX_LEVEL_BITS:
        raise ValueError(f"level {number} would take {bits} bits; raise bits_per_key of the level before it")
    place = F.explode(F.array(*_places(F.col("key"), number, bits, hashes))).alias("p")
    filled = {
        r["w"]: r["bits"] for r in keys.select(place)
        .groupBy(F.floor(F.col("p") / 64).alias("w"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(p % 64 AS INT)))").alias("bits"))
        .collect()  # at most MAX_LEVEL_BITS / 64 rows
    }
    return Level(number, bits, hashes, ",".join(str(filled.get(w, 0)) for w in range(bits // 64)))


def build_cascade(listed: DataFrame, universe: DataFrame, bits_per_key: int = 24, hashes: int = 6) -> list[Level]:
    """Levels for ``listed.key`` over ``universe.key`` (repeats allowed). Only
    false positives are shuffled; the universe itself is just filtered, with the
    listed keys in every task while there are at most MAX_BROADCAST_KEYS."""
    wanted = listed.select("key").filter("key IS NOT NULL").distinct()
    small = wanted.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS
    others = universe.select("key").join(F.broadcast(wanted) if small else wanted, "key", "left_anti")
    levels: list[Level] = []
    inside, outside = wanted, others
    while (level := _level(inside, len(levels) + 1, bits_per_key, hashes)) is not None:
        levels.append(level)
        wrong = written(outside.filter(level.test(F.col("key"))).distinct(), "cascade")
        inside, outside = wrong, inside
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Whether the key is listed; exact for keys of the universe, else as good
    as a Bloom filter."""
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        answer = F.when(~level.test(key), F.lit(level.number % 2 == 0)).otherwise(answer)
    return answer


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` (A-Z lower-cased) and the path; both empty
    for a null url or one without ``://``."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def candidate_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Keys a rule could have to fit this url: the host's suffixes of up to
    ``labels`` labels, joined with the path's prefixes of the given lengths."""
    parts = F.split(host, "\\.")
    last = F.slice(parts, F.greatest(F.lit(1), F.size(parts) - F.lit(labels - 1)), F.lit(labels))
    suffixes = F.transform(last, lambda _, i: F.array_join(F.slice(last, i + 1, F.lit(labels)), "."))
    prefixes = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull()
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``; columns of these names are replaced.

    ``rules`` are (host, path, ``allow`` | ``block``). A rule fits its host and
    all subdomains when the path starts with the rule's; the longest fitting
    rule decides, block before allow where both list the same rule. A url no
    rule fits is in neither cascade and gets ``default``. Null, empty and
    scheme-less urls have an empty host and path and fit no rule with a host. An
    empty table gives an empty result; repeated rows are judged alike.
    """
    spark = pages.sparkSession
    if not rules:
        rules = [("", "\u0000", "allow")]
    labels = max(h.count(".") + 1 for h, _, _ in rules)
    lengths = sorted({len(p) for _, p, _ in rules})
    host, path = host_and_path(F.col(url))
    judged = pages.withColumns({"host": host, "path": path})
    keys = candidate_keys(F.col("host"), F.col("path"), labels, lengths)
    universe = judged.select(F.explode(F.array_distinct(keys)).alias("key"))
    cascades = {
        verdict: build_cascade(
            spark.createDataFrame([(h + p,) for h, p, v in rules if v == verdict], "key string"), universe
        )
        for verdict in ("block", "allow")
    }

    def fitting(verdict: str) -> Column:
        return F.transform(
            F.filter(keys, lambda k: member(cascades[verdict], k)),
            lambda k: F.struct(F.length(k).alias("n"), F.lit(verdict == "block").alias("first"),
                               k.alias("rule"), F.lit(verdict).alias("verdict")),
        )

    best = F.array_max(F.concat(fitting("block"), fitting("allow")))
    return (
        judged.withColumn("rule", best)
        .withColumn("verdict", F.coalesce(F.col("rule.verdict"), F.lit(default)))
        .withColumn("rule", F.col("rule.rule"))
    )
