"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming
blocks, exact weighted-shingle similarity. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import once

SHINGLE = 5
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1  # some block of two fingerprints within it differs in at most BLOCK_RADIUS bits
MAX_BROADCAST = 200_000                   # index entries that every task holds at once


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(found: Column, size: int) -> Column:
    """64-bit hashes of every ``size`` consecutive words, repeats included."""
    last = F.size(found) - F.lit(size)
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(size)]),
    )).otherwise(F.array().cast("array<bigint>"))


def fingerprint(hashes: Column, longest: int) -> Column:
    """SimHash of an array of at most ``longest`` hashes: a bit is 1 if it is
    set in over half of them. A long holds 64 / lane counters side by side, so
    one addition counts that many bits."""
    lane = next(w for w, most in ((8, 63), (16, 2**14 - 1), (32, 2**30 - 1)) if longest <= most)
    ones = F.lit(sum(1 << at for at in range(0, 64, lane))).cast("bigint")
    names = [f"c{i}" for i in range(lane)]
    zero = F.struct(*[F.lit(0).cast("bigint").alias(n) for n in names])
    counts = lambda acc, h: F.struct(*[
        (acc[n] + F.shiftrightunsigned(h, i).bitwiseAND(ones)).alias(n) for i, n in enumerate(names)])

    def bits(acc: Column) -> Column:
        enough = ones * (F.lit(1 << (lane - 2)).cast("bigint") - 1 - F.floor(F.size(hashes) / 2))
        lifted = [F.shiftleft(F.shiftrightunsigned(acc[n] + enough, lane - 2).bitwiseAND(ones), i) for i, n in enumerate(names)]
        return reduce(lambda a, b: a.bitwiseOR(b), lifted)

    return F.aggregate(hashes, zero, counts, bits)


def _block(fp: Column, number: int) -> Column:
    return F.shiftrightunsigned(fp, number * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("bigint")).cast("int")


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two arrays of hashes: a shingle weighs as often as it occurs."""
    times = lambda where, x: F.size(F.filter(where, lambda y: y == x))
    common = F.aggregate(F.array_distinct(a), F.lit(0), lambda acc, x: acc + F.least(times(a, x), times(b, x)))
    return common / (F.size(a) + F.size(b) - common)


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    found = benchmark.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("w"))
    found = found.withColumn("k", F.least(F.lit(SHINGLE), F.size("w"))).filter("k > 0")
    own = reduce(lambda rest, k: F.when(F.col("k") == k, shingles(F.col("w"), k)).otherwise(rest),
                 range(1, SHINGLE), shingles(F.col("w"), SHINGLE))
    return found.select("item_id", "k", once(own).alias("item"))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, word, similarity): for each document that holds a
    benchmark item, the most similar window of as many words as the item and
    where it begins (in words from 0; the first of equals).

    1. A window with similarity ``threshold`` lacks at most a fifth of an item's
       shingles, so it holds one of any fifth and one more. A scan looks the
       document's shingles up in that part of each item; windows around no such
       hit cannot qualify and are not formed. A window is formed at its first hit.
    2. Windows get SimHash fingerprints. Items are indexed by each of eight
       bytes of theirs with up to two bits changed, which finds every item
       within a radius of 23 bits; windows at the threshold are 8 to 10 bits
       away on average and beyond 23 about once in 100,000.
    3. Fingerprints within the radius are verified by the exact weighted Jaccard
       similarity of the five-word shingles.

    The documents are scanned once per MAX_BROADCAST entries of the items' index
    and never shuffled; only hits move. Texts shorter than an item are one
    window. Items of fewer than five words count as one shingle, items without
    words match nothing; null or empty texts have no windows. Rows with a null
    id are scanned like others and reported together; repeated rows report once.
    """
    spark = docs.sparkSession
    items = _items(benchmark, item_col, item_text_col).cache()
    try:
        kinds = [r["k"] for r in items.select("k").distinct().collect()]  # at most five
        longest = items.agg(F.max(F.size("item"))).first()[0] or 1
        entries = items.agg(F.sum(F.size("item") + BLOCKS * 37)).first()[0] or 0
    finally:
        items.unpersist()
    blocks = -(-entries // MAX_BROADCAST)
    found = None
    for k in kinds:
        for number in range(blocks):
            own = items.filter((F.col("k") == k) & (F.pmod(F.xxhash64("item"), F.lit(blocks)) == number))
            part = _matches(docs, own, k, longest, threshold, id_col, text_col)
            found = part if found is None else found.unionByName(part)
    if found is None:
        kind = benchmark.schema[item_col].dataType.simpleString()
        return spark.createDataFrame([], f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id {kind}, word int, similarity double")
    best = F.max_by(F.struct("word", "similarity"), F.struct("similarity", -F.col("word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.word", "best.similarity")


def _matches(docs: DataFrame, items: DataFrame, k: int, longest: int, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """Verified (doc_id, item_id, word, similarity) of the items with ``k``-word shingles."""
    size = F.size("item")
    fewest = F.floor(size * (1 - threshold) + 1e-9).cast("int") + 1
    probes = items.select("item_id", size.alias("m"), F.slice(F.array_sort("item"), F.lit(1), fewest).alias("probe"))
    probes = F.broadcast(probes.select("m", "probe", F.explode(F.array_distinct("probe")).alias("h")).distinct())

    # The words are a column of their own: within the expression they would be split anew for every shingle.
    split = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("found"))
    scanned = split.select("doc_id", once(shingles(F.col("found"), k)).alias("hs"))
    hits = (
        scanned.select("doc_id", "hs", F.posexplode("hs").alias("p", "h")).join(probes, "h")
        .select("doc_id", "m", "probe", "p", F.size("hs").alias("n"),
                F.greatest(F.col("p") - F.col("m") + 1, F.lit(0)).alias("from"), "hs")
        .select("doc_id", "m", "probe", "p", "n", "from",
                F.slice("hs", F.col("from") + 1, 2 * F.col("m")).alias("near"))
    )
    # Starts after the hit before this one, so that no window is formed twice for a probe.
    before = F.slice("near", F.lit(1), F.col("p") - F.col("from"))
    last = F.array_max(F.transform(before, lambda h, i: F.when(F.array_contains("probe", h), i)))
    low = F.greatest(F.col("from"), F.col("from") + F.coalesce(last + 1, F.lit(0)))
    high = F.least(F.col("p"), F.greatest(F.col("n") - F.col("m"), F.lit(0)))
    starts = hits.withColumn("word", F.explode(F.when(low <= high, F.sequence(low, high))))
    windows = starts.select(
        "doc_id", "m", "word", F.slice("near", F.col("word") - F.col("from") + 1, F.col("m")).alias("w"),
    ).select("*", once(fingerprint(F.col("w"), longest)).alias("fp"))

    printed = items.select("item_id", "item", size.alias("m"), once(fingerprint(F.col("item"), longest)).alias("item_fp"))
    flips = [0, *(1 << a for a in range(BLOCK_BITS)), *(1 << a | 1 << b for a in range(BLOCK_BITS) for b in range(a))]
    index = printed.select("*", F.explode(F.array(*[
        F.struct(F.lit(b).alias("block"), _block(F.col("item_fp"), b).alias("value")) for b in range(BLOCKS)])).alias("at"))
    index = index.select("item_id", "item", "m", "item_fp", "at.block", F.explode(F.transform(
        F.array(*[F.lit(f) for f in flips]), lambda f: F.col("at.value").bitwiseXOR(f))).alias("value"))
    keyed = windows.select("*", F.explode(F.array(*[
        F.struct(F.lit(b).alias("block"), _block(F.col("fp"), b).alias("value")) for b in range(BLOCKS)])).alias("at"))
    keyed = keyed.select("doc_id", "m", "word", "w", "fp", "at.block", "at.value")
    apart = F.col("fp").bitwiseXOR(F.col("item_fp"))
    first = F.coalesce(*[F.when(F.bit_count(_block(apart, b)) <= BLOCK_RADIUS, F.lit(b)) for b in range(BLOCKS)])
    near = keyed.join(F.broadcast(index), ["m", "block", "value"]).filter((F.bit_count(apart) <= RADIUS) & (first == F.col("block")))
    return (
        near.select("doc_id", "item_id", "word", once(similarity(F.col("w"), F.col("item"))).alias("similarity"))
        .filter(F.col("similarity") >= threshold)
    )
