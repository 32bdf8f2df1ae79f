"""Merkle manifest: every row a leaf, one tree per group, one tree over the groups.

A node is labelled with the interval of leaf ranks it covers. Ranks come from a
range partitioning and counts per task, so no task orders a whole group. Trees
grow a tier of TIER levels at a time: one shuffle brings the at most FAN**TIER
nodes under a node of the tier's top together. Proofs go down again tier by
tier: an item joins the nodes of its tier by the bucket of its rank (no key of
that join holds more than FAN**TIER items), those whose intervals contain it
are its ancestors, and what an ancestor's children cover besides the item are
its siblings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import once, written

FAN = 3
TIER = 5
_PATH = "array<struct<left:binary,right:binary>>"  # digests are kept as bytes, and hashed and given out as hex text


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b"").cast("binary"), lambda a, d: F.concat(a, d))


def _text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings, from the bottom up."""
    return F.aggregate(path, leaf, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _span(level: Column) -> Column:
    """Leaves under a full node of a level: FAN ** level, as a whole number."""
    powers = F.array(*[F.lit(FAN**k).cast("bigint") for k in range(64) if FAN**k < 1 << 63])
    return F.get(powers, level)


def _whole(value: Column, by: Column | int) -> Column:
    return F.call_function("div", value, by if isinstance(by, Column) else F.lit(by).cast("bigint"))


def ranked(items: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``items`` with ``rank`` (from 0, by ``order``) and ``size`` within the
    group; null groups are one group, nulls come first. Items that agree in all
    of ``order`` are told apart by where they lay. A group is spread over as many tasks as it
    needs, and so are equal items."""
    numbered = written(items.withColumn("_row", F.monotonically_increasing_id()), label)
    by = [group, *order, "_row"]
    placed = numbered.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = written(placed.withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.shiftright("_at", 33)), label)
    own = Window.partitionBy("_group")
    runs = (
        placed.groupBy(F.col(group).alias("_group"), F.col("_task").alias("_in"))
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))  # a row per task and group in it
        .withColumn("size", F.sum("_n").over(own))
        .withColumn("_before", F.sum("_n").over(own.orderBy("_in")) - F.col("_n"))
    )
    met = placed.join(runs, placed[group].eqNullSafe(runs["_group"]) & (placed["_task"] == runs["_in"]))
    met = met.withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first"))
    return met.drop("_row", "_at", "_task", "_group", "_in", "_first", "_n", "_before")


def _threes(digests: str) -> Column:
    """The children of each node of the next level."""
    number = F.sequence(F.lit(0), _whole(F.size(digests) - 1, FAN).cast("int"))
    return F.transform(number, lambda j: F.slice(digests, j * FAN + 1, F.lit(FAN)))


def _labelled(level: int, kids: str, digests: str) -> Column:
    """The nodes of a level with the first rank they cover, counted from ``from``."""
    width = F.lit(FAN**level).cast("bigint")
    return F.transform(kids, lambda k, j: F.struct(
        F.lit(level).alias("level"), (F.col("from") + j * width).alias("lo"), F.least(F.col("from") + (j + 1) * width, "size").alias("hi"),
        F.get(digests, j).alias("digest"), k.alias("kids")))


def grow(leaves: DataFrame, most: int, label: str) -> list[DataFrame]:
    """The nodes above ``leaves`` (``grp, rank, size, digest``), the largest
    group of which has ``most``, tier by tier. A row holds the nodes of a tier
    under one node of its top: ``grp, size, block, nodes``."""
    tiers, base = [], 0
    below = leaves.select("grp", "size", F.col("rank").alias("lo"), "digest")
    while FAN**base < most:
        top = FAN ** (base + TIER)
        row = (
            below.filter(F.col("size") > FAN**base)
            .groupBy("grp", "size", _whole(F.col("lo"), top).alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("lo", "digest"))).alias("own"))  # at most FAN**TIER
            .select("grp", "size", "block", (F.col("block") * top).alias("from"), F.col("own.digest").alias("d0"))
        )
        for i in range(1, TIER + 1):
            row = row.withColumn(f"k{i}", once(_threes(f"d{i - 1}")))
            row = row.withColumn(f"d{i}", once(F.transform(f"k{i}", lambda k: F.unhex(F.sha2(_text(_joined(k)), 256)))))
        nodes = F.concat(*[_labelled(base + i, f"k{i}", f"d{i}") for i in range(1, TIER + 1)])
        nodes = F.filter(nodes, lambda n: F.col("size") > _span(n["level"] - 1))  # not above the root
        tiers.append(written(row.select("grp", "size", "block", nodes.alias("nodes")), label))
        base += TIER
        below = _at_level(tiers[-1], base)
    return tiers


def _at_level(tier: DataFrame, level: int) -> DataFrame:
    """The nodes of a tier that have the level, one a row."""
    nodes = tier.select("grp", "size", F.explode("nodes").alias("n")).filter(F.col("n.level") == level)
    return nodes.select("grp", "size", F.col("n.lo").alias("lo"), F.col("n.digest").alias("digest"))


def _siblings(node: Column, at: Column) -> Column:
    """What an ancestor's children cover besides the one that covers rank ``at``, on either side of it."""
    width = _span(node["level"] - 1)

    def beside(keep) -> Column:
        return _joined(F.filter(node["kids"], lambda _, i: keep(node["lo"] + i * width, node["lo"] + (i + 1) * width)))

    return F.struct(beside(lambda lo, hi: hi <= at).alias("left"), beside(lambda lo, hi: lo > at).alias("right"))


def descend(leaves: DataFrame, tiers: list[DataFrame], seeds: DataFrame) -> DataFrame:
    """``leaves`` with ``path`` and ``subroot``. ``seeds`` gives for each group
    (``grp, size, subroot, path``) the path that goes on above its root.

    An item meets the nodes of its tier by the block of its rank; those whose
    interval contains it are its ancestors there. A block serves FAN**TIER items."""
    none = F.array().cast(_PATH)
    above = None
    for number in reversed(range(max(len(tiers), 1))):
        base, top = number * TIER, FAN ** ((number + 1) * TIER)
        ends = (F.col("size") <= top) & (F.lit(True) if number == 0 else F.col("size") > FAN**base)  # groups whose root is in this tier
        roots = seeds.filter(ends).select("grp", F.lit(0).cast("bigint").alias("lo"), "subroot", "path")
        above = roots if above is None else above.unionByName(roots)
        above = above.select(F.col("grp").alias("a_grp"), _whole(F.col("lo"), top).alias("a_block"), "subroot", F.col("path").alias("rest"))
        if tiers:
            held = tiers[number].select(F.col("grp").alias("t_grp"), F.col("block").alias("t_block"), "nodes")
            above = above.join(held, above["a_grp"].eqNullSafe(held["t_grp"]) & (above["a_block"] == held["t_block"]), "left")
        else:
            above = above.withColumn("nodes", F.lit(None).cast("array<struct<level:int,lo:bigint,hi:bigint,digest:binary,kids:array<binary>>>"))
        if number == 0:
            items = leaves.withColumn("lo", F.col("rank"))
        else:
            items = _at_level(tiers[number - 1], base).filter(F.col("size") > FAN**base)
        items = items.withColumn("block", _whole(F.col("lo"), top))
        found = items.join(above, items["grp"].eqNullSafe(above["a_grp"]) & (items["block"] == above["a_block"]))
        ancestors = F.filter("nodes", lambda n: (n["lo"] <= F.col("lo")) & (F.col("lo") < n["hi"]))  # by level
        own = F.coalesce(F.transform(ancestors, lambda n: _siblings(n, F.col("lo"))), none)
        found = found.withColumn("path", F.concat(own, "rest"))
        above = found.select("grp", "lo", "subroot", "path") if number else found
    return above.select(*leaves.columns, "subroot", "path")


def _roots(leaves: DataFrame, tiers: list[DataFrame]) -> DataFrame:
    found = leaves.filter("size = 1").select("grp", "size", "digest")
    for number, tier in enumerate(tiers):
        for level in range(number * TIER + 1, (number + 1) * TIER + 1):
            low, high = FAN ** (level - 1), FAN**level
            found = found.unionByName(_at_level(tier.filter(F.col("size").between(low + 1, high)), level).drop("lo"))
    return found


def manifest(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             group: str = "source", key: str = "doc_id", carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``group``, ``leaf``, ``subroot``,
    ``root`` and ``path``, the siblings left and right of the leaf and of each
    of its ancestors up to the root; ``carry`` adds columns worked out of the row.

    A leaf is the digest of ``columns``, so a changed, lost or moved value
    changes the root. Leaves ascend by ``key`` within their group (null keys
    first), rows of one key by their digest; equal rows have equal leaves and
    hold neighbouring places in no certain order. Null groups are one group,
    before all others; empty texts count as texts of no bytes, unlike nulls.
    Long texts only meet the digest: nothing else of a row is shuffled. An
    empty table has no rows and no root. Other columns of ``docs``, whatever
    their names, are left alone.
    """
    spark = docs.sparkSession
    own = docs.select(
        F.col(key).alias("own_key"), F.col(group).alias("grp"), F.unhex(leaf_digest(*[F.col(c) for c in columns])).alias("digest"),
        *[c.alias(f"carry_{name}") for name, c in (carry or {}).items()])
    leaves = written(ranked(own, "grp", ["own_key", "digest"], "leaves"), "leaves")
    most = leaves.agg(F.max("size")).first()[0] or 0
    tiers = grow(leaves, most, "nodes")
    roots = _roots(leaves, tiers).withColumnRenamed("size", "leaves").withColumn("all", F.lit(0))
    roots = written(ranked(roots, "all", ["grp"], "roots").withColumnRenamed("grp", "name").withColumnRenamed("all", "grp"), "roots")
    many = roots.agg(F.max("size")).first()[0] or 0
    upper = grow(roots, many, "upper-nodes")
    (root, *_) = [bytes(r[0]) for r in _roots(roots, upper).select("digest").take(1)] or [None]
    start = spark.createDataFrame([(0, many, [])], f"grp int, size bigint, path {_PATH}").withColumn("subroot", F.lit(root).cast("binary"))
    seeds = written(
        descend(roots, upper, start).select(F.col("name").alias("grp"), F.col("leaves").alias("size"), F.col("digest").alias("subroot"), "path"), "seeds")
    path = F.transform("path", lambda s: F.struct(_text(s["left"]).alias("left"), _text(s["right"]).alias("right")))
    return descend(leaves, tiers, seeds).select(
        F.col("own_key").alias(key), F.col("grp").alias(group), _text(F.col("digest")).alias("leaf"), _text(F.col("subroot")).alias("subroot"),
        _text(F.lit(root).cast("binary")).alias("root"), path.alias("path"), *[F.col(f"carry_{name}").alias(name) for name in carry or {}])
