"""Audit of how quality filters interact when they are applied in every order.

Text statistics come from one pass of a byte machine over each batch of texts:
a table gives every byte its class, a second table gives every pair of classes
the actions of that step (a word begins, a word ends, a capital, a code point, a
symbol). Words go as spans into a hash table of the batch, keyed by text and
hash and compared byte by byte before they count as known. From there on rows
are counts: per part and set of failed filters, so that every order is arithmetic
on 32 counts.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import long_rows, written

# The white space of words, the symbols of filter D, the filters' names.
SPACES, SYMBOLS, FILTERS = b" \t\n\x0b\x0c\r", b"#$%&*|", "ABCDE"

_GAP, _PLAIN, _CAPITAL, _SYMBOL, _REST = range(5)  # classes of bytes; _REST continues a code point
_CLASS = np.full(256, _PLAIN, np.uint8)
_CLASS[list(SPACES)] = _GAP
_CLASS[list(SYMBOLS)] = _SYMBOL
_CLASS[ord("A") : ord("Z") + 1] = _CAPITAL
_CLASS[0x80:0xC0] = _REST
_BEGINS, _ENDS, _IS_CAPITAL, _IS_POINT, _IS_SYMBOL = 1, 2, 4, 8, 16
_ACTION = np.array([
    (_BEGINS if last == _GAP != now else 0) | (_ENDS if last != _GAP == now else 0) | (_IS_CAPITAL if now == _CAPITAL else 0)
    | (_IS_POINT if now != _REST else 0) | (_IS_SYMBOL if now == _SYMBOL else 0)
    for last in range(5) for now in range(5)], np.uint8)
_STEP = 4 << 20  # bytes of a piece of work; a longer text is one piece
_MIX = np.uint64(0x9E3779B97F4A7C15)
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of n bytes

STATS = "n_words bigint, n_distinct bigint, n_capitals bigint, n_points bigint, n_symbols bigint"


def _blocks(data: np.ndarray) -> np.ndarray:
    """Eight bytes from every place of ``data``, which ends in eight spare ones."""
    return np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))


def _hashes(at8: np.ndarray, start: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    found, todo, done = seed.copy(), np.arange(len(start)), 0
    while len(todo):
        left = size[todo] - done
        block = at8[start[todo] + done] & _KEEP[np.minimum(left, 8)]
        mixed = (found[todo] ^ block) * _MIX
        found[todo] = mixed ^ (mixed >> np.uint64(29))
        done += 8
        todo = todo[left > 8]
    return found


def _same(at8: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at ``a`` and at ``b`` agree, byte for byte."""
    same, todo, done = np.ones(len(a), bool), np.arange(len(a)), 0
    while len(todo):
        left = size[todo] - done
        unlike = ((at8[a[todo] + done] ^ at8[b[todo] + done]) & _KEEP[np.minimum(left, 8)]) != 0
        same[todo[unlike]] = False
        done += 8
        todo = todo[(left > 8) & ~unlike]
    return same


def _first_seen(at8: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """Which spans are the first of their word in their text: open addressing,
    all spans probing at once. Of those that meet in a free slot one takes it;
    a span that meets an equal one of its text is known, any other moves on."""
    first = np.zeros(len(start), bool)
    if not len(start):
        return first
    slots = 1 << int(2 * len(start) - 1).bit_length()
    owner = np.full(slots, -1, np.int64)
    where = _hashes(at8, start, size, (text.astype(np.uint64) + np.uint64(seed + 1)) * _MIX + size.astype(np.uint64))
    where = (where & np.uint64(slots - 1)).astype(np.int64)
    todo = np.arange(len(start))
    while len(todo):
        slot = where[todo]
        free = owner[slot] < 0
        owner[slot[free]] = todo[free]
        met = owner[slot]
        first[met[met == todo]] = True
        unlike = (met != todo) & ((text[met] != text[todo]) | (size[met] != size[todo]))
        ask = np.flatnonzero((met != todo) & ~unlike)
        unlike[ask] = ~_same(at8, start[met[ask]], start[todo[ask]], size[todo[ask]])
        todo = todo[unlike]
        where[todo] = (where[todo] + 1) & (slots - 1)
    return first


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Columns of STATS for the UTF-8 texts ``data[offsets[i]:offsets[i + 1]]``;
    ``offsets`` begin with 0."""
    texts, total = len(offsets) - 1, int(offsets[-1])
    out = np.zeros((texts, 5), np.int64)
    if not total:
        return out
    padded = np.zeros(total + 8, np.uint8)
    padded[:total] = data
    kind = np.full(total + 1, _GAP, np.uint8)
    kind[1:] = _CLASS[data]
    before = kind[:-1].copy()
    filled = np.flatnonzero(np.diff(offsets))
    before[offsets[filled]] = _GAP  # the machine starts anew with every text
    action = _ACTION[before * np.uint8(5) + kind[1:]]
    for column, bit in ((0, _BEGINS), (2, _IS_CAPITAL), (3, _IS_POINT), (4, _IS_SYMBOL)):
        out[filled, column] = np.add.reduceat((action & bit) != 0, offsets[filled], dtype=np.int64)
    start = np.flatnonzero(action & _BEGINS)
    ends = np.flatnonzero(action & _ENDS)
    last = offsets[filled + 1] - 1  # a text that ends within a word ends it
    ends = np.sort(np.concatenate([ends, last[kind[last + 1] != _GAP] + 1]))
    owner = np.repeat(np.arange(texts), out[:, 0])
    first = _first_seen(_blocks(padded), owner, start, ends - start)
    out[:, 1] = np.bincount(owner[first], minlength=texts)
    return out


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` and ``n_words, n_distinct, n_capitals,
    n_points, n_symbols`` of the text, in place of columns of these names. Null
    texts count as empty. Texts are worked in pieces of some megabytes, a longer text alone."""
    names = [f.split()[0] for f in STATS.split(", ")]
    kept = [c for c in docs.columns if c != text and c not in names]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), STATS])

    def run(batches):
        for batch in batches:
            column = batch.column(len(kept)).cast(pa.large_string())
            rows = column.buffers()
            offsets = np.frombuffer(rows[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
            data = np.frombuffer(rows[2], np.uint8) if rows[2] is not None else np.zeros(0, np.uint8)
            parts, at = [np.zeros((0, 5), np.int64)], 0
            while at < len(column):
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _STEP, "right")) - 1)
                parts.append(statistics(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]))
                at = to
            found = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), *(pa.array(found[:, i]) for i in range(5))], names=[*kept, *names])

    plain = docs.select(*kept, F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))
    return long_rows(plain).mapInArrow(run, schema)


def failures() -> dict[str, Column]:
    """What fails filters A to D, on the columns of STATS."""
    words, distinct, capitals, points = (F.col(c) for c in ("n_words", "n_distinct", "n_capitals", "n_points"))
    return {"A": words < 50, "B": distinct * 100 < words * 65, "C": capitals * 100 > points * 5, "D": F.col("n_symbols") > 0}


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``key, part, mask``: bit i of the mask says that the row fails filter i of
    FILTERS. E: a smaller key has the same text, null and empty texts being the
    same; rows of one key do not repeat each other, a null key neither repeats
    nor is repeated. Digests stand for equal texts; the least key of each
    combines before the shuffle, and the join back to a frequent text is one that AQE splits."""
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    own = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(plain, 256)).alias("digest"), plain.alias("body"))
    stats = with_statistics(own, "body")
    bits = sum((F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(failures().values())), F.lit(0))
    found = written(stats.select("key", "part", "digest", bits.alias("bits")), "judged")
    least = found.groupBy("digest").agg(F.min("key").alias("least"), F.max("key").alias("most")).filter("least < most")
    least = written(least.select("digest", "least"), "repeated-texts")
    met = found.join(least, "digest", "left")
    return met.select("key", "part", F.when(F.col("key") > F.col("least"), F.col("bits") + 16).otherwise(F.col("bits")).alias("mask"))


def _steps() -> Column:
    """All orders and their steps: what was applied before, and the step's filter."""
    return F.array(*[
        F.struct(
            F.lit("".join(FILTERS[i] for i in order)).alias("filter_order"), F.lit(n + 1).alias("step"),
            F.lit(sum(1 << i for i in order[:n])).alias("before"), F.lit(order[n]).alias("own"))
        for order in permutations(range(len(FILTERS))) for n in range(len(order))])


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley`` for every part, order of filters and step.

    ``labels`` (``key``, ``quality``, ``toxic``): a document is good or toxic if
    any of its label rows says so; labels of unknown or null keys change
    nothing. Null parts are the part of the empty string. Repeated rows count
    each. An empty table has no parts. Other columns, whatever their names, are
    left alone.
    """
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"))
    rows = judged(docs, key, text, part).join(marks, "key", "left")
    cells = rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("bad").alias("bad"))  # 32 a part
    sets = range(1 << len(FILTERS))

    def passing(column: str) -> Column:  # at [s]: rows that fail none of the filters in s
        return F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(s) == 0, F.col(column)).otherwise(F.lit(0))) for s in sets])

    alone = F.array(*[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(F.lit(0))) for i in range(len(FILTERS))])
    parts = cells.groupBy("part").agg(
        passing("n").alias("n"), passing("good").alias("good"), passing("bad").alias("bad"), alone.alias("alone"))
    parts = parts.withColumn("shapley", F.array(*[_shapley(i) for i in range(len(FILTERS))]))
    steps = parts.withColumn("s", F.explode(_steps()))
    after = F.col("s.before") + F.get(F.array(*[F.lit(1 << i) for i in range(len(FILTERS))]), F.col("s.own"))

    def lost(column: str) -> Column:
        return F.get(column, F.col("s.before")) - F.get(column, after)

    own = F.get(F.array(*[F.get("n", F.lit(0)) - F.get("n", F.lit(1 << i)) for i in range(len(FILTERS))]), F.col("s.own"))
    return steps.select(
        "part", "s.filter_order", "s.step", F.get("n", after).alias("kept"), lost("n").alias("removed"),
        (own - lost("n")).alias("redundant"), F.get("alone", F.col("s.own")).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("bad").alias("toxic_lost"), F.get("shapley", F.col("s.own")).alias("shapley"))


def _shapley(own: int) -> Column:
    """Rows that a filter removes, summed over all orders: each set that can
    stand before it, as often as orders begin with it."""
    count, total = len(FILTERS), F.lit(0).cast("bigint")
    for before in range(1 << count):
        if not before >> own & 1:
            size = bin(before).count("1")
            orders = factorial(size) * factorial(count - 1 - size)
            total = total + (F.get("n", F.lit(before)) - F.get("n", F.lit(before | 1 << own))) * orders
    return total
