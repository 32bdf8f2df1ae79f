"""The best items of every user by inner product, exactly, without all pairs.

Items lie in order of falling norm. A user reads them block by block and leaves
a block out when no item of it can enter the list: the product with an item
is at most the product of both norms, and at most the product with the corner
of the block's box that suits the user. A user is done once the norms that
are left cannot reach the last place of the list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch
from .common import written

BLOCK = 256                # items that are tried or left out together
CHUNK_BYTES = 32 << 20     # of item vectors in every task at a time
_USERS_AT_ONCE = 1024
_SLACK = 1 + 1e-5          # bounds are taken a little high, so that rounding leaves nothing out
_STATE = "user_id int, features array<float>, items array<int>, scores array<float>, blocks_read bigint, open boolean"


def _keys(scores: np.ndarray, items: np.ndarray) -> np.ndarray:
    """One number per entry that orders by score, then by the smaller item id."""
    bits = (scores.astype("f4") + np.float32(0)).view("u4")
    ordered = np.where(bits >> 31, ~bits, bits | np.uint32(0x80000000)).astype("u8")
    return ordered << np.uint64(32) | (np.uint64(0x7FFFFFFF) - items.astype("i8").astype("u8") & np.uint64(0xFFFFFFFF))


def _entries(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores and items of keys; the key 0 is an empty place."""
    high = (keys >> np.uint64(32)).astype("u4")
    bits = np.where(high >> 31, high & np.uint32(0x7FFFFFFF), ~high)
    low = (keys & np.uint64(0xFFFFFFFF)).astype("i8")
    scores = np.where(keys == 0, np.float32("-inf"), bits.view("f4"))
    return scores, (0x7FFFFFFF - low).astype("i4")


class Chunk:
    """Items by falling norm, cut into blocks, with what bounds each block."""

    def __init__(self, items: np.ndarray, vectors: np.ndarray, norms: np.ndarray):
        self.items, self.vectors = items, vectors.astype("f8")
        starts = np.arange(0, len(items), BLOCK)
        self.starts, self.norms, self.least = starts, norms[starts], norms[-1]
        self.high = np.maximum.reduceat(self.vectors, starts)
        self.low = np.minimum.reduceat(self.vectors, starts)

    def search(self, vectors: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Bring the lists ``best`` (keys, falling) up to date; blocks read by each user."""
        user = vectors.astype("f8")
        by_norm = np.outer(np.linalg.norm(user, axis=1), self.norms)
        by_box = np.maximum(user, 0) @ self.high.T + np.minimum(user, 0) @ self.low.T
        bound = np.minimum(by_norm, by_box)
        bound += (_SLACK - 1) * by_norm
        read = np.zeros(len(user), "i8")
        for number, start in enumerate(self.starts):
            floor, _ = _entries(best[:, -1])
            rows = np.flatnonzero(bound[:, number] >= floor)
            if not len(rows):
                continue
            read[rows] += 1
            end = start + BLOCK
            keys = _keys(user[rows] @ self.vectors[start:end].T, self.items[None, start:end])
            better = keys.max(axis=1) > best[rows, -1]
            rows, keys = rows[better], keys[better]
            n = best.shape[1]
            both = np.concatenate([best[rows], keys], axis=1)
            top = np.partition(both, both.shape[1] - n, axis=1)[:, -n:]
            best[rows] = np.sort(top, axis=1)[:, ::-1]
        return read


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _round(chunk, n: int, width: int):
    """mapInArrow function: one chunk of items for every user of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = chunk.value
        for whole in batches:
            for at in range(0, whole.num_rows, _USERS_AT_ONCE):
                batch = whole.slice(at, _USERS_AT_ONCE)
                vectors = _matrix(batch["features"], width)
                best = np.zeros((len(vectors), n), "u8")
                held = np.diff(batch["items"].offsets.to_numpy())
                place = np.arange(n) < held[:, None]
                best[place] = _keys(batch["scores"].flatten().to_numpy(), batch["items"].flatten().to_numpy())
                read = own.search(vectors, best)
                scores, items = _entries(best)
                full = best > 0
                ends = np.concatenate([[0], np.cumsum(full.sum(axis=1))]).astype("i4")
                floor = np.where(full[:, -1], scores[:, -1], -np.inf)
                reach = np.linalg.norm(vectors.astype("f8"), axis=1) * own.least * _SLACK
                yield pa.RecordBatch.from_arrays([
                    batch["user_id"], batch["features"],
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(items[full], pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(scores[full], pa.float32())),
                    pa.array(batch["blocks_read"].to_numpy() + read), pa.array(reach >= floor),
                ], names=["user_id", "features", "items", "scores", "blocks_read", "open"])

    return run


def _by_norm(items: DataFrame, rows: int) -> DataFrame:
    """Written items with their ``norm``, by falling norm, ``rows`` of them to a chunk. Places
    come from a range partitioning and counts per task."""
    spark = items.sparkSession
    path = scratch(spark, "item-chunks")
    order = [F.desc("norm"), F.col("id")]
    placed = items.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.withColumn("at", F.monotonically_increasing_id()).withColumn("task", F.shiftright("at", 33)).write.parquet(path)
    placed = spark.read.parquet(path)
    runs = placed.groupBy("task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    up = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row per task
    runs = runs.select("task", "first", (F.sum("n").over(up) - F.col("n")).alias("before"))
    rank = F.col("before") + F.col("at") - F.col("first")
    return placed.join(runs, "task").select("id", "features", "norm", F.call_function("div", rank, F.lit(rows)).alias("chunk"))


def best_items(users: DataFrame, items: DataFrame, n: int = 10, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(user_id, items, scores, blocks_read): for each of ``users`` the ``n``
    items of highest product, best first, smaller ids first among equals.

    Both tables hold (``id`` int, ``features`` array<float>) without nulls, ids once each,
    as a factor model gives them. Products are summed in double precision and
    compared as floats. Items are in the tasks one chunk of ``chunk_bytes`` at a
    time, whatever their number; users that are done leave after each chunk. Fewer
    than ``n`` items give shorter lists, no items empty ones.
    """
    spark = users.sparkSession
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("norm")
    items = written(items.select("id", "features", norm), "item-norms")  # what makes the items is done once
    head = items.select(F.size("features")).first()
    width = head[0] if head else 1
    rows = max(chunk_bytes // (width * 4 + 16), BLOCK)
    few = items.limit(rows + 1).toArrow()
    if few.num_rows <= rows:  # one chunk holds them all
        chunks = [few] if few.num_rows else []
    else:
        path = scratch(spark, "item-blocks")
        _by_norm(items, rows).repartition("chunk").write.partitionBy("chunk").parquet(path)
        stored = spark.read.parquet(path)
        numbers = sorted(r[0] for r in stored.select("chunk").distinct().collect())
        chunks = (stored.filter(F.col("chunk") == n).select("id", "features", "norm").toArrow() for n in numbers)  # at most chunk_bytes each
    state = users.select(
        F.col("id").cast("int").alias("user_id"), F.col("features").cast("array<float>").alias("features"),
        F.array().cast("array<int>").alias("items"), F.array().cast("array<float>").alias("scores"),
        F.lit(0).cast("bigint").alias("blocks_read"), F.lit(True).alias("open"))
    done = [state.filter("false")]
    for held in chunks:
        held = held.sort_by([("norm", "descending"), ("id", "ascending")]).combine_chunks()
        vectors = _matrix(held["features"].combine_chunks(), width)
        chunk = spark.sparkContext.broadcast(Chunk(held["id"].to_numpy().astype("i4"), vectors, held["norm"].to_numpy()))
        path = scratch(spark, "lists")
        state.mapInArrow(_round(chunk, n, width), _STATE).write.partitionBy("open").parquet(path)
        chunk.unpersist()
        after = spark.read.schema(_STATE).parquet(path)
        done.append(after.filter("NOT open"))
        state = after.filter("open")
        if not state.limit(1).count():
            break
    done.append(state)
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found.select("user_id", "items", "scores", "blocks_read")


def as_rows(lists: DataFrame) -> DataFrame:
    """(user_id, position, item_id, score), places from 0."""
    placed = lists.select("user_id", F.posexplode(F.arrays_zip("items", "scores")).alias("position", "entry"))
    return placed.select("user_id", "position", F.col("entry.items").alias("item_id"), F.col("entry.scores").cast("double").alias("score"))
