"""Best-fit packing planned on the histogram of lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import map_texts, written
from .tokens import groups, memo

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids binary, part int, place bigint"


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, room: int = 2048,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids, part, place): each document's ids and
    ``end_id``, cut into pieces of ``room`` ids of which the first may be shorter.

    ``ids`` are little-endian 32-bit integers. ``place`` numbers the pieces of
    one length within the task ``part``: write the rows before using it.
    """

    def rows(pairs):
        encoder, counts, part = memo(tokenizer, "byte"), Counter(), TaskContext.get().partitionId()
        end = int(end_id).to_bytes(4, "little")
        for group in groups(pairs):
            for (doc, _), ids in zip(group, encoder.encode([t or "" for _, t in group])):
                ids += end
                total = len(ids) // 4
                start, piece, length = 0, 0, total % room or room
                while start < total:
                    yield doc, piece, start, length, ids[4 * start : 4 * (start + length)], part, counts[length]
                    counts[length] += 1
                    start, piece, length = start + length, piece + 1, room

    return map_texts(docs, rows, _PIECE, id_col, text_col, flush=2_000)


def plan(histogram: dict[int, int], room: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, rank, n, sequence, offset) says
    that the ``n`` pieces of this length from this rank on take one place each,
    at ``offset`` in the sequences from ``sequence`` on.

    Sequences with the same room left are one group of consecutive numbers, so
    the work follows the number of lengths, not of documents.
    """
    slots, made = [], 0
    groups_of: dict[int, list[tuple[int, int]]] = {}
    open_rooms: list[int] = []

    def leave(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in groups_of:
                groups_of[left] = []
                insort(open_rooms, left)
            groups_of[left].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, waiting = 0, histogram[length]
        while waiting:
            at = bisect_left(open_rooms, length)
            if at < len(open_rooms):
                left = open_rooms[at]
                first, n = groups_of[left].pop()
                if not groups_of[left]:
                    del groups_of[left], open_rooms[at]
            else:
                left, first, n = room, made, -(-waiting // (room // length))
                made += n
            each = min(left // length, waiting)  # the tightest sequence is filled before the next
            full = min(n, waiting // each)
            for k in range(each):
                slots.append((length, rank, full, first, room - left + k * length))
                rank += full
            waiting -= each * full
            leave(left - each * length, first, full)
            leave(left, first + full, n - full)
    return slots


def place(found: DataFrame, room: int = 2048) -> DataFrame:
    """``found`` (written pieces) with ``sequence_id`` and ``offset``.

    Only the histogram, at most ``room`` rows, comes to the driver. A piece's
    rank within its length is its place in its task plus the pieces of the tasks
    before; the plan, whose size depends on ``room`` alone, is looked up by
    (length, rank). No task gets all pieces of one length.
    """
    per_part = found.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("length", "part", F.coalesce(F.sum("n").over(up), F.lit(0)).alias("_before"))
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = np.array(plan(histogram, room) or np.empty((0, 5)), dtype=np.int64).reshape(-1, 5)
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    first_of = {int(n): int(i) for n, i in zip(*np.unique(slots[:, 0], return_index=True))}
    ends = {n: i for n, i in zip(first_of, [*list(first_of.values())[1:], len(slots)])}
    ranked = found.join(before, ["length", "part"]).withColumn("_rank", F.col("_before") + F.col("place"))
    ranked = ranked.drop("_before", "part", "place")
    names = [c for c in ranked.columns if c != "_rank"]

    def look_up(batches):
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("_rank").to_numpy()
            at = np.empty(len(ranks), np.int64)
            for n in np.unique(lengths):
                lo, hi = first_of[int(n)], ends[int(n)]
                own = lengths == n
                at[own] = lo + np.searchsorted(slots[lo:hi, 1], ranks[own], side="right") - 1
            sequence = slots[at, 3] + ranks - slots[at, 1]
            columns = [batch.column(c) for c in names] + [pa.array(sequence), pa.array(slots[at, 4])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.select(*names).schema)
    return ranked.mapInArrow(look_up, f"{kept}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, room: int = 2048,
         derive: dict[str, Column] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``room`` ids: one row per
    piece with ``doc_id, piece, start, length``, its ids and its place.

    ``derive`` replaces the ids by columns computed from them, so that only
    those are written and moved. A null or empty text is the end id alone; rows
    with a null doc_id and repeated rows are documents of their own; an empty
    table gives an empty result; other columns of ``docs`` are not read.
    """
    found = pieces(docs, tokenizer, end_id, room, id_col, text_col)
    content = [F.col("ids")] if derive is None else [c.alias(n) for n, c in derive.items()]
    found = written(found.select("doc_id", "piece", "start", "length", *content, "part", "place"), "pieces")
    return place(found, room)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed with their ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    parts = packed.groupBy("sequence_id").agg(ordered.alias("p"))
    return parts.select("sequence_id", F.aggregate(
        "p", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"))
