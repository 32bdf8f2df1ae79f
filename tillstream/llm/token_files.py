"""Token files: ids coded by a static range asymmetric numeral system.

A folder holds two Parquet tables. ``table`` is one row with the frequencies,
scaled to 2^20, that every block shares. ``blocks`` has one row per block, in
ascending document order of (part, seq): whole documents until a block has its
size, so that each can be decoded by itself. A block's bytes are

    magic, version, lanes, tokens, documents, checkpoints, words   (seven integers)
    document ids, ids per document, which ids are null
    checkpoints: step, word offset, lane states
    32-bit words
    crc32 of all bytes before, crc32 of the ids

Token ``i`` belongs to lane ``i mod lanes``; all lanes take a step together, so
numpy codes a thousand tokens at once. A checkpoint holds what a decoder needs
to begin there; the first one is the block's beginning.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import map_texts, written
from .tokens import groups, memo

SCALE = 20                      # frequencies add up to 2^SCALE
_LOW = 1 << 31                  # a state lies in [2^31, 2^63)
_MAGIC, _VERSION = 0x54524E53, 1
LANES, BLOCK, CHECKPOINT = 1024, 1 << 18, 1 << 17  # lanes; tokens of a block and between checkpoints


class Corrupt(ValueError):
    """A block's checksum does not fit its content."""


# --- frequencies -----------------------------------------------------------------


def scaled(counts: Mapping[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, frequencies): counts scaled to the sum 2^SCALE, each at least 1."""
    ids = np.array(sorted(counts), dtype=np.int64)
    if len(ids) > 1 << SCALE:
        raise ValueError(f"more than {1 << SCALE} different ids")
    times = np.array([counts[i] for i in ids.tolist()], dtype=np.float64)
    if not len(ids):
        return ids, ids
    room = (1 << SCALE) - len(ids)
    freqs = 1 + np.floor(times / times.sum() * room).astype(np.int64)
    freqs[np.argmax(freqs)] += (1 << SCALE) - freqs.sum()
    return ids, freqs


class Coder:
    """Blocks of ids under one frequency table."""

    def __init__(self, ids: np.ndarray, freqs: np.ndarray):
        self._ids = ids
        self._freqs = freqs.astype(np.uint64)
        self._starts = np.concatenate([[0], np.cumsum(freqs)[:-1]]).astype(np.uint64) if len(ids) else self._freqs
        self._slots = None
        self._index = np.full(int(ids[-1]) + 1 if len(ids) else 1, -1, np.int64)
        self._index[ids] = np.arange(len(ids))

    def encode(self, doc_ids: list[int | None], parts: list[np.ndarray], lanes: int = LANES,
               checkpoint: int = CHECKPOINT) -> bytes:
        tokens = np.concatenate(parts)
        lanes = int(min(lanes, max(1, len(tokens) // 64)))
        symbols = self._index[tokens]
        steps = -(-len(tokens) // lanes)
        every = max(1, checkpoint // lanes)
        states = np.full(lanes, _LOW, np.uint64)
        words, marks = [], []
        for step in range(steps - 1, -1, -1):
            own = symbols[step * lanes : (step + 1) * lanes]
            x, f = states[: len(own)], self._freqs[own]
            spill = x >= (f << np.uint64(63 - SCALE))
            words.append((x[spill] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x = np.where(spill, x >> np.uint64(32), x)
            quotient = x // f
            states[: len(own)] = (quotient << np.uint64(SCALE)) + (x - quotient * f) + self._starts[own]
            if step % every == 0:
                marks.append((step, states.copy()))
        sizes = np.array([len(w) for w in reversed(words)])
        before = np.concatenate([[0], np.cumsum(sizes)])
        out = [np.array([_MAGIC, _VERSION, lanes, len(tokens), len(parts), len(marks), int(before[-1])], "<i8").tobytes()]
        out.append(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
        out.append(np.array([len(p) for p in parts], "<i8").tobytes())
        out.append(np.array([d is None for d in doc_ids], np.uint8).tobytes())
        for step, at in reversed(marks):
            out.append(np.array([step, before[step]], "<i8").tobytes() + at.astype("<u8").tobytes())
        out += [w.tobytes() for w in reversed(words)]
        body = b"".join(out)
        return body + np.array([zlib.crc32(body), zlib.crc32(tokens.astype("<u4").tobytes())], "<u4").tobytes()

    def decode(self, block: bytes, from_checkpoint: int = 0) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        """(document ids, ids per document, all ids from the checkpoint on)."""
        if len(block) < 64 or zlib.crc32(block[:-8]) != int(np.frombuffer(block, "<u4", 1, len(block) - 8)[0]):
            raise Corrupt("the bytes of a block do not fit their checksum")
        magic, version, lanes, n, docs, marks, n_words = np.frombuffer(block, "<i8", 7).tolist()
        if (magic, version) != (_MAGIC, _VERSION):
            raise Corrupt("not a block of token ids")
        at = 56
        doc_ids = np.frombuffer(block, "<i8", docs, at).tolist()
        lengths = np.frombuffer(block, "<i8", docs, at + 8 * docs)
        nulls = np.frombuffer(block, np.uint8, docs, at + 16 * docs)
        at += 17 * docs
        size = 16 + 8 * lanes
        step, used = np.frombuffer(block, "<i8", 2, at + size * from_checkpoint).tolist()
        x = np.frombuffer(block, "<u8", lanes, at + size * from_checkpoint + 16).astype(np.uint64)
        words = np.frombuffer(block, "<u4", n_words, at + size * marks)
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self._ids), dtype=np.int32), self._freqs.astype(np.int64))
        first = step * lanes
        out = np.empty(n - first, np.int64)
        mask = np.uint64((1 << SCALE) - 1)
        for a in range(first, n, lanes):
            b = min(a + lanes, n)
            own = x[: b - a]
            slot = own & mask
            symbol = self._slots[slot.astype(np.int64)]
            out[a - first : b - first] = symbol
            own = self._freqs[symbol] * (own >> np.uint64(SCALE)) + slot - self._starts[symbol]
            need = np.flatnonzero(own < np.uint64(_LOW))
            own[need] = (own[need] << np.uint64(32)) | words[used : used + len(need)]
            used += len(need)
            x[: b - a] = own
        ids = self._ids[out]
        if not from_checkpoint and zlib.crc32(ids.astype("<u4").tobytes()) != int(np.frombuffer(block, "<u4", 1, len(block) - 4)[0]):
            raise Corrupt("the ids of a block do not fit their checksum")
        return [None if null else d for d, null in zip(doc_ids, nulls.tolist())], lengths, ids


# --- files -----------------------------------------------------------------------


def _width(tokenizer: str, end_id: int) -> str:
    """The smallest integers that hold every id, for the steps before coding."""
    from tokenizers import Tokenizer

    ids = [end_id, *Tokenizer.from_file(tokenizer).get_vocab().values()]
    return "<u2" if max(ids) < 1 << 16 else "<u4"


def _tokenised(docs: DataFrame, tokenizer: str, kind: str, end_id: int, width: str, id_col: str, text_col: str) -> DataFrame:
    def rows(pairs):
        encoder, end = memo(tokenizer, kind), np.array([end_id], width).tobytes()
        for group in groups(pairs):
            for (doc, _), ids in zip(group, encoder.encode([t or "" for _, t in group])):
                yield doc, np.frombuffer(ids, "<u4").astype(width).tobytes() + end

    return map_texts(docs, rows, "doc_id bigint, ids binary", id_col, text_col, flush=1_000)


def _counts(tokens: DataFrame, width: str) -> dict[int, int]:
    """Occurrences of each id; as many rows as the vocabulary has."""

    def rows(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            seen = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), width))
            if len(seen) > len(total):
                total = np.concatenate([total, np.zeros(len(seen) - len(total), np.int64)])
            total[: len(seen)] += seen
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])

    counted = tokens.select("ids").mapInArrow(rows, "id bigint, n bigint")
    return {r["id"]: r["n"] for r in counted.groupBy("id").agg(F.sum("n").alias("n")).collect()}


def write_token_files(docs: DataFrame, path: str, tokenizer: str, kind: str = "word", end_id: int = 2,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every text's ids, ``end_id`` after each document, in ascending
    document order under ``path``, a new folder that all executors reach.

    A null or empty text is the end id alone. Null document ids come first;
    rows that repeat an id follow each other, each a document of its own. An
    empty table gives an empty file. The frequency table is collected, as it
    has at most as many rows as the vocabulary; nothing else is.
    """
    spark = docs.sparkSession
    width = _width(tokenizer, end_id)
    tokens = written(_tokenised(docs, tokenizer, kind, end_id, width, id_col, text_col), "token-ids")
    ids, freqs = scaled(_counts(tokens, width))
    spark.createDataFrame([(ids.tolist(), freqs.tolist())], "ids array<bigint>, freqs array<bigint>").coalesce(1).write.parquet(f"{path}/table")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids")]
    ordered = tokens.repartitionByRange(*order).sortWithinPartitions(*order)

    def rows(batches):
        coder, part, seq = Coder(ids, freqs), TaskContext.get().partitionId(), 0
        docs_in, parts, size = [], [], 0

        def block():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq]), pa.array([size]), pa.array([coder.encode(docs_in, parts)], pa.binary())],
                names=["part", "seq", "n_tokens", "block"])

        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                docs_in.append(doc)
                parts.append(np.frombuffer(raw, width).astype(np.int64))
                size += len(parts[-1])
                if size >= BLOCK:
                    yield block()
                    docs_in, parts, size, seq = [], [], 0, seq + 1
        if docs_in:
            yield block()

    ordered.mapInArrow(rows, "part int, seq bigint, n_tokens bigint, block binary").write.parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of a folder; ``start``
    counts the ids of all documents before, ``ids`` are little-endian 32-bit
    integers. Blocks are decoded wherever they lie; checksums are verified."""
    table = spark.read.parquet(f"{path}/table").first()
    ids, freqs = np.array(table["ids"], np.int64), np.array(table["freqs"], np.int64)
    blocks = spark.read.schema("part int, seq bigint, n_tokens bigint, block binary").parquet(f"{path}/blocks")
    sizes = written(blocks.select("part", "seq", "n_tokens"), "block-sizes")
    # One row per part meets in a task here, as many as the writer had tasks.
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    up = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(up), F.lit(0)).alias("_of_parts"))
    up = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "seq", F.coalesce(F.sum("n_tokens").over(up), F.lit(0)).alias("_in_part")).join(parts, "part")
    placed = starts.select("part", "seq", (F.col("_of_parts") + F.col("_in_part")).alias("start"))

    def rows(batches):
        coder = Coder(ids, freqs)
        for batch in batches:
            for at, raw, start in zip(range(batch.num_rows), batch.column("block"), batch.column("start").to_pylist()):
                docs, lengths, found = coder.decode(raw.as_py())
                ends = np.cumsum(lengths)
                raw_ids = found.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(start + ends - lengths), pa.array(lengths),
                     pa.array([raw_ids[e - n : e].tobytes() for e, n in zip(ends, lengths)], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    return blocks.join(placed, ["part", "seq"]).select("block", "start").mapInArrow(
        rows, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
