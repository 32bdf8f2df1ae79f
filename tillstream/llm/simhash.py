"""SimHash fingerprints and their bit-sliced comparison.

Near fingerprints are found in buckets: rows that agree on a key cut from the
bits. Inside a task all buckets are compared together, bit plane by bit plane:
one machine word holds one bit of 64 pairs, carry-save counters made of such
words add up 64 distances at once, and a word whose 64 pairs are all beyond the
radius is not looked at again.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import components, long_rows, map_texts, written

FREQUENT, _SHARE = 3, 8    # sampled texts that hold a listed shingle; one text in so many is sampled
LISTED = 250_000           # shingles whose frequency is known in every task: 4 MB
TILE = 16_384          # rows of a bucket that one task compares with each other
_AT_ONCE = 1 << 17     # rows compared together
_STEP = 8              # planes between two looks at which words are finished
_GOLDEN = 0x9E3779B97F4A7C15


# --- fingerprints ----------------------------------------------------------------


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """A further 64-bit hash from one: the finaliser of splitmix64."""
    h = h + np.uint64((k * _GOLDEN) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: str | None, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """A 64-bit hash per shingle. A-Z count as a-z, words end at ASCII white space.
    With fewer words than a shingle the whole sequence is one."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    join, digest = b" ".join, xxhash.xxh64_intdigest
    if len(found) <= shingle:
        hashes = [digest(join(found), seed)] if found else []
    else:
        hashes = [digest(join(s), seed) for s in zip(*(found[i:] for i in range(shingle)))]
    return np.array(hashes, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = 3, words: int = 1, seed: int = 42) -> bytes:
    """``words`` 64-bit words, big-endian; a bit is 1 if it is set in over half
    the shingles' hashes. Without any shingle it is 0."""
    return _folded(shingle_hashes(text, shingle, seed), words)


def _folded(hashes: np.ndarray, words: int) -> bytes:
    if not len(hashes):
        return bytes(8 * words)
    fingers = []
    for k in range(words):
        own = (_mixed(hashes, k) if k else hashes).astype(">u8").view(np.uint8).reshape(-1, 8)
        ones = np.zeros(64, np.int64)
        for at in range(0, len(own), 1 << 15):
            ones += np.unpackbits(own[at : at + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
        fingers.append(np.packbits(2 * ones > len(own)).tobytes())
    return b"".join(fingers)


def fingerprints(docs: DataFrame, shingle: int = 3, words: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; null and empty texts have fingerprint zero."""

    def rows(pairs):
        for doc, text in pairs:
            yield doc, fingerprint(text, shingle, words)

    return map_texts(docs, rows, "doc_id bigint, fp binary", id_col, text_col)


def set_prints(docs: DataFrame, shingle: int, words: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fp, node): as ``fingerprints``, of each shingle once; ``node`` is
    the digest of the set of shingles."""

    def rows(pairs):
        for doc, text in pairs:
            hashes = np.unique(shingle_hashes(text, shingle))
            yield doc, _folded(hashes, words), xxhash.xxh3_128_digest(hashes.tobytes())

    return map_texts(docs, rows, "doc_id bigint, fp binary, node binary", id_col, text_col)


# --- keys ------------------------------------------------------------------------


def pair_keys(bits: int = 64, blocks: int = 4) -> list[tuple[int, ...]]:
    """Bits of each table: every pair of equal blocks. Fingerprints that differ
    in ``blocks`` - 2 bits or fewer agree on at least one table."""
    size = bits // blocks
    spans = [tuple(range(i * size, (i + 1) * size)) for i in range(blocks)]
    return [a + b for a, b in combinations(spans, 2)]


def band_keys(bits: int = 256, size: int = 14) -> list[tuple[int, ...]]:
    """Bits of each table: consecutive bands of ``size`` bits."""
    return [tuple(range(i, i + size)) for i in range(0, bits - size + 1, size)]


def _keyed(prints: DataFrame, tables: list[tuple[int, ...]]) -> DataFrame:
    """(tab, key, fp, rep) for each fingerprint and table."""

    def rows(batches):
        for batch in batches:
            raw, reps = batch.column("fp").to_pylist(), batch.column("rep")
            if not raw:
                continue
            bits = np.unpackbits(np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1), axis=1)
            for t, own in enumerate(tables):
                key = bits[:, own].astype(np.int64) @ (1 << np.arange(len(own), dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(raw), t, np.int32)), pa.array(key), batch.column("fp"), reps],
                    names=["tab", "key", "fp", "rep"])

    return prints.select("fp", "rep").mapInArrow(rows, "tab int, key bigint, fp binary, rep bigint")


# --- comparison ------------------------------------------------------------------


def _shifted(plane: np.ndarray, at: np.ndarray, lag: int) -> np.ndarray:
    """Words ``at`` of the plane moved down by ``lag`` bits."""
    word, bit = divmod(lag, 64)
    low = plane[at + word]
    if not bit:
        return low
    return (low >> np.uint64(bit)) | (plane[at + word + 1] << np.uint64(64 - bit))


def near_pairs(prints: np.ndarray, sizes: np.ndarray, radius: int, planes: list[int]):
    """Yield (i, j) index arrays of the pairs of one bucket within ``radius``.

    ``prints`` are the bytes of fingerprints, bucket after bucket, the largest
    bucket first; ``sizes`` are the buckets' sizes. For each lag the pairs
    (i, i + lag) are compared, so the rows that still have a partner are always
    a prefix. ``planes`` are the bits that can differ.
    """
    n = len(prints)
    bits = np.unpackbits(prints, axis=1)
    room = n // 64 + 2 + int(sizes[0]) // 64 + 1
    sliced = []
    for p in planes:
        packed = np.zeros(room * 8, np.uint8)
        own = np.packbits(bits[:, p], bitorder="little")
        packed[: len(own)] = own
        sliced.append(packed.view(np.uint64))
    ends = np.repeat(np.cumsum(sizes), sizes)  # end of each row's bucket
    counters = max(1, int(radius).bit_length())
    start = (1 << counters) - 1 - radius  # a counter that began here overflows just beyond the radius
    index = np.arange(n)
    for lag in range(1, int(sizes[0])):
        rows = int(sizes[sizes > lag].sum())
        valid = index[:rows] + lag < ends[:rows]
        mask = np.zeros(((rows + 63) // 64) * 8, np.uint8)
        packed = np.packbits(valid, bitorder="little")
        mask[: len(packed)] = packed
        at = np.flatnonzero(mask.view(np.uint64))
        over = ~mask.view(np.uint64)[at]
        count = [np.full(len(at), ~np.uint64(0) if start >> k & 1 else np.uint64(0)) for k in range(counters)]
        for k, plane in enumerate(sliced):
            carry = plane[at] ^ _shifted(plane, at, lag)
            for c in count:  # carry-save: each counter bit passes its carry on
                c ^= carry
                carry &= ~c
            over |= carry
            if k % _STEP == _STEP - 1:
                alive = over != ~np.uint64(0)
                if not alive.all():
                    at, over = at[alive], over[alive]
                    count = [c[alive] for c in count]
                    if not len(at):
                        break
        if len(at):
            hits = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
            i = (at[:, None] * 64 + np.arange(64))[hits]
            if len(i):
                yield i, i + lag


def nearest_forest(prints: np.ndarray, pairs, at_once: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) of a minimum spanning forest by distance: each class of
    linked rows is held together by its closest pairs. Pairs come in parts; of
    what was seen so far only the forest is kept."""
    words = np.ascontiguousarray(prints).view(">u8").astype(np.uint64)
    kept = [np.empty(0, np.int64)] * 3
    waiting, size = [], 0

    def reduced() -> list[np.ndarray]:
        i, j, d = (np.concatenate(c) for c in zip(kept, *waiting))
        order = np.argsort(d, kind="stable")
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = x = parent.get(up, up)
            return x

        chosen = []
        for k, a, b in zip(order.tolist(), i[order].tolist(), j[order].tolist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
                chosen.append(k)
        return [c[np.array(chosen, np.int64)] for c in (i, j, d)]

    for i, j in pairs:
        waiting.append((i, j, np.bitwise_count(words[i] ^ words[j]).sum(axis=1, dtype=np.int64)))
        size += len(i)
        if size >= at_once:
            kept, waiting, size = reduced(), [], 0
    if waiting:
        kept = reduced()
    return kept[0], kept[1]


def links(prints: DataFrame, tables: list[tuple[int, ...]], radius: int) -> DataFrame:
    """(a, b) between the ``rep`` ids of fingerprints ``fp`` that share
    a bucket and differ in at most ``radius`` bits: for each bucket the closest
    pairs that hold its classes together, never all its pairs. Buckets beyond TILE rows are dealt to many
    tasks as pairs of chunks."""
    keyed = written(_keyed(prints, tables), "simhash-keys")
    many = keyed.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunk = F.pmod(F.xxhash64("fp", "rep"), F.col("chunks"))
    shared = (
        keyed.join(many, ["tab", "key"]).withColumn("chunks", F.ceil(F.col("n") * 2 / TILE))
        .withColumn("own", F.when(F.col("n") <= TILE, F.lit(0).cast("bigint")).otherwise(chunk))
        .withColumn("other", F.explode(F.when(F.col("n") <= TILE, F.array(F.lit(0).cast("bigint"))).otherwise(
            F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))))
        .select("tab", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp", "rep")
    )
    dealt = shared.repartition("tab", "key", "x", "y").sortWithinPartitions("tab", "key", "x", "y")

    def compare(batches):
        table, kept, rows = None, [], 0

        def out():
            fps, reps, sizes = (np.concatenate([k[i] for k in kept]) for i in range(3))
            order = np.argsort(-sizes, kind="stable")
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[order]
            sizes = sizes[order]
            take = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            fps, reps = fps[take], reps[take]
            fixed = set(tables[table])
            planes = [b for b in range(fps.shape[1] * 8) if b not in fixed]
            i, j = nearest_forest(fps, near_pairs(fps, sizes, radius, planes))
            return pa.RecordBatch.from_arrays([pa.array(reps[i]), pa.array(reps[j])], names=["a", "b"])

        def buckets():
            """Whole buckets of one table, as (table, fps, reps, sizes)."""
            rest = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("tab", "key", "x", "y", "rep")]
                fps = np.frombuffer(b"".join(batch.column("fp").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                now = [*columns, fps]
                if rest is not None:
                    now = [np.concatenate(pair) for pair in zip(rest, now)]
                new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in now[:4]], axis=0)) + 1
                last = int(new[-1]) if len(new) else 0
                rest = [c[last:] for c in now]
                if last:
                    yield [c[:last] for c in now]
            if rest is not None:
                yield rest

        for part in buckets():
            edges = np.concatenate([[0], np.flatnonzero(np.any([c[1:] != c[:-1] for c in part[:4]], axis=0)) + 1, [len(part[0])]])
            sizes, tabs = np.diff(edges), part[0][edges[:-1]]
            for t in np.unique(tabs):
                own = np.flatnonzero((tabs == t) & (sizes > 1))
                if table is not None and (t != table or rows > _AT_ONCE) and kept:
                    yield out()
                    kept, rows = [], 0
                table = int(t)
                if len(own):
                    take = np.concatenate([np.arange(edges[g], edges[g + 1]) for g in own])
                    kept.append((part[5][take], part[4][take], sizes[own]))
                    rows += len(take)
        if kept:
            yield out()

    return dealt.mapInArrow(compare, "a bigint, b bigint")


def shingle_set(text: bytes, shingle: int) -> set[bytes]:
    found = text.lower().split()
    if len(found) <= shingle:
        return {b" ".join(found)} if found else set()
    return {b" ".join(s) for s in zip(*(found[i:] for i in range(shingle)))}


def verified(pairs: DataFrame, docs: DataFrame, shingle: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) of document ids whose sets of shingles have a Jaccard
    similarity of at least ``similarity``. Texts go compressed to the pairs that
    need them; a pair whose text is missing is dropped."""

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            raw = [squeeze((t.as_py() or "").encode("utf-8")) for t in batch.column("text")]  # one text at a time
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(raw, pa.binary())], names=["doc", "raw"])

    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "near-pairs")
    needed = written(pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc"))).distinct(), "near-ids")
    texts = long_rows(docs).select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(needed, "doc", "left_semi").mapInArrow(pack, "doc bigint, raw binary")
    texts = written(texts.distinct(), "near-texts")  # all texts of a repeated id
    both = pairs.join(texts.select(F.col("doc").alias("a"), F.col("raw").alias("raw_a")), "a").join(
        texts.select(F.col("doc").alias("b"), F.col("raw").alias("raw_b")), "b")

    def compare(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            keep, last, own = [], None, set()
            for raw_a, raw_b in zip(batch.column("raw_a"), batch.column("raw_b")):
                raw_a, raw_b = raw_a.as_py(), raw_b.as_py()
                if raw_b != last:
                    last, own = raw_b, shingle_set(unpack(raw_b), shingle)
                other = shingle_set(unpack(raw_a), shingle)
                common = len(own & other)
                keep.append(common >= similarity * (len(own) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "raw_a", "raw_b").mapInArrow(compare, "a bigint, b bigint")


class Frequency:
    """How often sampled texts hold a shingle; 0 for all that are not listed."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self._tokens, self._counts = tokens[order], counts[order]

    def of(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self._tokens):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self._tokens, tokens), len(self._tokens) - 1)
        return np.where(self._tokens[at] == tokens, self._counts[at], 0)


def _set_of(text: str | None, shingle: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, shingle)).view(np.int64)


def _first_shingles(text: str | None, shingle: int, similarity: float, frequency: Frequency) -> tuple[np.ndarray, int]:
    """The first shingles of a text's set, rare ones first and by hash among
    equals, and the size of the set. Sets of at least the similarity share one."""
    hashes = _set_of(text, shingle)
    hashes = hashes[np.argsort(frequency.of(hashes), kind="stable")]
    least = int(np.ceil(similarity * len(hashes) - 1e-6))
    return hashes[: len(hashes) - least + 1 if least else 0], len(hashes)


def _over_texts(docs: DataFrame, columns, schema: str, id_col: str, text_col: str) -> DataFrame:
    """``columns(id, text)``, a tuple of arrays, for every text with an id."""
    typed = long_rows(docs).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                parts = [columns(i.as_py(), t.as_py()) for i, t in zip(some.column(0), some.column(1))]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=names)

    return typed.filter("id IS NOT NULL").mapInArrow(run, schema)


def _frequency(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> Frequency:
    """Of all shingles of the sampled texts, the LISTED most frequent. The list
    only sets an order: any order finds all pairs, this one makes few candidates."""
    sampled = docs.filter(F.pmod(F.xxhash64(id_col), F.lit(_SHARE)) == 0)
    held = _over_texts(sampled, lambda i, t: (_set_of(t, shingle),), "token bigint", id_col, text_col)
    counts = written(held.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= FREQUENT), "frequencies")
    room, least = LISTED, None
    for n, tokens in sorted(map(tuple, counts.groupBy("n").count().collect()), reverse=True):  # a row per frequency
        room -= tokens
        if room < 0:
            break
        least = n
    top = counts.filter(F.col("n") >= F.lit(least)).toArrow() if least else counts.limit(0).toArrow()
    return Frequency(top["token"].to_numpy(), top["n"].to_numpy())


def unlinked_pairs(docs: DataFrame, reps: DataFrame, shingle: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(a, b): a superset of the pairs of ``rep`` ids under different ``root`` whose
    sets of shingles reach the similarity, each once. Both then share one of
    their first shingles in any order of all shingles; this one takes rare
    shingles first, so that a common passage does not pair all that hold it. Sizes
    within the similarity lie in the same or in neighbouring bands, which are
    part of the key; the rest of the size and place test is part of the join."""
    frequency = docs.sparkSession.sparkContext.broadcast(_frequency(docs, shingle, id_col, text_col))  # at most LISTED entries

    def first(doc: int, text: str | None):
        tokens, size = _first_shingles(text, shingle, similarity, frequency.value)
        n = len(tokens)
        return tokens, np.full(n, doc, np.int64), np.arange(n, dtype=np.int32), np.full(n, size, np.int32)

    index = _over_texts(docs, first, "token bigint, rep bigint, at int, size int", id_col, text_col)
    index = written(index.join(reps, "rep").distinct(), "first-shingles")
    several = index.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x < y").select("token")
    shared = written(
        index.join(several, "token", "left_semi")
        .withColumn("band", F.floor(F.log("size") / F.lit(float(-np.log(similarity))) + 1e-9).cast("int")), "shared-shingles")
    a = shared.select("token", *[F.col(c).alias(f"{c}_a") for c in ("rep", "at", "size", "root", "band")])
    b = shared.select("token", *[F.col(c).alias(f"{c}_b") for c in ("rep", "at", "size", "root")],
                      F.explode(F.array(F.col("band"), F.col("band") - 1, F.col("band") + 1)).alias("band_a"))
    # What both can share from this shingle on, if it is their first common one.
    least = F.lit(similarity / (1 + similarity)) * (F.col("size_a") + F.col("size_b")) - 1e-6
    rest = F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b"))
    met = a.join(b, ["token", "band_a"]).filter((F.col("rep_a") < F.col("rep_b")) & (F.col("root_a") != F.col("root_b")) & (rest >= least))
    return met.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, words: int = 1, radius: int = 2,
                    tables: list[tuple[int, ...]] | None = None, similarity: float | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): documents are linked when their fingerprints
    differ in at most ``radius`` bits; a component is named by its least doc_id.

    ``tables`` default to keys that find every such pair. Equal fingerprints are
    one node, so copies meet in a partial aggregate and not in a comparison.
    With ``similarity`` a node is a set of shingles, fingerprints take each
    shingle once, and the result is that of linking every two nodes whose sets
    have at least that Jaccard similarity: near fingerprints are checked first,
    then the pairs between different components that share one of the shingles
    which similar sets must share. Equality of shingles rests on 64-bit hashes there.
    Null, empty and blank texts have fingerprint zero and are linked like any
    other. A row with a null doc_id gets a fingerprint and no component. Rows
    that repeat a doc_id are linked through it. An empty table gives an empty
    result.
    """
    if similarity is None:
        found, key = written(fingerprints(docs, shingle, words, id_col, text_col), "fingerprints"), "fp"
    else:
        found, key = written(set_prints(docs, shingle, words, id_col, text_col), "fingerprints"), "node"
    prints = written(found.filter("doc_id IS NOT NULL").groupBy(*{key: 0, "fp": 0}).agg(F.min("doc_id").alias("rep")), "prints")
    pairs = links(prints, tables or pair_keys(64 * words, radius + 2), radius)
    if similarity is not None:
        pairs = written(verified(pairs, docs, shingle, similarity, id_col, text_col), "near-links")
        linked = components(pairs, label="simhash-linked")
        reps = prints.select("rep").distinct().join(linked, prints["rep"] == linked["node"], "left").select(
            "rep", F.coalesce("root", "rep").alias("root"))
        more = unlinked_pairs(docs, written(reps, "near-roots"), shingle, similarity, id_col, text_col)
        pairs = pairs.union(verified(more, docs, shingle, similarity, id_col, text_col))
    own = found.join(prints.select(key, F.col("rep").alias("_rep")), key, "left")
    repeated = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(key).alias("_least"), F.max(key).alias("_most")).filter("_least <> _most")
    if repeated.limit(1).count():  # one doc_id with several texts links their fingerprints
        spread = own.join(repeated.select("doc_id"), "doc_id").select(F.col("doc_id").alias("a"), F.col("_rep").alias("b"))
        pairs = pairs.union(spread)
    roots = components(pairs, label="simhash-links")
    joined = own.join(roots, own["_rep"] == roots["node"], "left")
    return joined.select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "_rep")).alias("component_id"))
