"""Suffix-array dedup: remove bytes covered by a repeated string of 100 bytes.

Sorting every suffix of a corpus would move each text a hundred times. Instead

1. every start of a 100-byte string is tied to an anchor, the 20-byte string
   with the least hash inside it. Equal strings have the same anchor at the same
   distance, so only starts whose anchor occurs twice can repeat. Neighbouring
   starts with one anchor form a *unit*; only its hashes are shuffled;
2. units that are equal as a whole need no comparison: all but the first are
   covered. Of the different units of an anchor only those go on that share an
   80-byte section every string of theirs would have to share;
3. their bytes are fetched and their suffixes sorted by 100 bytes, deep-shallow:
   a multikey sort to a shallow depth, then blind tries for the groups whose
   common prefix is longer. Of equal strings all but the first are covered.
"""

from __future__ import annotations



import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from .common import long_rows, written

LENGTH = 100                      # bytes of a string that counts as repeated
ANCHOR = 20                       # bytes of an anchor
REACH = LENGTH - ANCHOR           # largest distance of an anchor from the start
SECTION, STEP = 80, 20            # bytes of a section; starts that share one
SHALLOW = 64                      # depth of the multikey sort, a multiple of 8
_PLACE = np.uint64((1 << 28) - 1)
_BASE = 0x9E3779B97F4A7C15
_GROUP = 50_000                   # units of one anchor held at once
_AT_ONCE = 1 << 21                # bytes sorted together, at least one anchor
_HOT, _SLICE = 1 << 19, 1 << 15   # starts of common anchors looked through for copies, and sent, at once

_UNITS = "h bigint, u bigint, sections bigint, doc bigint, pos bigint, done boolean"
_BATCH = 200_000                  # units looked through for copies before they are shuffled
_FOUND = "doc bigint, alt int, start bigint, n int, h bigint, hot boolean"


# --- units -----------------------------------------------------------------------


class Hasher:
    """Hashes of ranges of a byte string, from prefix sums modulo 2^64."""

    def __init__(self, seed: int = 7):
        self._values = np.random.default_rng(seed).integers(1, 2**64, 256, dtype=np.uint64)
        self._up = self._down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self._up) <= n:
            size = max(2 * len(self._up), n + 1, 1 << 16)
            for name, base in (("_up", _BASE), ("_down", pow(_BASE, -1, 2**64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def load(self, data: np.ndarray) -> None:
        self._powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._values[data] * self._up[: len(data)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self._sums[end] - self._sums[start]) * self._down[start])

    def grams(self, size: int) -> np.ndarray:
        n = len(self._sums) - size
        return _mix((self._sums[size:] - self._sums[:n]) * self._down[:n])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` neighbours."""
    span = 1
    while 2 * span <= size:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    rest = size - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def units_of(data: bytes, hasher: Hasher) -> tuple[np.ndarray, ...] | None:
    """(h, u, sections, start, distance, n) per unit of one text: anchor and unit
    hash, four 16-bit section hashes, first start, the anchor's distance from it
    and the number of starts."""
    if len(data) < LENGTH:
        return None
    hasher.load(np.frombuffer(data, np.uint8))
    grams = hasher.grams(ANCHOR)
    placed = (grams & ~_PLACE) | (np.arange(len(grams), dtype=np.uint64) & _PLACE)
    least = _least(placed, REACH + 1)
    start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    n = np.diff(np.append(start, len(least)))
    distance = ((least[start] & _PLACE).astype(np.int64) - (start & int(_PLACE))) & int(_PLACE)
    anchor = start + distance
    u = _mix(hasher.of(start, start + n + LENGTH - 1) + distance.astype(np.uint64))
    sections = np.zeros(len(start), np.uint64)
    for k in range(4):
        at = anchor - STEP * k
        inside = (at >= 0) & (at + SECTION <= len(data))
        at = np.where(inside, at, 0)
        own = np.where(inside, hasher.of(at, at + SECTION) >> np.uint64(48), 0)
        sections |= own.astype(np.uint64) << np.uint64(16 * k)
    return grams[anchor], u, sections, start, distance, n


def _pack(alt, start, distance, n):
    return (alt << 48) | (start << 16) | (distance << 8) | n


def _looked_through(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """The units of some texts. Copies of a unit among them that are not its
    first are ``done``: they are covered, and need not meet at the anchor. They
    go on under a key of their own, so that a common passage costs its anchors
    one unit per batch."""
    h, u, sections, doc, pos = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((pos, doc, u, h))
    edges = _runs(h[order], u[order])
    first = np.empty(len(h), np.int64)
    first[order] = np.repeat(order[edges[:-1]], np.diff(edges))
    done = (doc != doc[first]) | (pos != pos[first])
    spread = _mix(doc.astype(np.uint64) + pos.astype(np.uint64) * np.uint64(_BASE)).view(np.int64)
    columns = [np.where(done, spread, h), u, sections, doc, pos, done]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "u", "sections", "doc", "pos", "done"])


def _units(docs: DataFrame) -> DataFrame:
    def rows(batches):
        hasher = Hasher()
        for batch in batches:
            parts, size = [], 0
            for doc, alt, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "alt", "text"))):
                if doc is None or (found := units_of((text or "").encode("utf-8"), hasher)) is None:
                    continue
                h, u, sections, start, distance, n = found
                parts.append((h.view(np.int64), u.view(np.int64), sections.view(np.int64),
                              np.full(len(h), doc), _pack(alt, start, distance, n)))
                size += len(h)
                if size > _BATCH:
                    yield _looked_through(parts)
                    parts, size = [], 0
            if parts:
                yield _looked_through(parts)

    return docs.select("doc", "alt", "text").mapInArrow(rows, _UNITS)


# --- units of one anchor ---------------------------------------------------------


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Begin of each run of rows equal in all columns, and the end."""
    new = np.zeros(len(columns[0]) - 1, bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(columns[0])]])


def _resolve(h, u, sections, doc, pos, done, cut: list[int]) -> list[pa.Array]:
    """Covered units (h null) and starts to be compared (h set) of some anchors.
    Of the anchors ``cut`` other units are elsewhere: all starts of their
    different units are to be compared, and are marked ``hot``."""
    order = np.lexsort((pos, doc, u, h, done))
    h, u, sections, doc, pos, done = (c[order] for c in (h, u, sections, doc, pos, done))
    edges = _runs(done, h, u)
    first = np.repeat(edges[:-1], np.diff(edges))
    covered = done | (doc != doc[first]) | (pos != pos[first])
    start, distance, n = (pos >> 16) & 0xFFFFFFFF, (pos >> 8) & 0xFF, pos & 0xFF

    reps = edges[:-1][~done[edges[:-1]]]
    groups = _runs(h[reps]) if len(reps) else np.zeros(1, np.int64)
    hot = np.isin(h[reps], cut)
    several = (np.repeat(np.diff(groups), np.diff(groups)) > 1) | hot
    reps, hot = reps[several], hot[several]
    low, high = np.full(len(reps), 255), np.full(len(reps), -1)  # distances to be compared
    low[hot], high[hot] = (distance - n + 1)[reps[hot]], distance[reps[hot]]
    for k in range(4):
        near, far = STEP * k, STEP * k + STEP - 1 if k < 3 else REACH
        least, most = np.maximum(distance[reps] - n[reps] + 1, near), np.minimum(distance[reps], far)
        own = np.flatnonzero(least <= most)
        value = (sections[reps[own]].view(np.uint64) >> np.uint64(16 * k)) & np.uint64(0xFFFF)
        by = np.lexsort((value, h[reps[own]]))
        if not len(by):
            continue
        same = _runs(h[reps[own]][by], value[by])
        shared = own[by[np.repeat(np.diff(same), np.diff(same)) > 1]]
        low[shared] = np.minimum(low[shared], least[shared])
        high[shared] = np.maximum(high[shared], most[shared])
    asked = high >= 0
    reps, low, high, hot = reps[asked], low[asked], high[asked], hot[asked]
    at = np.flatnonzero(covered)
    anchors = np.concatenate([np.zeros(len(at), np.int64), h[reps]])
    null = np.concatenate([np.ones(len(at), bool), np.zeros(len(reps), bool)])
    return [
        pa.array(np.concatenate([doc[at], doc[reps]])),
        pa.array((np.concatenate([pos[at], pos[reps]]) >> 48).astype(np.int32)),
        pa.array(np.concatenate([start[at], start[reps] + distance[reps] - high])),
        pa.array(np.concatenate([n[at], high - low + 1]).astype(np.int32)),
        pa.array(anchors, mask=null),
        pa.array(np.concatenate([np.zeros(len(at), bool), hot])),
    ]


def _groups(batches, key: str, at_most: int | None = None, at_least: int = 1):
    """Columns of runs of ``key`` from sorted batches, ``at_least`` rows at a time,
    and the keys of the runs among them that are not whole: a run beyond
    ``at_most`` rows comes in parts."""
    rest: pa.Table | None = None
    parted = None  # key of the run of which a part went out last

    def out(part: pa.Table, last_parted: bool):
        nonlocal parted
        first, last = part[key][0].as_py(), part[key][-1].as_py()
        cut = ([first] if first == parted else []) + ([last] if last_parted else [])
        parted = last if last_parted or last == parted else None
        return part, cut

    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = now if rest is None else pa.concat_tables([rest, now])
        if now.num_rows < at_least:
            rest = now
            continue
        keys = now[key].to_numpy()
        new = np.flatnonzero(keys[1:] != keys[:-1])
        cut = int(new[-1]) + 1 if len(new) else 0
        inside = bool(at_most) and len(keys) - cut > at_most
        if inside:
            cut = len(keys)
        if cut:
            yield out(now.slice(0, cut), inside)
        rest = now.slice(cut)
    if rest is not None and rest.num_rows:
        yield out(rest, False)


def _by_anchor(rows: DataFrame) -> DataFrame:
    """Rows of an anchor together, in the session's number of partitions: few
    bytes take long to sort here, so partitions are not to be merged by size."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width, "h").sortWithinPartitions("h")


def _found(units: DataFrame) -> DataFrame:
    def rows(batches):
        for part, cut in _groups(batches, "h", _GROUP, min(_GROUP, 20_000)):
            columns = _resolve(*(part[c].to_numpy() for c in ("h", "u", "sections", "doc", "pos", "done")), cut)
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "alt", "start", "n", "h", "hot"])

    return _by_anchor(units).mapInArrow(rows, _FOUND)


# --- deep-shallow sort -----------------------------------------------------------


def blind_trie(strings: list[bytes]) -> list[list[int]]:
    """Indexes of equal-length strings in their order, equal ones together.

    Inner nodes know only the depth at which their branches part. A string goes
    down blindly to some leaf, is compared with that leaf's string once, and
    branches off where the two part.
    """
    if not strings:
        return []
    root: list = [None, [0]]  # a leaf: [None, indexes]; an inner node: [depth, branches by byte]
    for i in range(1, len(strings)):
        own, node = strings[i], root
        while node[0] is not None:
            branches = node[1]
            node = branches.get(own[node[0]]) or next(iter(branches.values()))
        other = strings[node[1][0]]
        if own == other:
            node[1].append(i)
            continue
        depth = next(d for d in range(len(own)) if own[d] != other[d])
        node = root
        while node[0] is not None and node[0] < depth:
            node = node[1][own[node[0]]]
        if node[0] == depth:
            node[1][own[depth]] = [None, [i]]
        else:
            node[:] = [depth, {other[depth]: [node[0], node[1]], own[depth]: [None, [i]]}]
    out, stack = [], [root]
    while stack:
        depth, content = stack.pop()
        if depth is None:
            out.append(content)
        else:
            stack += [content[b] for b in sorted(content, reverse=True)]
    return out


def equal_strings(buffer: bytes, at: np.ndarray, group: np.ndarray, length: int = LENGTH,
                  shallow: int = SHALLOW) -> list[np.ndarray]:
    """Index arrays of the suffixes ``at`` of one ``group`` that share their
    first ``length`` bytes with another; in suffix order within a group."""
    padded = np.frombuffer(buffer + bytes(16), np.uint8)
    words = np.zeros(len(padded) - 8, np.uint64)  # eight bytes from each place on, as one sign
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k : len(words) + k]
    rows, group = np.arange(len(at)), group.astype(np.int64)
    for depth in range(0, min(shallow, length) // 8 * 8, 8):  # multikey sort: equal signs stay for the next depth
        if not len(rows):
            return []
        sign = words[at[rows] + depth]
        by = np.lexsort((sign, group))
        rows, sign, group = rows[by], sign[by], group[by]
        edges = _runs(group, sign)
        sizes = np.diff(edges)
        group = np.repeat(np.arange(len(sizes)), sizes)
        several = np.repeat(sizes > 1, sizes)
        rows, group = rows[several], group[several]
    if not len(rows):
        return []
    out = []
    for a, b in zip(*(lambda e: (e[:-1].tolist(), e[1:].tolist()))(_runs(group))):
        own = rows[a:b]
        tails = [buffer[p + shallow : p + length] for p in at[own].tolist()]
        out += [own[same] for same in blind_trie(tails) if len(same) > 1]
    return out


def _starts(raw: list[bytes], start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, at, place) of each start: its snippet, its byte in the joined snippets and in the text."""
    begin = np.concatenate([[0], np.cumsum([len(b) for b in raw])[:-1]]).astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    shift = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, begin[row] + shift, start[row] + shift


def _later(buffer: bytes, at, group, doc, alt, place) -> np.ndarray:
    """Indexes of the starts whose string begins at an earlier one of their group."""
    later = [np.empty(0, np.int64)]
    for same in equal_strings(buffer, at, group):
        by = same[np.lexsort((place[same], alt[same], doc[same]))]
        d, a, p = doc[by], alt[by], place[by]
        later.append(by[(d != d[0]) | (a != a[0]) | (p != p[0])])
    return np.concatenate(later)


def _ranges(doc, alt, place) -> tuple[np.ndarray, ...]:
    """(doc, alt, start, n) of the runs of neighbouring starts, of which there is one at least."""
    by = np.lexsort((place, alt, doc))
    d, a, p = doc[by], alt[by], place[by]
    edges = _runs(d, a, p - np.arange(len(p)))
    first = edges[:-1]
    return d[first], a[first].astype(np.int32), p[first], np.diff(edges).astype(np.int32)


def _compared(snippets: DataFrame) -> DataFrame:
    """Covered starts among the snippets of each anchor. An empty snippet stands
    for starts that are known to be covered."""

    def sort(part: pa.Table):
        raw = part["bytes"].to_pylist()
        doc, alt, start, n = (part[c].to_numpy() for c in ("doc", "alt", "start", "n"))
        edges = _runs(part["h"].to_numpy())
        group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        known = np.array([not b for b in raw])
        row, at, place = _starts(raw, start, np.where(known, 0, n))
        found = [doc[known], alt[known].astype(np.int32), start[known], n[known].astype(np.int32)]
        if len(later := _later(b"".join(raw), at, group[row], doc[row], alt[row], place)):
            own = _ranges(doc[row[later]], alt[row[later]], place[later])
            found = [np.concatenate(pair) for pair in zip(found, own)]
        if not len(found[0]):
            return None
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["doc", "alt", "start", "n"])

    def rows(batches):
        held, size = [], 0
        for part, _ in _groups(batches, "h"):
            held.append(part)
            size += part["bytes"].nbytes
            if size >= _AT_ONCE:
                if (out := sort(pa.concat_tables(held))) is not None:
                    yield out
                held, size = [], 0
        if held and (out := sort(pa.concat_tables(held))) is not None:
            yield out

    return _by_anchor(snippets).mapInArrow(rows, "doc bigint, alt int, start bigint, n int")


# --- documents -------------------------------------------------------------------


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``alt``, which tells apart the texts of a repeated doc_id."""
    hashed = docs.select("doc", F.xxhash64("text").alias("_h"))
    if not hashed.filter("doc IS NOT NULL").groupBy("doc").agg(F.min("_h").alias("a"), F.max("_h").alias("b")).filter("a <> b").limit(1).count():
        return docs.withColumn("alt", F.lit(0))
    rank = F.dense_rank().over(Window.partitionBy("doc").orderBy("_h")) - 1
    numbers = hashed.distinct().withColumn("alt", rank.cast("int"))
    keyed = docs.withColumn("_h", F.xxhash64("text"))
    return keyed.join(numbers, keyed["doc"].eqNullSafe(numbers["doc"]) & (keyed["_h"] == numbers["_h"])).select(
        keyed["doc"], "text", "alt")


def _packed(docs: DataFrame) -> DataFrame:
    """Texts as compressed UTF-8, for the joins that move them."""

    def rows(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            raw = [pack((t or "").encode("utf-8")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("alt"), pa.array(raw, pa.binary())], names=["doc", "alt", "raw"])

    return docs.select("doc", "alt", "text").mapInArrow(rows, "doc bigint, alt int, raw binary")


_NAMES = ["h", "doc", "alt", "start", "n", "bytes"]


def _snippets(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_NAMES)


def _spread(columns: list[list], hasher: Hasher):
    """Snippets of common anchors, string by string under keys of their own: an
    anchor goes to many tasks, equal strings to one. Copies among the strings at
    hand are covered and go on as empty snippets, so that a common string is one
    row per call."""
    h, doc, alt, start, n = (np.array(c, np.int64) for c in columns[:5])
    buffer = b"".join(columns[5])
    row, at, place = _starts(columns[5], start, n)
    d, a = doc[row], alt[row]
    by, group = np.unique(h, return_inverse=True)
    later = _later(buffer, at, group[row], d, a, place)
    if len(later):
        own = _ranges(d[later], a[later], place[later])
        key = _mix(own[0].astype(np.uint64) + own[2].astype(np.uint64) * np.uint64(_BASE)).view(np.int64)
        empty = pa.array([b""] * len(key), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(c) for c in own), empty], names=_NAMES)
    left = np.ones(len(at), bool)
    left[later] = False
    left = np.flatnonzero(left)
    data = np.frombuffer(buffer, np.uint8)
    hasher.load(data)
    windows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    for begin in range(0, len(left), _SLICE):
        own = left[begin : begin + _SLICE]
        key = _mix(hasher.of(at[own], at[own] + LENGTH) ^ h[row[own]].view(np.uint64)).view(np.int64)
        ends = pa.py_buffer(np.arange(0, LENGTH * (len(own) + 1), LENGTH, dtype=np.int32).tobytes())
        strings = pa.Array.from_buffers(pa.binary(), len(own), [None, ends, pa.py_buffer(windows[at[own]].tobytes())])
        ones = np.ones(len(own), np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(d[own]), pa.array(a[own].astype(np.int32)), pa.array(place[own]), pa.array(ones), strings], names=_NAMES)


def _cut(asked: DataFrame) -> DataFrame:
    """The snippets asked for of the texts of (doc, alt, raw, asked)."""

    def cut(batches):
        unpack, hasher = zstandard.ZstdDecompressor().decompress, Hasher()
        out, hot = ([[] for _ in _NAMES] for _ in range(2))
        size = starts = 0
        for batch in batches:
            for doc, alt, raw, asked in zip(*(batch.column(c).to_pylist() for c in ("doc", "alt", "raw", "asked"))):
                data = unpack(raw)
                for a in asked:
                    piece = data[a["start"] : a["start"] + a["n"] + LENGTH - 1]
                    for column, value in zip(hot if a["hot"] else out, (a["h"], doc, alt, a["start"], a["n"], piece)):
                        column.append(value)
                    if a["hot"]:
                        starts += a["n"]
                    else:
                        size += len(piece)
                    if starts >= _HOT:
                        yield from _spread(hot, hasher)
                        hot, starts = [[] for _ in _NAMES], 0
                if size > 1 << 24:
                    yield _snippets(out)
                    out, size = [[] for _ in _NAMES], 0
        yield _snippets(out)
        if starts:
            yield from _spread(hot, hasher)

    return asked.mapInArrow(cut, "h bigint, doc bigint, alt int, start bigint, n int, bytes binary")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, ranges): compressed texts (doc, alt, raw) and, for documents with
    a repeat, the list ``found`` of (start, n) whose ``n`` strings from byte
    ``start`` on occur earlier."""
    base = long_rows(docs).select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).cast("string").alias("text"))
    numbered = _numbered(base)
    found = written(_found(_units(numbered)), "units")
    texts = _packed(numbered)
    asked = found.filter("h IS NOT NULL").groupBy("doc", "alt").agg(F.collect_list(F.struct("h", "start", "n", "hot")).alias("asked"))

    compared = written(_compared(_cut(texts.join(asked, ["doc", "alt"]))), "compared")
    covered = found.filter("h IS NULL").select("doc", "alt", "start", "n").unionByName(compared)
    return texts, covered.groupBy("doc", "alt").agg(F.collect_list(F.struct("start", "n")).alias("found"))


def merged(found: list[tuple[int, int]] | None) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of bytes under the strings of ``found``."""
    out: list[tuple[int, int]] = []
    for start, n in sorted(found or ()):
        end = start + n + LENGTH - 1
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def whole_signs(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``runs`` narrowed to whole UTF-8 characters."""
    out = []
    for start, end in runs:
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, removed, kept), one row per row of ``docs``.

    ``removed`` are the maximal runs (start, end) of bytes that lie in a 100-byte
    string which also begins earlier: in a smaller doc_id or, in the same
    document, before. Strings are judged on the input and overlap freely.
    ``kept`` are the bytes that are left; with ``as_text`` runs are narrowed to
    whole characters and ``kept`` is a string.

    A null text counts as empty and has nothing removed, like one under 100
    bytes. Rows with a null doc_id are neither compared nor changed. Rows that
    repeat a doc_id and its text are one document and get the same answer; other
    texts under one id are ordered by a hash. An empty table gives an empty
    result. Equality of whole units rests on two 64-bit hashes.

    Anchors that occur very often are taken in parts of bounded size; the strings
    of the different units of each part then meet those of the others string by
    string, spread over all tasks.
    Each text moves twice, compressed.
    """
    texts, ranges = spans(docs, id_col, text_col)
    joined = texts.join(ranges, ["doc", "alt"], "left")

    def cut(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sizes, removed, kept = [], [], []
            for raw, found in zip(batch.column("raw").to_pylist(), batch.column("found").to_pylist()):
                data = unpack(raw)
                runs = merged([(f["start"], f["n"]) for f in found] if found else None)
                runs = whole_signs(data, runs) if as_text else runs
                ends = [0, *(e for _, e in runs)]
                left = b"".join(data[a:b] for a, b in zip(ends, [*(s for s, _ in runs), len(data)]))
                sizes.append(len(data))
                removed.append([{"start": s, "end": e} for s, e in runs])
                kept.append(left.decode("utf-8") if as_text else left)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.string() if as_text else pa.binary())],
                names=["doc_id", "n_bytes", "removed", "kept"])

    kind = "string" if as_text else "binary"
    return joined.select("doc", "raw", "found").mapInArrow(
        cut, f"doc_id bigint, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept {kind}")
