"""Embedding near-dedup: sign hashing in several tables, exact cosine, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import components, written

TILE = 4_096    # vectors of a bucket that one task compares with each other
_ROWS = 256     # rows of the similarity matrix held at once


def _vectors(rows: DataFrame, vec: str) -> DataFrame:
    """``rows`` with ``_vec``: the vector's doubles as bytes, null where it is
    null, empty or zero or holds a null or non-finite component."""
    v = F.col(vec).cast("array<double>")
    usable = (
        (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    typed = rows.select("_id", "_label", F.when(usable, v).alias("_v"))

    def pack(batches):
        for batch in batches:
            column = batch.column("_v")
            values = [None if x is None else np.asarray(x, np.float64).tobytes() for x in column.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_label"), pa.array(values, pa.binary())], names=["_id", "_label", "_vec"])

    kind = rows.schema["_label"].dataType.simpleString()
    return typed.mapInArrow(pack, f"_id bigint, _label {kind}, _vec binary")


def _keyed(classes: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """One row per class and table: its key there, and its keys in all tables."""

    def rows(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            raw = batch.column("_vec").to_pylist()
            sizes = np.array([len(r) // 8 for r in raw])
            for dim in np.unique(sizes):
                dim = int(dim)
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))
                own = np.flatnonzero(sizes == dim)
                matrix = np.frombuffer(b"".join(raw[i] for i in own), np.float64).reshape(len(own), dim)
                top = np.abs(matrix).max(axis=1, keepdims=True)
                signs = (matrix / top @ planes[dim] > 0).reshape(len(own), tables, bits)
                keys = (signs @ (1 << np.arange(bits, dtype=np.int64))).astype(np.int64)
                all_keys = pa.array([k.tobytes() for k in keys], pa.binary())
                part = batch.take(pa.array(own))
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [part.column("_label"), pa.array(np.full(len(own), dim, np.int32)), pa.array(np.full(len(own), t, np.int32)),
                         pa.array(np.ascontiguousarray(keys[:, t])), part.column("rep"), part.column("n"), part.column("_vec"), all_keys],
                        names=["_label", "dim", "tab", "key", "rep", "n", "_vec", "keys"])

    kind = classes.schema["_label"].dataType.simpleString()
    return classes.select("_label", "_vec", "rep", "n").mapInArrow(
        rows, f"_label {kind}, dim int, tab int, key bigint, rep bigint, n bigint, _vec binary, keys binary")


def _compare(pdf_columns: dict, table: int, threshold: float):
    """(rep, links, root) of one bucket: links counts the vectors at or above
    the threshold not found in an earlier table, root names the class."""
    matrix, keys, rep, n, side = (pdf_columns[c] for c in ("matrix", "keys", "rep", "n", "side"))
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    matrix /= np.sqrt((matrix * matrix).sum(axis=1))[:, None]
    size, mixed = len(rep), side.min() != side.max()
    links = np.zeros(size, np.int64)
    parent = np.arange(size)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for at in range(0, size, _ROWS):
        near = matrix[at : at + _ROWS] @ matrix[at:].T >= threshold
        i, j = np.nonzero(near)
        i, j = i + at, j + at
        keep = (i < j) & (side[i] != side[j] if mixed else True)
        i, j = i[keep], j[keep]
        if table and len(i):
            new = ~(keys[i, :table] == keys[j, :table]).any(axis=1)
            i, j = i[new], j[new]
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])
        apart = parent[i] != parent[j]
        for a, b in zip(i[apart].tolist(), j[apart].tolist()):
            a, b = find(a), find(b)
            if a != b:
                if rep[b] < rep[a]:
                    a, b = b, a
                parent[b] = a
    found = np.flatnonzero(links)
    return rep[found], links[found], rep[np.array([find(int(x)) for x in found], dtype=np.int64)]


def near_duplicates(rows: DataFrame, threshold: float = 0.98, tables: int = 16, bits: int = 12, seed: int = 11,
                    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``rows``.

    Vectors of equal label and size are compared when the signs of their
    products with ``bits`` random planes agree in one of ``tables`` tables; a
    pair is linked when its cosine in double precision is at least
    ``threshold``, and never below. A pair exactly at 0.98 shares a table with
    probability 0.9999 (16 tables of 12 bits). ``n_links`` counts a pair in the
    first table that holds it. Equal vectors are one class with a weight, so
    copies are never compared. Buckets beyond TILE classes are dealt to several
    tasks as pairs of chunks. Only counts and one class name per vector leave a
    task, never the pairs.

    A null label, and a vector that is null, empty, zero or has a null or
    non-finite component, links with nothing. A null id has no component, links
    with nothing and is kept. Repeated rows are vectors of their own. An empty
    table gives an empty result.
    """
    base = rows.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label_col).alias("_label"), F.col(vec_col).alias("_raw"))
    vectors = written(_vectors(base, "_raw"), "vectors")
    usable = vectors.filter("_id IS NOT NULL AND _label IS NOT NULL AND _vec IS NOT NULL")
    classes = written(
        usable.groupBy("_label", "_vec").agg(F.min("_id").alias("rep"), F.count(F.lit(1)).alias("n")), "vector-classes")
    bucket = ["_label", "dim", "tab", "key"]
    keyed = written(_keyed(classes, tables, bits, seed), "vector-keys")
    many = keyed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    chunks = F.when(F.col("rows") > TILE, F.ceil(F.col("rows") * 2 / TILE)).otherwise(F.lit(1))
    dealt = (
        keyed.join(many, bucket).withColumn("chunks", chunks)
        .withColumn("side", F.pmod(F.xxhash64("rep"), "chunks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
        .select(*bucket, F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "side", "rep", "n", "_vec", "keys")
    )
    group = [*bucket, "x", "y"]
    dealt = dealt.repartition(*group).sortWithinPartitions(*group)

    def compare(batches):
        def bucket_of(part: list[pa.RecordBatch]):
            whole = pa.Table.from_batches(part)
            if whole.num_rows < 2:
                return None
            size = whole.num_rows
            x, y = whole["x"][0].as_py(), whole["y"][0].as_py()
            columns = {
                "matrix": np.frombuffer(b"".join(whole["_vec"].to_pylist()), np.float64).reshape(size, -1),
                "keys": np.frombuffer(b"".join(whole["keys"].to_pylist()), np.int64).reshape(size, -1),
                "rep": whole["rep"].to_numpy(), "n": whole["n"].to_numpy(), "side": whole["side"].to_numpy(),
            }
            if x != y and columns["side"].min() == columns["side"].max():
                return None  # only one of the two chunks has rows here
            found = _compare(columns, whole["tab"][0].as_py(), threshold)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["rep", "links", "root"])

        part, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_pylist() for c in group]
            keys = list(zip(*columns))
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(edges, edges[1:]):
                if keys[a] != last:
                    if part and (out := bucket_of(part)) is not None:
                        yield out
                    part, last = [], keys[a]
                part.append(batch.slice(a, b - a))
        if part and (out := bucket_of(part)) is not None:
            yield out

    found = written(dealt.mapInArrow(compare, "rep bigint, links bigint, root bigint"), "vector-links")
    roots = components(found, "rep", "root", label="vector-components")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = (
        classes.join(links, "rep", "left").join(roots, classes["rep"] == roots["node"], "left")
        .select(F.col("_label").alias("l"), F.col("_vec").alias("v"),
                (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("root", "rep").alias("root"))
    )
    known = written(known, "vector-known")
    joined = vectors.join(known, (vectors["_label"] == known["l"]) & (vectors["_vec"] == known["v"]) & vectors["_id"].isNotNull(), "left")
    root = F.coalesce("root", "_id")
    return joined.select(
        F.col("_id").alias("vec_id"), F.coalesce("links", F.lit(0).cast("bigint")).alias("n_links"),
        root.alias("component_id"), F.coalesce(F.col("_id") == root, F.lit(True)).alias("kept"))
