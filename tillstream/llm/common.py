"""Helpers shared by the operators: tables, scratch, connected components."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..session import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ARROW_ROWS = 2_000  # rows of a batch: texts are long, and a batch exists several times over on its way


def long_rows(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold few rows. A setting of the
    user's own stays."""
    setting, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if int(conf.get(setting)) == 10_000:
        conf.set(setting, str(ARROW_ROWS))
    return df


def once(value: Column) -> Column:
    """``value`` as the output of a generator. Filters on it are then not pushed
    below, where they would compute the expression a second time."""
    return F.explode(F.array(value))


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as files in the shared scratch folder: what follows reads them
    instead of computing them again, and a lost executor costs no recomputation."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.bit_xor(F.xxhash64("u", "v", F.lit(1))),
    ).first())


def components(pairs: DataFrame, a: str = "a", b: str = "b", label: str = "components") -> DataFrame:
    """(node, root): every node that occurs in ``pairs`` of long ids with the
    smallest id reachable from it.

    Rounds of large-star and small-star steps: each node hangs its larger, then
    its smaller neighbours under the least id it knows, until nothing moves.
    Rounds grow with the logarithm of the longest chain. Minima combine before
    the shuffle, so a hub costs one row per task there; the join that hands a
    minimum back is one that AQE splits. Each round ends in files of the shared
    folder, which cuts the lineage. Pairs with a null or with equal ends only
    name no link and are left out.
    """
    ordered = pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = written(
        ordered.filter(pairs[a].isNotNull() & pairs[b].isNotNull() & (pairs[a] != pairs[b])).distinct(),
        label,
    )
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(root, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(root.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = written(small, label)
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def map_texts(docs: DataFrame, rows, schema: str, id_col: str = "doc_id", text_col: str = "text",
              flush: int = 50_000) -> DataFrame:
    """Run ``rows(pairs)`` over each task's (id, text) pairs, a null text as
    None; it yields tuples of ``schema``. Only the two columns leave the scan,
    and no more than ``flush`` result rows and one Arrow batch are held."""
    typed = long_rows(docs).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    target = to_arrow_schema(_parse_datatype_string(schema))

    def batch_of(part: list) -> pa.RecordBatch:
        columns = zip(*part) if part else [[]] * len(target)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    def run(batches):
        def pairs():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        part: list = []
        for row in rows(pairs()):
            part.append(row)
            if len(part) >= flush:
                yield batch_of(part)
                part = []
        yield batch_of(part)

    return typed.mapInArrow(run, schema)
