"""Parquet tables: scans, whole-table overwrite, and the two merges.

Three layouts are used.

* *Versioned* (Gold and the snapshot Silver tables): every overwrite is a new
  folder ``version-N``; the newest one that holds the committer's ``_SUCCESS``
  mark is the table. A reader never meets a half-written table and a failed
  job leaves the last good version in place.
* *Appended* (Silver clicks): partitioned by day, grown by insert-only merges.
* *Upserted* (rolling table): partitioned by hour, touched hours are rewritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..functions import null_safe_keys
from ..session import scratch

_MARK = "_SUCCESS"


# --- file system ---------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def _remove(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def remove_table(spark: SparkSession, path: str) -> None:
    _remove(spark, path)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all version folders, finished or not."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted(int(n.split("-")[1]) for n in names if n.startswith("version-"))


def _version_path(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/version-{number:09d}"


def _current(spark: SparkSession, path: str) -> str | None:
    """Folder that holds the table now, or None when there is no table."""
    numbers = _versions(spark, path)
    for number in reversed(numbers):
        if path_exists(spark, f"{_version_path(path, number)}/{_MARK}"):
            return _version_path(path, number)
    if numbers or not path_exists(spark, path):
        return None
    fs, target = _fs(spark, path)
    visible = [s for s in fs.listStatus(target) if s.getPath().getName()[0] not in "._"]
    return path if visible else None


# --- scans ---------------------------------------------------------------------


def table_exists(spark: SparkSession, path: str) -> bool:
    return _current(spark, path) is not None


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    current = _current(spark, path)
    if current is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.format(fmt).load(current)


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None when it was never written. Other errors still surface."""
    return read_table(spark, path, fmt) if table_exists(spark, path) else None


# --- writes --------------------------------------------------------------------


def write_counted(df: DataFrame, path: str, mode: str, partition_by: Sequence[str] = (),
                  fmt: str = "parquet", **options: str) -> int:
    """Write and return the row count, taken while writing (no second scan)."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.options(**options).save(path)
    return int(seen.get["rows"])


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                    fmt: str = "parquet") -> int:
    """Replace the table by a new version; returns the rows written.

    With ``partition_by`` the rows are first rebalanced on those columns, so a
    day lands in few files of the advisory size; AQE splits a day that is too
    big for one task.
    """
    spark = df.sparkSession
    numbers = _versions(spark, path)
    target = _version_path(path, numbers[-1] + 1 if numbers else 1)
    out = df.hint("rebalance", *partition_by) if partition_by else df
    return write_counted(out, target, "errorifexists", partition_by, fmt)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A catalogue table ``name`` over files at ``path``, dealt into ``buckets`` by
    ``key``: aggregates and joins on the key of tables with as many buckets need
    no shuffle. One task writes a bucket, so files are as many as buckets."""
    spark = df.sparkSession
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path)
     .mode("overwrite").saveAsTable(name))
    return spark.table(name)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` finished versions, and what dead writers
    left before the newest of them; returns what went."""
    numbers = _versions(spark, path)
    finished = [n for n in numbers if path_exists(spark, f"{_version_path(path, n)}/{_MARK}")]
    kept = set(finished[max(len(finished) - keep, 0):])
    gone = [_version_path(path, n) for n in numbers if kept and n < max(kept) and n not in kept]
    for old in gone:
        _remove(spark, old)
    return gone


# --- merges --------------------------------------------------------------------

_LISTED = 5_000  # partitions named in a filter; more are met by a semi-join


def rows_of_partitions(table: DataFrame, partition: str, values: Sequence) -> DataFrame:
    """The rows of ``table`` in the partitions ``values``, of any number. Other
    partitions are not read: a filter names a few, a join prunes for many."""
    column, known = F.col(partition), [v for v in values if v is not None]
    if len(known) <= _LISTED:
        named = column.isin(known) if known else F.lit(False)
        return table.filter(named | column.isNull() if len(known) < len(values) else named)
    spark = table.sparkSession
    kind = table.schema[partition].dataType
    wanted = spark.createDataFrame([(v,) for v in known], StructType([StructField("_value", kind)]))
    wanted = wanted.filter(F.col("_value") >= F.lit(min(known)))  # a filter makes Spark prune the other side by the values
    some = table.join(F.broadcast(wanted), column == F.col("_value"), "left_semi")
    return some.unionByName(table.filter(column.isNull())) if len(known) < len(values) else some


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the least by ``order``, then by all other columns, so
    the choice does not depend on task order. Copies combine before the shuffle."""
    others = [c for c in order if c not in keys]
    others += [c for c in df.columns if c not in keys and c not in others]
    if not others:
        return df.dropDuplicates(list(keys))
    least = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
    return least.select(*keys, "_row.*").select(*df.columns)


def merge_insert_only(df: DataFrame, path: str, keys: Sequence[str], partition: str,
                      order: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Insert the rows whose key is not in the table yet; returns rows inserted.

    ``partition`` must follow from the key (the day of the key's timestamp).
    The batch is de-duplicated and written once to scratch, so parsing happens
    once and a lost executor re-reads files. Only the table's days that occur in
    the batch are read, and only their key columns; the table itself is
    appended to, never rewritten. Run twice, the second run inserts nothing.
    """
    return insert_new(df, path, keys, partition, order, fmt, want_grown=False)[0]


def insert_new(df: DataFrame, path: str, keys: Sequence[str], partition: str,
               order: Sequence[str] = (), fmt: str = "parquet", want_grown: bool = True) -> tuple[int, list, list]:
    """``merge_insert_only``; also returns the partitions that got rows, and all
    that occur in the batch."""
    spark = df.sparkSession
    batch_path = scratch(spark, "merge-batch")
    first_per_key(df, keys, order).write.format(fmt).save(batch_path)
    batch = spark.read.format(fmt).load(batch_path)
    fresh = batch
    values = grown = [r[0] for r in batch.select(partition).distinct().collect()]  # a row per folder of the batch
    if table_exists(spark, path):
        table = rows_of_partitions(read_table(spark, path, fmt), partition, values)
        fresh = batch.alias("new").join(
            table.select(*keys).alias("old"), null_safe_keys("new", "old", keys), "left_anti"
        )
        if want_grown:  # a second anti-join, of the key columns alone
            grown = [r[0] for r in fresh.select(partition).distinct().collect()]
    rows = write_counted(fresh.hint("rebalance", partition), path, "append", [partition], fmt)
    _remove(spark, batch_path)
    return rows, grown, values


_STAGE = "_merge-"
_FILE_BYTES = 128 << 20


def _folders(spark: SparkSession, path: str) -> dict[str, str]:
    """Partition folders directly under ``path``, by name."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return {}
    found = [s.getPath() for s in fs.listStatus(target) if s.isDirectory() and "=" in s.getPath().getName()]
    return {p.getName(): p.toString() for p in found}


def _spread(spark: SparkSession, path: str, partition: str, values: Sequence) -> int:
    """Files that the largest of the touched partitions should have."""
    fs, whole = _fs(spark, path)
    if fs.getContentSummary(whole).getLength() <= _FILE_BYTES:
        return 1
    names = {f"{partition}={v}" for v in values}
    sizes = [fs.getContentSummary(_fs(spark, p)[1]).getLength() for n, p in _folders(spark, path).items() if unquote(n) in names]
    return max([1, *(-(-size // _FILE_BYTES) for size in sizes)])


def _put_in_place(spark: SparkSession, path: str, stage: str) -> None:
    """Exchange the table's folders for those of a finished stage. Each is two
    renames; what was moved already is no longer in the stage."""
    fs, table = _fs(spark, path)
    aside = _fs(spark, f"{stage}/_replaced")[1]
    fs.mkdirs(aside)
    old, new = _folders(spark, path), _folders(spark, stage)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def exchange(name: str) -> None:
        if name in old:
            fs.rename(Path(old[name]), aside.suffix("/" + name))
        fs.rename(Path(new[name]), table.suffix("/" + name))

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(exchange, new))
    _remove(spark, stage)


def _recover(spark: SparkSession, path: str) -> None:
    """Finish what a merge had written whole before its driver died; drop the rest."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return
    for found in fs.listStatus(target):
        stage = found.getPath().toString()
        if found.getPath().getName().startswith(_STAGE):
            if path_exists(spark, f"{stage}/{_MARK}"):
                _put_in_place(spark, path, stage)
            else:
                _remove(spark, stage)


def merge_upsert(df: DataFrame, path: str, keys: Sequence[str], partition: str) -> int:
    """Update rows with a matching key, insert the others; returns rows merged.

    ``partition`` must follow from the key, ``df`` must hold one row per key, and
    one merge at a time may run on a table. Only partitions that occur in the
    batch are read. Their new content is written once, beside the table, and takes
    the place of the old by renames, so a reader meets a partition either as it
    was or as it is. When a driver dies in between, the next merge finds the
    finished stage and goes on with it; an unfinished one it drops. A replayed
    batch changes nothing.
    """
    spark = df.sparkSession
    _recover(spark, path)
    batch = df.persist()  # read twice; a lost block is recomputed
    try:
        sizes = {r[0]: r[1] for r in batch.groupBy(partition).count().collect()}  # a row per folder that will be renamed
        if not sizes:
            return 0
        merged, exists = batch, table_exists(spark, path)
        if exists:
            old = rows_of_partitions(read_table(spark, path), partition, list(sizes))
            kept = old.alias("old").join(
                batch.select(*keys).alias("new"), null_safe_keys("old", "new", keys), "left_anti"
            )
            merged = kept.unionByName(batch)
        spread = _spread(spark, path, partition, list(sizes)) if exists else 1
        stage = _write_stage(merged, path, keys, partition, len(sizes) * spread, spread)
    finally:
        batch.unpersist()
    _put_in_place(spark, path, stage)
    return sum(sizes.values())


def _write_stage(df: DataFrame, path: str, keys: Sequence[str], partition: str, tasks: int, spread: int = 1) -> str:
    """Small folders are written side by side, large ones by several tasks."""
    stage = f"{path.rstrip('/')}/{_STAGE}{uuid.uuid4().hex[:12]}"
    tasks = max(1, min(tasks, 4 * df.sparkSession.sparkContext.defaultParallelism))
    part = F.pmod(F.xxhash64(*keys), F.lit(spread))
    df.repartition(tasks, partition, part).write.partitionBy(partition).parquet(stage)
    return stage


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str], partition: str, values: Sequence) -> None:
    """Put the rows of ``df`` in the place of the table's partitions ``values``,
    which must be all that occur in it; other partitions stay. As safe as ``merge_upsert``."""
    spark = df.sparkSession
    _recover(spark, path)
    if values:
        _put_in_place(spark, path, _write_stage(df, path, keys, partition, len(values)))
