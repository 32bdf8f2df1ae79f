"""Session builder and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Sizes that matter at cluster scale. AQE starts from the wide shuffle and
# coalesces to the advisory size, so one value serves small and large inputs.
WIDE_SHUFFLE = 4096
ADVISORY_PARTITION = "128m"


def build(
    app: str = "tillstream",
    master: str | None = None,
    shuffle_partitions: int = WIDE_SHUFFLE,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings every job here relies on.

    ``master`` stays unset on a cluster (``spark-submit`` names it).
    ``shuffle_partitions`` is the width *before* AQE coalesces; a stateful
    stream keeps the width of its first run, so choose it before the first
    start of a checkpoint.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", ADVISORY_PARTITION)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_unset: dict[str, str] = {}  # stand-ins for settings a local session does not carry
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)  # paths made in the scope of this thread


def _shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only on a local master without that setting
    (tests, a laptop) one temporary folder of this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "scratch" not in _unset:
        _unset["scratch"] = tempfile.mkdtemp(prefix="tillstream-")
    return _unset["scratch"]


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    path = f"{_shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was put under scratch paths made inside, by this
    thread or by threads that run in a copy of its context. For jobs whose
    results lie elsewhere; frames that still read scratch must not escape."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in made:
            target = hadoop.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative ML cuts its lineage only when a checkpoint folder is set."""
    if not spark.conf.get("spark.checkpoint.dir", None) and "checkpoints" not in _unset:
        _unset["checkpoints"] = f"{_shared_folder(spark)}/rdd-checkpoints-{uuid.uuid4().hex[:12]}"  # outlives any scope
        spark.sparkContext.setCheckpointDir(_unset["checkpoints"])
