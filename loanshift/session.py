"""Session helper and the one way this package cuts lineage.

Intermediate tables go to the shared folder the cluster names in
``spark.checkpoint.dir``, so they outlive the executor that wrote them.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_STORED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_SCOPES: list[list[str]] = []
_FREEING: dict[str, tuple[int, str]] = {}
_LOCK = threading.Lock()


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "loanshift") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, as the session configures it.

    Only a local session may leave it unset: driver and executors are then one
    process, and a temporary folder of this process is shared by all of them.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _own_folder()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="loanshift-")


@contextmanager
def _freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Have Spark remove a query's shuffle files when it ends: what it wrote is stored, nothing reads them again.

    Several threads may store at once: the first to come sets the option, the last to go restores it.
    """
    key, session = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", spark._jsparkSession.sessionUUID()
    with _LOCK:
        users, before = _FREEING.get(session) or (0, spark.conf.get(key, "false"))
        _FREEING[session] = (users + 1, before)
        spark.conf.set(key, "true")
    try:
        yield
    finally:
        with _LOCK:
            users, before = _FREEING.pop(session)
            if users > 1:
                _FREEING[session] = (users - 1, before)
            else:
                spark.conf.set(key, before)


def materialize(df: DataFrame, partition_by: list[str] | None = None, rows_a_group: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Beyond cutting lineage this gives Catalyst a measured size: a small table
    is broadcast because it *is* below ``spark.sql.autoBroadcastJoinThreshold``,
    a large one is joined by shuffle. The table stays until ``discard`` or the
    end of the ``scratch`` scope it was made in.

    Writers and readers hold a row group of Parquet, which by default has 100
    rows at least: rows of megabytes need ``rows_a_group``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_a_group:
        writer = writer.option("parquet.block.row.count.limit", rows_a_group)
    with _freeing_shuffles(spark):
        writer.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _STORED[stored] = path
    for scope in _SCOPES:
        scope.append(path)
    return stored


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a table's size, from file sizes and without a job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again."""
    for table in tables:
        _delete(table.sparkSession, _STORED.pop(table))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, every table ``materialize`` stored inside; consume results before that."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for path in made:
            _delete(spark, path)
