"""Session helpers: configuration, shared scratch space, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from saldora.ddl import struct

# Rows a relation may have to be held by the driver and broadcast. With the narrow
# rows it is used for (keys, a few numbers) this is a few megabytes.
SMALL_ROWS = 50_000


def local_session(cpus: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-node session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("saldora")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a
    cluster a machine-local folder would be wrong, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="saldora-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder for a written intermediate table."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, so that a lost executor changes nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _local(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    table = pa.table(
        [pa.array(c, type=to_arrow_type(f.dataType)) for c, f in zip(columns, schema)],
        names=schema.names,
    )
    return spark.createDataFrame(table, schema=schema)


def local_frame(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A driver-side relation of a few rows; as an Arrow table it needs no Python worker."""
    return _local(spark, rows, struct(ddl))


def local_arrays(spark: SparkSession, columns: Mapping, ddl: str) -> DataFrame:
    """A relation from arrays by column name."""
    schema = struct(ddl)
    table = pa.table([pa.array(columns[f.name], type=to_arrow_type(f.dataType)) for f in schema], names=schema.names)
    return spark.createDataFrame(table, schema=schema)


def small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast ``df`` if it really is small, else return it unhinted.

    The check fetches at most ``max_rows + 1`` rows; beyond the bound the caller's
    join stays an ordinary shuffle join that AQE may split on skew.
    """
    # collect() of a limit reads partitions step by step and stops at the bound
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(_local(df.sparkSession, rows, df.schema))


def right_size(df: DataFrame, rows: int, per_partition: int = 20_000) -> DataFrame:
    """Fewer partitions for an iterative job on few rows; never more than there are.

    Every iteration schedules one task per partition, so thousands of near-empty ones
    cost more than the work. Large inputs keep their partitioning.
    """
    return df.coalesce(max(1, -(-rows // per_partition)))


def spread(df: DataFrame, rows: int, least: int, most: int) -> DataFrame:
    """Partitions for an iterative job: as many as there are cores if each gets ``least`` rows, and
    more where one would get over ``most``. Rows are dealt anew, whatever their partitioning was.
    """
    tasks = max(min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // least)), -(-rows // most), 1)
    return df.coalesce(1) if tasks == 1 else df.repartition(tasks)
