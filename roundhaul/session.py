"""Session settings and the shared folder that written tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


ADVISORY_BYTES = 128 * 1024**2


def shuffle_partitions(data_bytes: int, most: int | None = None) -> int:
    """How many partitions a shuffle of that much data starts with.

    Adaptive execution merges small partitions but cannot split those of an aggregation, so
    the start must be wide enough. ``most`` bounds it where the number of blocks (maps times
    partitions) would cost more than larger partitions that spill; without it there is no bound.
    """
    wanted = max(200, -(-data_bytes // ADVISORY_BYTES))
    return wanted if most is None else min(wanted, most)


def build_session(
    app_name: str = "roundhaul", master: str | None = None, data_bytes: int | None = None, most_partitions: int | None = None, **settings: str
) -> SparkSession:
    """A session with the settings this engine expects, sized for ``data_bytes`` of input and at most ``most_partitions``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(ADVISORY_BYTES))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if data_bytes:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(data_bytes, most_partitions)))
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def allow_times(spark: SparkSession) -> None:
    """Let the session hold times of day in a type of their own, for contracts `with_native_times`."""
    spark.conf.set("spark.sql.timeType.enabled", "true")


def activate(spark: SparkSession) -> None:
    """Make the session, and so its settings, those of the calling thread; a thread of a pool begins without one."""
    getattr(getattr(spark._jvm, "SparkSession$"), "MODULE$").setActiveSession(spark._jsparkSession)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is missing and the whole
    session lives in one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder under the shared one that no earlier run has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A few rows the driver already holds, such as one per table, as a DataFrame.

    Handed over as Arrow they become a local relation of known size; from a list, Spark
    would start Python workers on the executors to read them.
    """
    kinds = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    held = [dict(zip(kinds.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(held, schema=to_arrow_schema(kinds)), kinds)
