"""Where jobs put data that every executor must reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Whether Spark removes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; on a
    cluster a missing setting is an error, since a driver-local folder would
    not be visible to the executors.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tagloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, name: str = "table", codec: str | None = None, last: bool = False) -> DataFrame:
    """Write rows that several later steps read to the shared folder, as a Parquet table.

    ``codec`` is for wide tables whose size matters more than the time to pack them. With ``last`` the shuffle files of
    this write are removed as soon as it is done, instead of when the driver happens to collect its garbage.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    if last:
        conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    finally:
        if last and before is None:
            conf.unset(SHUFFLE_CLEANUP)
        elif last:
            conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint that keeps the partitions and the order of the rows in them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of driver rows as a frame."""
    struct = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = [pa.array([row[i] for row in rows], arrow.field(i).type) for i in range(len(struct))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), struct)


def spread(df: DataFrame) -> DataFrame:
    """Give every core a part of a table that is stored in few, large pieces.

    A table with as many scan partitions as the session has cores is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
