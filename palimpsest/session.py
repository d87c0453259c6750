"""Where intermediate results go: the shared folder the session names."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_CONF = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a local one only in one process."""
    context = spark.sparkContext
    shared = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="palimpsest-"))
        shared = context.getCheckpointDir()
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{scratch_root(spark)}/palimpsest/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once and read back: cuts lineage in a way that survives lost executors."""
    return written(df, scratch_path(df.sparkSession, name))


def written(df: DataFrame, path: str) -> DataFrame:
    """Written to this place and read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, if it is there."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Names of the partitions a write with ``depth`` partition columns has made."""
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
    names = [""]
    for _ in range(depth):
        names = [
            f"{name}/{below.getPath().getName()}".lstrip("/")
            for name in names
            for below in files.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}".rstrip("/")))
            if below.isDirectory() and "=" in below.getPath().getName()
        ]
    return names


def local_rows(
    spark: SparkSession, rows: Sequence[tuple], schema: StructType | str
) -> DataFrame:
    """A few driver-side rows as a local relation, whose size the optimizer knows."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    columns = zip(*rows) if rows else ([] for _ in schema.names)
    table = pa.table({n: list(c) for n, c in zip(schema.names, columns)})
    return spark.createDataFrame(table, schema)
