"""The folder that the driver and all executors share, and cutting lineage there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder (spark.checkpoint.dir); in a local one where that is unset, as in tests."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *, codec: str = "zstd", level: int = 3) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage ends there, and a lost executor costs nothing."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", codec).option("parquet.compression.codec.zstd.level", level).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
