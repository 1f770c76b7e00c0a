"""Tables written to the session's shared folder, to cut the lineage of iterated plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few numbers that are broadcast, at most: 64 bytes each; more are joined by a shuffle.
MAX_SENT = 200_000


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors see. A session of one machine that names none, as in tests, gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='parlance-')}"
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = folder(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sent(slim: DataFrame) -> DataFrame:
    """A written table of small rows, for a join: broadcast where its size is known to allow it."""
    return F.broadcast(slim) if slim.count() <= MAX_SENT else slim
