"""Where intermediate tables go.

On a cluster every executor must see the folder, so it is taken from
``spark.checkpoint.dir``.  Only a local master may fall back to a temporary
folder of this machine.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return _local_root(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _local_root(application: str) -> str:
    """One temporary folder per local application; the session's settings are
    left as they are."""
    return tempfile.mkdtemp(prefix=f"textgauge-{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df, name: str):
    """Write ``df`` to a new scratch table and read it back.

    The result has no lineage beyond its files, so a lost executor costs a
    re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
