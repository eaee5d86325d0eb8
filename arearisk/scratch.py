"""Intermediate tables on storage every executor can reach.

A few operators need one table twice, or need Catalyst to know how small it
is. `materialize` writes it under the checkpoint folder and reads it back:
the lineage is cut, a lost executor costs nothing but the running tasks, and
the file size gives the planner a checked size, so small tables are broadcast
by `spark.sql.autoBroadcastJoinThreshold` and large ones are not.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_stored: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`; a temporary one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="arearisk-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as Parquet in the scratch folder and return the stored table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    _stored.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the tables this process stored; call it when their results are written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _stored:
        path = jvm.org.apache.hadoop.fs.Path(_stored.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone
