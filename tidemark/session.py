"""Session settings and the shared folder used for frozen intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # looking up the call site of every column expression costs more than planning a query
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName("tidemark")
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in spark.checkpoint.dir.

    Only where that is unset and the master is local, so that driver and executors are one process, as in tests, a
    folder of its own is made.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            named = tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(named)
    return named or sc.getCheckpointDir()


_handed_out: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete what scratch_path has handed out so far, once no result is read from it any more; gives the number."""
    sc, n = spark.sparkContext, 0
    while _handed_out:
        path = sc._jvm.org.apache.hadoop.fs.Path(_handed_out.pop())
        n += path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    return n


def freeze(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and go on from the written table.

    Used where later steps must see exactly the rows and partition numbers of the first evaluation, also
    after an executor is lost. Unlike checkpoint(), which evaluates its input twice, this takes one pass,
    and later steps read only the columns they need. release() deletes it.
    """
    path = scratch_path(df.sparkSession, "frozen")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
