"""SparkSession and checkpoint helpers."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "balances") -> SparkSession:
    """Session for local runs and tests. On a cluster, the cluster's own
    settings (master, checkpoint dir, memory) win: builder options only fill
    what is unset when the session is first created."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BALANCES_DRIVER_MEMORY", "6g"))
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir`` (a shared folder). Where it is
    unset, a local master gets a scratch folder; any other master is refused,
    since executors would not see it."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="balances-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never localCheckpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Tables written by ``materialise``, the oldest first: a layer that is built
#: again deletes those of its predecessor.
WRITTEN: list[str] = []


def materialise(df: DataFrame, name: str, sort_by: str | None = None, lookup_by: str | None = None) -> DataFrame:
    """Write a layer as a Parquet table in the shared folder and read it back,
    so that what reads it prunes columns and pushes filters down. With
    ``lookup_by`` rows are dealt by ranges of that column and sorted, so that
    a point lookup opens few row groups (min/max), and files carry a bloom
    filter of it for ids that lie within a group's range but are not there."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if lookup_by:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, lookup_by)
        sort_by = lookup_by
    writer = (df.sortWithinPartitions(sort_by) if sort_by else df).write
    if lookup_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{lookup_by}", "true")
    writer.parquet(path)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_tables(spark: SparkSession, paths) -> None:
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def broadcast_checked(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast only after the row count is checked (one small job); above
    the bound the frame is returned as is and the planner shuffles."""
    from pyspark.sql import functions as F
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
