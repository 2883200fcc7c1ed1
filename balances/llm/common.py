"""Shared helpers: session preparation, scratch tables in the shared folder,
column selection that tolerates extra or clashing columns."""
from __future__ import annotations

import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balances.session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where the repository lies on a
    path they can see (elsewhere, ship it with ``--py-files``)."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` as the session
    names it (a scratch folder only where it is unset)."""
    ensure_checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def new_path(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/llm-{kind}-{uuid.uuid4().hex}"


#: Spark deletes the shuffle files of a query as it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, kind: str) -> DataFrame:
    """Cut the lineage: write a Parquet table to the shared folder and read it
    back with the schema it was written with. Nothing reads the shuffles of the
    write again, so their files go with it, not when the driver collects."""
    conf, path = df.sparkSession.conf, new_path(df.sparkSession, kind)
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def narrow(df: DataFrame, kind: str) -> DataFrame:
    """``written`` for rows of a few ids: dealt anew to a sixteenth of the
    shuffle partitions first, so that a loop leaves few files."""
    few = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)
    return written(df.repartition(few), kind)


def kept(df: DataFrame) -> DataFrame:
    """Keep a result that several plans read on the executors' disks. What a
    lost executor held is computed again from its lineage, which stays short:
    loops cut theirs with ``written``."""
    df = df.persist(StorageLevel.DISK_ONLY)
    df.count()
    return df


def dropped(*frames: DataFrame) -> None:
    """Release scratch tables that no later plan reads."""
    for df in frames:
        path = getattr(df, "scratch_path", None)
        if path:
            delete_path(df.sparkSession, path)
        else:
            df.unpersist()


def small(batches, rows: int = 256):
    """Record batches of a few rows, so that a worker holds few texts at once."""
    import pyarrow as pa
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
        pa.default_memory_pool().release_unused()


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs: Spark deletes them once the
    driver's JVM has collected what referred to them, which it has no reason of
    its own to do while its heap has room. Asked for after steps that shuffle
    texts, so that their files do not add up over a run."""
    spark.sparkContext._jvm.System.gc()


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


#: Ids or row keys that may go to every task at once (16 MB); beyond it both sides shuffle.
BROADCAST_IDS = 1_000_000


def text_key(text_col: str = "text"):
    """The md5 of a text (of the empty one for null): rows of one id, or of
    none, are told apart by it."""
    return F.unhex(F.md5(text_or_empty(text_col)))


def without_texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text has its ``text_key`` among ``keys``
    (one column), whatever their ids. The keys are written once and broadcast
    only while their counted number is small."""
    gone = written(keys.toDF("_gone").distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(gone, text_key() == gone["_gone"], "left_anti")
