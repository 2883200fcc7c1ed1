"""Sinks and artefacts (IO2, IO3, IO5-IO11).

Tables are Parquet directories under a root (bronze / silver / gold /
marts); small artefacts are one-row DataFrames written as JSON; the decision
log is an append-only Parquet table. Nothing is collected to the driver
except the per-table row counts observed during the write.
"""
from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType([
    T.StructField("ts_utc", T.TimestampType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("decision", T.StringType(), False),
    T.StructField("reason", T.StringType(), True),
    T.StructField("evidence", T.StringType(), True),
])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its own store (local, HDFS, object store)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def check_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared schema before write: every declared column present with its
    type (casts are explicit, never inferred)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing declared columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_table(df: DataFrame, path: str, mode: str = "overwrite", schema: T.StructType | None = None,
                partition_by=None, sort_within=None) -> int:
    """IO2: overwrite or append a Parquet table; optional declared schema,
    partition columns (replaces SQLite indices) and in-file sort order. The
    row count is observed during the same write (no second pass, IO7)."""
    if schema is not None:
        df = check_schema(df, schema)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    obs = Observation(f"rows_{abs(hash(path))}")
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


def ingest(spark: SparkSession, registry: dict, out_root: str, expected=None) -> dict[str, int]:
    """IO3: bronze copy of every registered source ``name -> DataFrame
    factory``, projected to the declared columns; returns rows per table. With
    ``expected``, a source of another name, or one that is missing, is refused
    before anything is written."""
    if expected is not None and set(registry) != set(expected):
        raise ValueError(f"sources {sorted(registry)}, expected {sorted(expected)}")
    return {name: write_table(make(spark), f"{out_root}/bronze/{name}") for name, make in registry.items()}


def export_csv(tables: dict[str, DataFrame], out_root: str) -> dict[str, int]:
    """IO5: CSV with header, ids as text (IO8 / F16 exactness: a long never
    passes through a double)."""
    counts = {}
    for name, df in tables.items():
        out = df.select(*[F.col(c).cast("string").alias(c) if c.endswith("_id") else F.col(c)
                          for c in df.columns])
        obs = Observation(f"csv_{name}")
        out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
        out.write.mode("overwrite").option("header", True).csv(f"{out_root}/{name}")
        counts[name] = int(obs.get["rows"])
    return counts


def completeness_gate(spark: SparkSession, paths: dict[str, str]) -> None:
    """IO6: refuse to go on when an upstream artefact is missing."""
    missing = [k for k, p in paths.items() if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing upstream artefacts: {missing}")


def export_report(spark: SparkSession, counts: dict[str, int], out_path: str) -> DataFrame:
    """IO7: rows per artefact as a one-row JSON."""
    df = spark.createDataFrame([(json.dumps(counts, sort_keys=True),)], "counts string")
    df.coalesce(1).write.mode("overwrite").json(out_path)
    return df


def write_artifact(df_one_row: DataFrame, path: str) -> None:
    """IO9: a one-row DataFrame of structs written as one JSON document."""
    df_one_row.coalesce(1).write.mode("overwrite").json(path)


def log_decision(spark: SparkSession, path: str, key: str, decision: str, reason: str,
                 evidence: dict | None = None) -> None:
    """IO10: append one audit row; UTC timestamp; evidence as JSON text
    (empty object when none)."""
    row = (dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), key, decision, reason,
           json.dumps(evidence or {}, sort_keys=True, default=str))
    spark.createDataFrame([row], LOG_SCHEMA).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """IO11: the decision log, or an empty frame with the log columns."""
    if path_exists(spark, path):
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    return spark.createDataFrame([], LOG_SCHEMA)
