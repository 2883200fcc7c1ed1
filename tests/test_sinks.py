import os
import tempfile

import pytest
from pyspark.sql import types as T

from balances.sources import sinks

SF = "/root/testdata/sf0.001"


def test_decision_log_append_and_empty(spark):
    root = tempfile.mkdtemp(prefix="balances-log-", dir="/tmp")
    path = os.path.join(root, "log")
    assert sinks.read_log(spark, path).count() == 0
    assert sinks.read_log(spark, path).columns == ["ts_utc", "key", "decision", "reason", "evidence"]
    sinks.log_decision(spark, path, "k1", "d1", "r1")
    sinks.log_decision(spark, path, "k2", "d2", "r2", {"lift": 1.05})
    rows = {r.key: r.evidence for r in sinks.read_log(spark, path).collect()}
    assert rows == {"k1": "{}", "k2": '{"lift": 1.05}'}


def test_write_table_schema_and_count(spark):
    root = tempfile.mkdtemp(prefix="balances-w-", dir="/tmp")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "customer_id long, x string")
    schema = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("x", T.StringType())])
    assert sinks.write_table(df, f"{root}/t", schema=schema) == 2
    with pytest.raises(ValueError):
        sinks.write_table(df.drop("x"), f"{root}/t2", schema=schema)
    with pytest.raises(FileNotFoundError):
        sinks.completeness_gate(spark, {"nope": f"{root}/missing"})
    sinks.completeness_gate(spark, {"t": f"file://{root}/t"})
    sinks.export_report(spark, {"big": 40_000_000_000}, f"{root}/r")
    assert "40000000000" in spark.read.json(f"{root}/r").first().counts
    with pytest.raises(ValueError):
        sinks.ingest(spark, {"a": lambda s: df}, f"{root}/in", expected=["a", "b"])
    assert sinks.ingest(spark, {"a": lambda s: df}, f"{root}/in", expected=["a"]) == {"a": 2}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")
def test_publish_layers(spark):
    from balances.plans.publish import publish
    root = tempfile.mkdtemp(prefix="balances-pub-", dir="/tmp")
    counts = publish(spark, SF, root)
    assert counts["gold/customer_features"] == counts["gold/dim_customer"] > 0
    assert counts["export/fact_score"] == counts["gold/customer_features"]
    assert os.path.isdir(f"{root}/export/_report")
