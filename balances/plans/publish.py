"""Publish the layered tables (the reference's monthly full refresh):
bronze copies, silver panel, gold features + star schema (constraints checked
before publishing, dimensions before facts), score fact, serving marts and
CSV exports with a row-count report."""
from __future__ import annotations

from pyspark.sql import SparkSession

from balances.operators import audit, marts, models, quality, sizing, star
from balances.plans import queries as Q
from balances.sources import sinks, tables


def publish(spark: SparkSession, sf_dir: str, out_root: str) -> dict[str, int]:
    out_root = out_root.rstrip("/")
    counts = sinks.ingest(spark, {
        "balances": lambda s: tables.balances(s, sf_dir),
        "customers": lambda s: tables.raw_customers(s, sf_dir),
        "income_estimates": lambda s: tables.income_estimates(s, sf_dir),
    }, out_root, expected=("balances", "customers", "income_estimates"))
    sinks.completeness_gate(spark, {k: f"{out_root}/bronze/{k}" for k in counts})  # before any later layer
    panel = Q.panel_layer(spark, sf_dir)
    counts["silver/monthly_panel"] = sinks.write_table(
        panel, f"{out_root}/silver/monthly_panel", partition_by=["product"])
    feats = Q.features_ckpt(spark, sf_dir)
    schema = star.star_schema(feats, panel)
    report = quality.constraint_report(schema, Q.STAR_PKS, Q.STAR_NOT_NULL, Q.STAR_FKS)
    quality.assert_clean(report)  # publish gate
    counts["gold/customer_features"] = sinks.write_table(feats, f"{out_root}/gold/customer_features")
    for name in ("dim_customer", "dim_product", "dim_time", "fact_monthly"):
        counts[f"gold/{name}"] = sinks.write_table(schema[name], f"{out_root}/gold/{name}")
    trained = Q.propensity_layer(spark, sf_dir)
    fact = Q.trained_fact_layer(spark, sf_dir)
    models.save_models({f"propensity_{k.lower()}": m for k, m in trained["models"].items()}
                       | Q.forecast_layer(spark, sf_dir)["models"], f"{out_root}/models")
    sinks.write_artifact(Q.q_model_metrics(spark, sf_dir), f"{out_root}/models/_metrics")
    sinks.log_decision(spark, f"{out_root}/decisions", "score_source", "trained",
                       "score fact from fitted propensity and amount models", trained["metrics"])
    counts["gold/fact_score"] = sinks.write_table(fact, f"{out_root}/gold/fact_score")
    sinks.log_decision(spark, f"{out_root}/decisions", "missing_estimate", Q.q_missing_pattern_model(spark, sf_dir).first()["action"],
                       "rule on the pattern model's AUC", {"auc": Q.pattern_layer(spark, sf_dir)["auc"]})
    proxy = Q.q_gender_proxy_model(spark, sf_dir)
    blocks = sizing.commercial_blocks(fact)
    exports = {
        "contact_list": marts.contact_list(fact, Q.CONTACT_N, levels=("A",)),
        "fairness_fact": audit.fairness_fact(fact, Q.AUDIT_ATTRS, proxy.select("auc", "band")),
        "importance_fact": Q.q_importance_fact(spark, sf_dir),
        "summary": Q.q_summary_published(spark, sf_dir),
        "quality_report": Q.q_quality_report(spark, sf_dir),
        "sizing": sizing.sizing_cube(blocks),
        "facet_counts": marts.facet_counts(fact),
        "fact_score": fact.select(*Q.SCORE_COLS),
        "dim_customer": schema["dim_customer"],
        "fact_monthly": schema["fact_monthly"],
    }
    csv_counts = sinks.export_csv(exports, f"{out_root}/export")
    counts.update({f"export/{k}": v for k, v in csv_counts.items()})
    sinks.export_report(spark, counts, f"{out_root}/export/_report")
    return counts
