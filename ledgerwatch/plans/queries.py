"""Named queries: (spark, sf_dir) -> DataFrame, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions import full_name
from ledgerwatch.operators import alerts, rules
from ledgerwatch.session import scratch_dir
from ledgerwatch.sources import testtables as tt

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# -------------------------------------------------------------------- rules
@query("fraud_enriched")
def q_fraud_enriched(spark, sf_dir):
    return rules.enriched(tt.rule_inputs(spark, sf_dir))


@query("fraud_rule1")
def q_fraud_rule1(spark, sf_dir):
    return rules.rule1(tt.rule_inputs(spark, sf_dir), tt.REPORT_TS)


@query("fraud_rule1_blocked")
def q_fraud_rule1_blocked(spark, sf_dir):
    return rules.rule1(tt.rule_inputs(spark, sf_dir), tt.REPORT_TS, which="blocked")


@query("fraud_rule1_expired")
def q_fraud_rule1_expired(spark, sf_dir):
    return rules.rule1(tt.rule_inputs(spark, sf_dir), tt.REPORT_TS, which="expired")


@query("fraud_rule2")
def q_fraud_rule2(spark, sf_dir):
    return rules.rule2(tt.rule_inputs(spark, sf_dir), tt.REPORT_TS)


@query("fraud_rule3_pairs")
def q_fraud_rule3_pairs(spark, sf_dir):
    return rules.rule3_pairs(tt.rule_inputs(spark, sf_dir))


@query("fraud_rule3_earlier")
def q_fraud_rule3_earlier(spark, sf_dir):
    return rules.rule3(tt.rule_inputs(spark, sf_dir), tt.REPORT_TS, side="earlier")


@query("fraud_rule3_later")
def q_fraud_rule3_later(spark, sf_dir):
    return rules.rule3(tt.rule_inputs(spark, sf_dir), tt.REPORT_TS, side="later")


@query("fraud_rule3")
def q_fraud_rule3(spark, sf_dir):
    return rules.rule3(tt.rule_inputs(spark, sf_dir), tt.REPORT_TS)


@query("fraud_report")
def q_fraud_report(spark, sf_dir):
    return rules.fraud_report(tt.rule_inputs(spark, sf_dir), tt.REPORT_TS)


def _per_alert(counted: DataFrame) -> DataFrame:
    columns = [k for k in alerts.KEY if k != "card_num"]
    return counted.groupBy(*columns).agg(F.sum("n").alias("n")).where("n <> 0")


@query("fraud_report_counted")
def q_fraud_report_counted(spark, sf_dir):
    return _per_alert(alerts.counted(tt.rule_inputs(spark, sf_dir)))


def _two_runs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The counted alerts stored by a first run, and the changes a second one adds."""
    first, then = tt.rule_inputs_at_two_runs(spark, sf_dir)
    path = scratch_dir(spark, "alerts-first-run")
    alerts.counted(first).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    return stored, alerts.changes(tt.rule_inputs(spark, sf_dir), alerts.Changes(**then), stored, [])


@query("fraud_report_changes")
def q_fraud_report_changes(spark, sf_dir):
    return _per_alert(_two_runs(spark, sf_dir)[1])


@query("fraud_report_two_runs")
def q_fraud_report_two_runs(spark, sf_dir):
    stored, added = _two_runs(spark, sf_dir)
    return alerts.expanded(stored.unionByName(added), tt.REPORT_TS)


@query("fn_full_name")
def q_fn_full_name(spark, sf_dir):
    c = tt.clients_hist(spark, sf_dir)
    return c.select("client_id", full_name("last_name", "first_name", "patronymic").alias("fio"))


def oracle() -> dict[str, str]:
    from ledgerwatch.plans.oracle_loads import LOAD_SQL
    from ledgerwatch.plans.oracle_rules import RULE_SQL
    from ledgerwatch.plans.oracle_scd2 import SCD2_SQL
    out = {**RULE_SQL, **SCD2_SQL, **LOAD_SQL}
    return {k: v for k, v in out.items() if k in REGISTRY}


# The other query families register themselves on import.
from ledgerwatch.plans import queries_loads, queries_scd2  # noqa: E402,F401
