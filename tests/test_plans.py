"""Physical-plan properties that matter at scale."""

import collections
import datetime as dt
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from ledgerwatch.operators import capture, facts, rules
from ledgerwatch.sources import testtables as tt
from test_rules import BASE, REPORT, frames, model, spark_all, tx


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_watermark_reaches_parquet_scan(spark):
    path = tempfile.mkdtemp(prefix="lw-fact-")
    spark.createDataFrame([("t1", dt.datetime(2024, 1, 1, 1)), ("t2", dt.datetime(2024, 1, 2))],
                          "trans_id string, trans_date timestamp_ntz").write.mode("overwrite").parquet(path)
    fact = spark.read.parquet(path)
    wm = capture.advance_watermark(capture.seed_watermarks(spark), "fact_transactions",
                                   F.lit(dt.datetime(2024, 1, 1, 12)).cast("timestamp_ntz"))
    df = capture.capture_strict(fact, "trans_date", capture.watermark_of(wm, "fact_transactions"))
    plan = _plan(df)
    assert "GreaterThan(trans_date,ScalarSubquery" in plan
    assert [r.trans_id for r in df.collect()] == ["t2"]


def test_rule_scans_read_only_needed_columns(spark):
    plan = rules.rule1(tt.rule_inputs(spark, SF001), REPORT)._jdf.queryExecution().executedPlan().toString()
    events_scans = [line for line in plan.split("\n") if "events.parquet" in line]
    assert events_scans
    for line in events_scans:
        schema = line.split("ReadSchema: ")[1]
        assert "props" not in schema and "value" not in schema


def test_replay_needs_no_driver_loop(spark, monkeypatch):
    """Thousands of batches are one plan: nothing is collected to build it."""
    n = 3000
    rows = spark.range(n).select(F.col("id").cast("int").alias("b"),
                                 F.timestamp_add("SECOND", F.col("id") * F.when(F.col("id") % 2 == 0, 1).otherwise(-1),
                                                 F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")).alias("d"))
    monkeypatch.setattr(type(rows), "collect", lambda self: 1 / 0)
    out = facts.replay_batches(rows, "d", "b")
    monkeypatch.undo()
    assert out.count() == n // 2


def test_rule3_moves_no_raw_facts_to_the_terminals(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [f(tt.rule_inputs(spark, SF001), REPORT)._jdf.queryExecution().executedPlan().toString() for f in (rules.rule3, rules.fraud_report)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        lines = plan.split("\n")
        at = next(k for k, line in enumerate(lines) if "hashpartitioning(terminal#" in line)
        # What is dealt by terminal are counts: an aggregate lies below, before the next exchange.
        below = lines[at + 1:at + 6]
        assert any("HashAggregate" in line and "trans_date" in line for line in below), below


def test_latest_versions_scan_the_history_once(spark, tmp_path):
    from ledgerwatch.operators import scd2
    from ledgerwatch.schemas import DIMENSIONS
    spec = DIMENSIONS["cards"]
    scd2.empty_history(spark, spec).write.parquet(str(tmp_path / "h"))
    plan = scd2.latest_versions(spec, spark.read.parquet(str(tmp_path / "h")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Join" not in plan


def test_hot_card_against_brute_force(spark):
    """One card holds most facts, many in the same second and hour, in
    several cities: counts stay exact."""
    t = dict(BASE)
    txs = []
    for i in range(120):
        secs = (i * 37) % 5400 if i % 3 else 100  # a third land in the same second
        txs.append(tx(i, secs, "C1", ["T1", "T2", "T4", "T5"][i % 4]))
    txs += [tx(200 + i, i * 600, "C2", "T2") for i in range(6)]
    t["transactions"] = txs
    got, exp = spark_all(spark, t), model(t)
    for k in exp:
        assert got[k] == exp[k], k
    assert sum(exp["rule3"].values()) > 1000


def test_rule3_windows_partition_by_card_and_bucket(spark):
    t = dict(BASE)
    t["transactions"] = [tx(1, 0, "C1", "T1"), tx(2, 60, "C1", "T2")]
    plan = rules.rule3(frames(spark, t), REPORT)._jdf.queryExecution().executedPlan().toString()
    window_lines = [line for line in plan.split("\n") if "Window [sum(" in line]
    assert window_lines and all("_b#" in line for line in window_lines)
    _ = collections


def test_a_dimension_load_scans_its_source_once(spark, tmp_path):
    from ledgerwatch.operators import scd2
    from ledgerwatch.schemas import DIMENSIONS
    spec = DIMENSIONS["cards"]
    src = tt.source_snapshot(spark, SF001, "cards", 1)
    latest = scd2.empty_history(spark, spec)
    latest.write.parquet(str(tmp_path / "latest"))
    latest = spark.read.schema(spec.history_schema()).parquet(str(tmp_path / "latest"))
    rows = capture.stage_source(spec, src, "1900-01-01 00:00:00", tt.RUN_TS[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = scd2.latest_and_retired(spec, scd2.merge_source_frame(spec, latest, rows, tt.RUN_TS[1]))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("customer.parquet" in line for line in plan.split("\n")) == 1
    assert "Union" not in plan and "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning(_k#") == 2  # each side once


def test_rows_without_a_key_are_inserted_and_kept(spark):
    from ledgerwatch.operators import scd2
    from ledgerwatch.schemas import DIMENSIONS
    spec = DIMENSIONS["cards"]
    t1, t2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    cols = "card_num string, account_num string, _captured boolean"
    first = spark.createDataFrame([(None, "A1", True), (None, "A2", True), (None, "A3", False), ("C1", "A1", True)], cols)
    latest, _ = scd2.split_source(scd2.merge_source_frame(spec, scd2.empty_history(spark, spec), first, t1))
    second = spark.createDataFrame([(None, "A1", True)], cols)
    latest, retired = scd2.split_source(scd2.merge_source_frame(spec, latest, second, t2))
    got = sorted((r.card_num or "", r.account_num, r.deleted_flg) for r in latest.collect())
    assert got == [("", "A1", "n"), ("", "A1", "n"), ("", "A2", "n"), ("C1", "A1", "y")] and retired.count() == 0
    with __import__("pytest").raises(Exception, match="duplicate staged card_num"):
        scd2.merge_source_frame(spec, latest, spark.createDataFrame([("C1", "A1", True), ("C1", "A2", True)], cols), t2).collect()
