"""Joins with spread hot keys against plain left joins."""

import collections

from pyspark.sql import functions as F

from conftest import SF001
from ledgerwatch.operators import rules
from ledgerwatch.operators.skew import SHARE, hot_keys, spread_left_join
from ledgerwatch.sources import testtables as tt
from test_rules import BASE, REPORT, frames, j1, tx


def _sides(spark, n=6000):
    """A third of the rows have one key, a sixth have none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 != 1, F.concat(F.lit("k"), F.col("id") % 997))
    left = spark.range(n).select("id", key.alias("k"))
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k5", 3), ("k7", 4), (None, 5), ("unseen", 6)], "key string, v int")
    return left, right


def _bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_hot_keys_are_found_and_bounded(spark):
    left, _ = _sides(spark)
    got = {r._hot: r._parts for r in hot_keys(left, "k", least_rows=50).collect()}
    assert set(got) == {"hot"} and 2000 // 50 <= got["hot"] <= SHARE
    assert hot_keys(left, "k").collect() == []  # few rows are never split
    assert hot_keys(left.where("id < 0"), "k", 1).collect() == []
    assert hot_keys(left.withColumn("k", F.lit(None).cast("string")), "k", 1).collect() == []


def test_spread_join_equals_the_plain_join(spark):
    left, right = _sides(spark)
    plain = _bag(left.join(right, left["k"] == right["key"], "left").select("id", "k", "v"))
    for least in (1, 50, 10**6):
        got = spread_left_join(left, right, "k", "key", hot_keys(left, "k", least))
        assert got.columns == ["id", "k", "v"] and _bag(got) == plain
    none = spread_left_join(left, right.where("v < 0"), "k", "key", hot_keys(left, "k", 50))
    assert _bag(none) == _bag(left.select("id", "k", F.lit(None).cast("int")))


def test_rows_of_a_hot_key_and_without_a_key_lie_in_many_tasks(spark):
    left, right = _sides(spark)
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = spread_left_join(left, right, "k", "key", hot_keys(left, "k", 50))
        tasks = out.groupBy("k", F.spark_partition_id().alias("p")).agg(F.count_distinct("id").alias("n"))
        per = collections.defaultdict(dict)
        for r in tasks.collect():
            per[r.k][r.p] = r.n
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    for key, rows in (("hot", 2000), (None, 1000)):
        assert sum(per[key].values()) == rows and max(per[key].values()) < rows / 3, per[key]


def test_enriched_against_brute_force_with_a_hot_terminal_and_card(spark, monkeypatch):
    monkeypatch.setattr(rules, "hot_keys", lambda df, key: hot_keys(df, key, 2))
    t = dict(BASE)
    t["transactions"] = [tx(i, i * 60, ["C1", "C1", "C2", None, "C9"][i % 5], ["T5", "T5", "T1", None][i % 4]) for i in range(60)]
    got = collections.Counter((r.trans_id, r.terminal_city, r.valid_to, r.passport, r.fio, r.phone, r.entry_dt)
                              for r in rules.enriched(frames(spark, t)).collect())
    ids = {x[1]: x[0] for x in t["transactions"]}
    exp = collections.Counter((ids[e["date"]], e["city"], e["valid_to"], e["passport"], e["fio"], e["phone"], e["entry"]) for e in j1(t))
    assert got == exp


def test_no_raw_facts_are_dealt_by_terminal(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inp = tt.rule_inputs(spark, SF001)
        one, two, whole = [df._jdf.queryExecution().executedPlan().toString().split("\n")
                           for df in (rules.rule1(inp, REPORT), rules.rule2(inp, REPORT), rules.enriched(inp))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    for plan in (one, two):
        at = next(k for k, line in enumerate(plan) if "hashpartitioning(terminal#" in line)
        assert any("HashAggregate" in line and "fio" in line for line in plan[at + 1:at + 5]), plan[at:at + 6]
    for key in ("terminal", "card_num"):
        dealt = [line for line in whole if f"hashpartitioning({key}#" in line]
        assert any("_l_part#" in line for line in dealt), dealt
    assert not any("hashpartitioning(terminal#" in line and "_l_part#" not in line for line in whole)
