"""Counted alerts and their changes against the report over everything."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import alerts, rules
from ledgerwatch.plans.pipeline import PipelineConfig, compact_all, read_alerts, read_report, run_pipeline
from ledgerwatch.plans.store import Warehouse
from ledgerwatch.sources import files
from test_drops import HEAD
from test_rules import BASE, REPORT, SCHEMAS, frames, model, tx


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


def stored(spark, df, path):
    df.write.mode("overwrite").parquet(str(path))
    return spark.read.parquet(str(path))


def test_counts_are_the_bag(spark):
    t = dict(BASE)
    t["transactions"] = [tx(i, 300 * i, "C1" if i % 3 else "C2", f"T{i % 5 + 1}") for i in range(40)] + [tx(90, 5, None, "T1"), tx(91, 7, "C9", "T1")]
    counted = alerts.counted(frames(spark, t))
    assert bag(alerts.expanded(counted, REPORT)) == model(t)["report"]
    assert counted.groupBy(*alerts.KEY).count().where("count > 1").isEmpty()


@pytest.mark.parametrize("seed", range(6))
def test_two_runs_add_up(spark, tmp_path, seed):
    """Random facts and dimension rows, some of them late, in two runs."""
    rng = random.Random(seed)
    t = {k: list(v) for k, v in BASE.items()}
    t["terminals"] += [("T1", "ATM", "Perm", "x"), ("T6", "ATM", "Kazan", "y")]
    t["cards"] += [("C2", "A1"), ("C9", "A2")]
    t["accounts"] += [("A2", dt.datetime(2024, 1, 10), "P2"), ("A404", None, "P1")]
    t["clients"] += [("P2", "Petrova", "Petr", None, "N3", dt.datetime(2024, 1, 10, 13), "+73"), ("P404", "New", "", None, "N1", None, None)]
    t["blacklist"] += [("N3", dt.datetime(2024, 1, 1)), ("N1", dt.datetime(2023, 1, 1))]
    t["transactions"] = [tx(i, rng.choice([0, 1, 1800, 3599, 3600, 3601, 7200, 9000, 86_400]) + rng.randrange(3),
                            rng.choice(["C1", "C2", "C3", "C4", "C9", None]), rng.choice(["T1", "T2", "T3", "T4", "T5", "T6", "T9"])) for i in range(30)]
    kinds = ["transactions"] if seed == 0 else list(SCHEMAS)
    part = {k: [bool(k in kinds and rng.random() < 0.4) for _ in rows] for k, rows in t.items()}
    first = {k: [r for r, later in zip(t[k], part[k]) if not later] for k in t}
    then = {k: [r for r, later in zip(t[k], part[k]) if later] for k in t}
    before = stored(spark, alerts.counted(frames(spark, first)), tmp_path / "a")
    gained = alerts.Changes(**{k: v for k, v in frames(spark, then).items() if then[k]})
    added = stored(spark, alerts.changes(frames(spark, t), gained, before, []), tmp_path / "b")
    assert bag(alerts.expanded(before.unionByName(added), REPORT)) == model(t)["report"]
    if seed == 0:  # facts of other cards and hours are left alone
        cards = {r[2] for r in then["transactions"]}
        assert {r.card_num for r in added.select("card_num").collect()} <= cards


def test_nothing_gained_changes_nothing(spark, tmp_path):
    t = {**BASE, "transactions": [tx(1, 0, "C1", "T1"), tx(2, 60, "C1", "T2")]}
    before = stored(spark, alerts.counted(frames(spark, t)), tmp_path / "a")
    assert alerts.changes(frames(spark, t), alerts.Changes(), before, []).isEmpty()
    # a version that alters nothing for the rules is touched, and cancels out
    same = spark.createDataFrame([("T2", "ATM", "Kazan", "moved")], SCHEMAS["terminals"]).limit(0)
    assert alerts.changes(frames(spark, t), alerts.Changes(terminals=same), before, []).isEmpty()


def test_more_withdrawn_than_raised_fails(spark):
    rows = [("C1", dt.datetime(2024, 1, 1), "N", "f", "p", 1, -1)]
    with pytest.raises(Exception, match="more alerts withdrawn than raised for card C1"):
        alerts.expanded(spark.createDataFrame(rows, "card_num string, event_dt timestamp_ntz, passport string, fio string, phone string, event_type int, n long"), REPORT).collect()


def test_a_hot_card_hour_is_stored_in_few_rows(spark):
    t = {**BASE, "transactions": [tx(i, i % 50, "C2", f"T{i % 2 + 1}") for i in range(600)]}
    counted = alerts.counted(frames(spark, t))
    alerts_n = counted.agg(F.sum("n")).first()[0]
    assert counted.count() <= 2 * 50 * 2 and alerts_n > 100_000
    assert alerts.expanded(counted, REPORT).count() == alerts_n


def test_facts_of_untouched_cards_are_dropped_where_they_are_read(spark, tmp_path):
    """Neither shuffled nor, with days as partitions, read."""
    t = {**BASE, "transactions": [tx(i, 1000 * i, f"C{i % 5}", "T1") for i in range(2000)]}
    inp = frames(spark, t)
    inp["transactions"].withColumn("trans_day", F.to_date("trans_date")).write.partitionBy("trans_day").parquet(str(tmp_path / "f"))
    inp["transactions"] = spark.read.parquet(str(tmp_path / "f"))
    before = stored(spark, alerts.counted(inp), tmp_path / "a")
    gained = alerts.Changes(transactions=spark.createDataFrame([tx(5000, 1_000_500, "C1", "T2")], SCHEMAS["transactions"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        at = alerts.touched(inp, gained, [])
        plan = at.facts(inp["transactions"])._jdf.queryExecution().executedPlan().toString()
        whole = alerts.changes(inp, gained, before, [])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert at.hours.count == 3 and at.cards.count == 0 and len(at.days) <= 2
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "hashpartitioning" not in plan
    scan = next(x for x in plan.split("\n") if "trans_day" in x and "PartitionFilters" in x)
    assert "trans_day" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "LeftSemi" in whole and "CartesianProduct" not in whole


@pytest.mark.parametrize("bound, most", [(200_000, 100), (0, 100), (0, 0)])
def test_touched_hours_are_met_by_equal_keys(spark, tmp_path, monkeypatch, bound, most):
    """A card of many touched hours is not compared hour by hour; very many hours go as whole cards."""
    monkeypatch.setattr(alerts, "TOUCHED_BROADCAST", bound)
    monkeypatch.setattr(alerts, "MOST_FACTS", most, raising=False)
    t = {**BASE, "transactions": [tx(i, 700 * i, f"C{i % 3}", f"T{i % 5 + 1}") for i in range(300)] + [tx(900, 5, None, "T1")]}
    later = {900, *range(0, 300, 4)}
    first = {**t, "transactions": [r for i, r in enumerate(t["transactions"]) if i not in later]}
    added = [r for i, r in enumerate(t["transactions"]) if i in later]
    old = stored(spark, alerts.counted(frames(spark, first)), tmp_path / "a")
    inp = frames(spark, t)
    gained = alerts.Changes(transactions=spark.createDataFrame(added, SCHEMAS["transactions"]), cards=inp["cards"].where("card_num = 'C2'"))
    at = alerts.touched(inp, gained, [])
    assert (at.hours.count == 0) == (bound == 0 and most > 0) and at.cards.count
    for df, date in ((at.facts(inp["transactions"]), "trans_date"), (at.rows(old, "event_dt"), "event_dt")):
        assert "abs(" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.where("card_num is null").isEmpty()
    assert bag(alerts.expanded(old.unionByName(alerts.changes(inp, gained, old, [])), REPORT)) == model(t)["report"]


def _row(i, when, card="C1", terminal="T1"):
    return f"t{i};{when};1;{card};pay;SUCCESS;{terminal}\n"


def _sources(spark, day):
    """Accounts, cards and clients; on day 2 the client has another passport and the second card is new."""
    d = dt.datetime
    upd = None if day == 1 else d(2024, 2, day)
    acc = spark.createDataFrame([("A1", d(2024, 1, 2), "P1", d(2023, 1, 1), None), ("A2", None, "P2", d(2023, 1, 1), None)],
                                "account string, valid_to timestamp_ntz, client string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    cards = spark.createDataFrame([("C1", "A1", d(2023, 1, 1), None)] + ([("C2", "A2", d(2023, 1, 1), None)] if day > 1 else []),
                                  "card_num string, account string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    cl = spark.createDataFrame([("P1", "Ivanov", "Ivan", None, None, "N1", None, "+71", d(2023, 1, 1), None),
                                ("P2", "Petrov", "Petr", None, None, "N2" if day == 1 else "N9", None, "+72", d(2023, 1, 1), upd)],
                               "client_id string, last_name string, first_name string, patronymic string, date_of_birth timestamp_ntz, passport_num string, "
                               "passport_valid_to timestamp_ntz, phone string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    return {"accounts": acc, "cards": cards, "clients": cl}


def _drops(drop):
    """Three days: pairs across the runs, a late blacklist entry, a terminal that moves."""
    terminal = lambda city: files.write_workbook([["T1", "ATM", "Moscow", "a"], ["T2", "POS", city, "b"]], ["terminal_id", "terminal_type", "terminal_city", "terminal_address"])
    black = lambda rows: files.write_workbook(rows, ["date", "passport"])
    return {1: {"terminals_01022024.xlsx": terminal("Kazan"), "passport_blacklist_01022024.xlsx": black([["2024-01-05 00:00:00", "N7"]]),
                "transactions_01022024.txt": HEAD + _row(1, "2024-01-10 10:00:00") + _row(2, "2024-01-10 10:30:00", terminal="T2") + _row(3, "2024-01-31 23:50:00", "C2")},
            2: {"passport_blacklist_02022024.xlsx": black([["2024-01-09 00:00:00", "N1"]]),
                "transactions_02022024.txt": HEAD + _row(4, "2024-01-31 23:50:01", "C2", "T2") + _row(5, "2024-02-01 00:20:00", "C2", "T2") + _row(6, "2024-02-01 00:20:00", "C3", "T2")},
            3: {"terminals_03022024.xlsx": terminal("Omsk"), "transactions_03022024.txt": HEAD + _row(7, "2024-02-02 12:00:00")}}


def test_pipeline_runs_add_up_to_the_full_report(spark, tmp_path):
    full_wh, new_wh = ("file:" + str(tmp_path / mode) for mode in ("full", "new"))
    seen = collections.Counter()
    for day in (1, 2, 3):
        for mode, wh in (("full", full_wh), ("new" if day < 3 else "counted", new_wh)):
            drop = tmp_path / f"{mode}-{day}"
            drop.mkdir()
            for name, content in _drops(drop)[day].items():
                (drop / name).write_bytes(content if isinstance(content, bytes) else content.encode())
            cfg = PipelineConfig(warehouse=wh, drop_dir=str(drop), sources=_sources(spark, day) if day < 3 else {}, report=mode)
            out = run_pipeline(spark, cfg, f"2024-02-0{day} 20:00:00")
        last = F.col("report_dt") == F.lit(out["report_ts"]).cast("timestamp_ntz")
        full = bag(read_report(spark, full_wh).where(last))
        assert bag(read_alerts(spark, new_wh, out["report_ts"])) == full
        new = collections.Counter(r[:5] for r in bag(read_report(spark, new_wh).where(last)).elements())
        full = collections.Counter(r[:5] for r in full.elements())
        assert new == (full - seen if day < 3 else collections.Counter())  # what was not there before
        seen = full
        if day == 2:
            compact_all(spark, new_wh, ["fact_transactions"])
            wh = Warehouse(spark, new_wh)
            assert wh.manifest["alerts"]["batches"]["fact_transactions"] == wh.manifest["batches"]["fact_transactions"]
    assert {r[4] for r in seen} == {1, 2, 3}
    with pytest.raises(ValueError, match="not later than the last report"):
        run_pipeline(spark, PipelineConfig(warehouse=new_wh, report="new"), "2024-02-01 20:00:00")


def test_an_earlier_facts_partner_is_reported_when_the_later_one_comes(spark, tmp_path):
    """A fact within the hour of a reported one raises the pair's earlier alert too."""
    drop, wh = tmp_path / "d", "file:" + str(tmp_path / "wh")
    drop.mkdir()
    (drop / "terminals_01012024.xlsx").write_bytes(_drops(drop)[1]["terminals_01022024.xlsx"])
    rows = [_row(1, "2024-01-10 10:00:00") + _row(2, "2024-01-10 10:10:00", terminal="T2"), _row(3, "2024-01-10 10:20:00")]
    n = []
    for day, text in enumerate(rows, 1):
        (drop / f"transactions_0{day}012024.txt").write_text(HEAD + text)
        run_pipeline(spark, PipelineConfig(warehouse=wh, drop_dir=str(drop), only_new_since=True), f"2024-02-0{day} 00:00:00")
        n.append(read_report(spark, wh).where("event_type = 3").count())
    assert n == [2, 4]


def test_unknown_mode(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown report mode"):
        run_pipeline(spark, PipelineConfig(warehouse="file:" + str(tmp_path / "w"), report="all"), "2024-02-01 00:00:00")
