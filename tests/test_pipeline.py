"""End-to-end daily runs: drops + source tables -> snapshot warehouse."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from ledgerwatch.plans.pipeline import PipelineConfig, read_report, run_pipeline
from ledgerwatch.plans.store import Warehouse
from ledgerwatch.schemas import DIMENSIONS
from ledgerwatch.sources import files

D = dt.datetime


def _drop(folder, name, content):
    with open(os.path.join(folder, name), "wb" if isinstance(content, bytes) else "w") as f:
        f.write(content)


def _tx_file(rows):
    head = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
    return head + "".join(";".join(r) + "\n" for r in rows)


def _sources(spark, patronymic="Ivanovich"):
    acc = spark.createDataFrame([("A1", D(2024, 1, 1, 12), "P1", D(2023, 1, 1), None)],
                                "account string, valid_to timestamp_ntz, client string, "
                                "create_dt timestamp_ntz, update_dt timestamp_ntz")
    cards = spark.createDataFrame([("C1 ", "A1", D(2023, 1, 1), None)],
                                  "card_num string, account string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    cl = spark.createDataFrame([("P1", "Ivanov", "Ivan", patronymic, D(1980, 1, 1), "N1", D(2024, 1, 1, 18),
                                 "+7900", D(2023, 1, 1), None)],
                               "client_id string, last_name string, first_name string, patronymic string, "
                               "date_of_birth timestamp_ntz, passport_num string, passport_valid_to timestamp_ntz, "
                               "phone string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    return {"accounts": acc, "cards": cards, "clients": cl}


def test_two_daily_runs(spark):
    drop = tempfile.mkdtemp(prefix="lw-pipe-drop-")
    wh_root = "file:" + tempfile.mkdtemp(prefix="lw-pipe-wh-")
    _drop(drop, "terminals_01012024.xlsx",
          files.write_workbook([["T1", "ATM", "Moscow", "Lenina 1"], ["T2", "POS", "Kazan", "Pushkina 2"]],
                               ["terminal_id", "terminal_type", "terminal_city", "terminal_address"]))
    _drop(drop, "passport_blacklist_01012024.xlsx",
          files.write_workbook([["2024-01-01 00:00:00", "N1"]], ["date", "passport"]))
    _drop(drop, "transactions_01012024.txt", _tx_file([
        ("t1", "2024-01-01 10:00:00", "10,5", "C1", "pay", "SUCCESS", "T1"),
        ("t2", "2024-01-01 10:30:00", "20.00", "C1", "pay", "SUCCESS", "T2")]))
    _drop(drop, "transactions_02012024.txt", _tx_file([
        ("t3", "2024-01-02 09:00:00", "5", "C1", "pay", "SUCCESS", "T1"),
        ("t0", "2024-01-01 09:00:00", "5", "C1", "pay", "SUCCESS", "T1")]))  # older than file 1: dropped

    cfg = PipelineConfig(warehouse=wh_root, drop_dir=drop, sources=_sources(spark))
    out1 = run_pipeline(spark, cfg, "2024-01-03 01:17:00")
    assert out1["files"] == 4
    assert sorted(os.listdir(os.path.join(drop, "archive"))) == sorted(
        n + ".backup" for n in ["terminals_01012024.xlsx", "passport_blacklist_01012024.xlsx",
                                "transactions_01012024.txt", "transactions_02012024.txt"])
    wh = Warehouse(spark, wh_root)
    fact = wh.read_append("fact_transactions", __import__("ledgerwatch.schemas", fromlist=["x"]).TRANSACTIONS_SCHEMA)
    assert sorted(r.trans_id for r in fact.collect()) == ["t1", "t2", "t3"]
    assert out1["watermarks"]["fact_transactions"] == "2024-01-02 09:00:00"
    rep1 = read_report(spark, wh_root).collect()
    types1 = sorted(r.event_type for r in rep1)
    # t1..t3 all after blacklist entry and passport expiry -> 3 x rule 1;
    # t1, t2, t3 after account valid_to (12:00 on Jan 1)? t1/t2 before, t3 after -> 1 x rule 2;
    # t1 (Moscow) and t2 (Kazan) within 30 min -> rule 3 earlier + later
    assert types1 == [1, 1, 1, 2, 3, 3]
    assert all(r.fio == "Ivanov Ivan Ivanovich" for r in rep1)

    # day 2: a new drop and a changed client
    _drop(drop, "transactions_03012024.txt", _tx_file([
        ("t4", "2024-01-03 08:00:00", "1", "C1", "pay", "SUCCESS", "T2")]))
    cfg2 = PipelineConfig(warehouse=wh_root, drop_dir=drop, sources=_sources(spark, patronymic=None))
    out2 = run_pipeline(spark, cfg2, "2024-01-04 01:17:00")
    assert out2["files"] == 1
    clients = Warehouse(spark, wh_root).read("dim_clients_latest").collect()
    assert [(r.patronymic, r.deleted_flg) for r in clients] == [(None, "n")]
    spec = DIMENSIONS["clients"]
    arch = Warehouse(spark, wh_root).read_append("dim_clients_archive", spec.history_schema()).collect()
    assert len(arch) == 1 and arch[0].effective_to == D(2024, 1, 4, 1, 17, 2) - dt.timedelta(seconds=1)
    rep = read_report(spark, wh_root)
    # the report re-emits the whole history each run, now with two client versions
    assert rep.filter(F.col("report_dt") == F.lit(out2["report_ts"]).cast("timestamp_ntz")).count() > len(rep1)
    assert rep.count() > len(rep1)


def test_cli_run_and_reset(spark, tmp_path):
    from ledgerwatch.__main__ import main
    drop = tmp_path / "drops"
    drop.mkdir()
    _drop(str(drop), "transactions_01012024.txt", _tx_file([
        ("t1", "2024-01-01 10:00:00", "1", "C1", "pay", "SUCCESS", "T1")]))
    src = tmp_path / "accounts"
    _sources(spark)["accounts"].write.parquet(str(src))
    wh = "file:" + str(tmp_path / "wh")
    main(["run", "--warehouse", wh, "--drop-dir", str(drop), "--run-ts", "2024-01-02 01:17:00",
          "--source", f"accounts=parquet:{src}"])
    w = Warehouse(spark, wh)
    assert w.watermark("fact_transactions") == "2024-01-01 10:00:00"
    assert w.read("dim_accounts_latest").count() == 1
    main(["reset", "--warehouse", wh])
    w = Warehouse(spark, wh)
    assert w.watermark("fact_transactions") is None and w.read("dim_accounts_latest") is None


def test_compact_keeps_rows(spark, tmp_path):
    from ledgerwatch.plans.pipeline import compact_all
    from ledgerwatch.schemas import TRANSACTIONS_SCHEMA
    drop = tmp_path / "drops"
    drop.mkdir()
    wh = "file:" + str(tmp_path / "wh")
    for day, ts in (("01012024", "2024-01-01 10:00:00"), ("02012024", "2024-01-02 10:00:00")):
        _drop(str(drop), f"transactions_{day}.txt",
              _tx_file([(f"t{day}", ts, "1", "C1", "pay", "SUCCESS", "T1")]))
        run_pipeline(spark, PipelineConfig(warehouse=wh, drop_dir=str(drop)), ts[:10] + " 23:00:00")
    before = sorted(tuple(r) for r in Warehouse(spark, wh).read_append("fact_transactions",
                                                                       TRANSACTIONS_SCHEMA).collect())
    assert len(Warehouse(spark, wh).manifest["batches"]["fact_transactions"]) == 2
    out = compact_all(spark, wh, ["fact_transactions"])
    assert out == {"fact_transactions": 2}
    w = Warehouse(spark, wh)
    assert len(w.manifest["batches"]["fact_transactions"]) == 1
    after = sorted(tuple(r) for r in w.read_append("fact_transactions", TRANSACTIONS_SCHEMA).collect())
    assert after == before and len(after) == 2
    assert w.watermark("fact_transactions") == "2024-01-02 10:00:00"


def test_watermarks_and_lost_keys_come_from_the_write(spark, tmp_path, monkeypatch):
    """No written table is read again for its maximum, nor the staged rows for a count."""
    drop = tmp_path / "drops"
    drop.mkdir()
    _drop(str(drop), "transactions_01012024.txt", _tx_file([
        ("t1", "2024-01-01 10:00:00", "1", "C1", "pay", "SUCCESS", "T1"),
        ("t2", "2024-01-01 11:00:00", "1", "C1", "pay", "SUCCESS", "T1")]))
    sources = _sources(spark)
    acc = sources["accounts"]
    sources["accounts"] = acc.unionByName(acc.withColumn("account", F.lit(" ")))
    sources["cards"] = sources["cards"].limit(0)
    for name in ("count", "first"):
        monkeypatch.setattr(type(acc), name, lambda self: 1 / 0)
    wh = "file:" + str(tmp_path / "wh")
    out = [run_pipeline(spark, PipelineConfig(warehouse=wh, drop_dir=str(drop), sources=sources), f"2024-01-0{d} 23:00:00") for d in (1, 2)]
    monkeypatch.undo()
    # The row without a key has no update date, so each run captures it anew and counts its own.
    assert [o["null_keys"] for o in out] == [{"accounts": 1}] * 2
    assert out[1]["watermarks"] == {"dim_accounts_hist": "2024-01-02 23:00:00", "dim_clients_hist": "2024-01-01 23:00:02",
                                    "fact_transactions": "2024-01-01 11:00:00"}
    assert Warehouse(spark, wh).read("dim_accounts_latest").count() == 3
