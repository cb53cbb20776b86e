"""Drops with awkward names, short rows, date cells, and loads that must not lose or repeat rows."""

import datetime as dt
import io
import os
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import facts
from ledgerwatch.plans import pipeline
from ledgerwatch.plans.pipeline import PipelineConfig, run_pipeline
from ledgerwatch.plans.store import Warehouse
from ledgerwatch.schemas import PATTERN_BLACKLIST, RAW_BLACKLIST_COLUMNS, RAW_TRANSACTION_COLUMNS, TRANSACTIONS_SCHEMA
from ledgerwatch.sources import files
from ledgerwatch.streaming.drops import run_available

HEAD = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def _row(i, day=1):
    return f"t{i};2024-01-{day:02d} 10:00:{i % 60:02d};0.00{i % 9 + 1}5;C1;p;SUCCESS;T1\n"


def _facts(spark, wh):
    return Warehouse(spark, wh).read_append("fact_transactions", TRANSACTIONS_SCHEMA)


def test_awkward_file_names_lose_nothing(spark, tmp_path):
    drop, wh = tmp_path / "drops", "file:" + str(tmp_path / "wh")
    drop.mkdir()
    names = ["transactions_01012024 .txt", "transactions_02012024%.txt", "transactions_03012024+.txt", "transactions_04012024é.txt"]
    for k, name in enumerate(names):
        (drop / name).write_text(HEAD + _row(2 * k, k + 1) + _row(2 * k + 1, k + 1))
    out = run_pipeline(spark, PipelineConfig(warehouse=wh, drop_dir=str(drop)), "2024-02-01 00:00:00")
    assert out["files"] == 4 and out["not_archived"] == []
    assert sorted(r.trans_id for r in _facts(spark, wh).collect()) == [f"t{k}" for k in range(8)]
    assert sorted(os.listdir(drop / "archive")) == sorted(n + ".backup" for n in names)


def test_amounts_keep_their_decimals(spark, tmp_path):
    drop, wh = tmp_path / "drops", "file:" + str(tmp_path / "wh")
    drop.mkdir()
    (drop / "transactions_01012024.txt").write_text(HEAD + "t1;2024-01-01 10:00:00;12,345;C1;p;SUCCESS;T1\nt2;2024-01-01 10:00:01;0.004;C1;p;SUCCESS;T1\n")
    run_pipeline(spark, PipelineConfig(warehouse=wh, drop_dir=str(drop)), "2024-02-01 00:00:00")
    assert {r.trans_id: str(r.amt) for r in _facts(spark, wh).collect()} == {"t1": "12.3450000000", "t2": "0.0040000000"}


def test_a_row_without_a_batch_fails(spark):
    rows = spark.createDataFrame([(None, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 1))], "b int, d timestamp_ntz")
    with pytest.raises(Exception, match="no batch"):
        facts.replay_batches(rows, "d", "b").collect()


def test_drops_are_not_loaded_twice_when_archiving_fails(spark, tmp_path, monkeypatch):
    drop, wh = tmp_path / "drops", "file:" + str(tmp_path / "wh")
    drop.mkdir()
    (drop / "transactions_01012024.txt").write_text(HEAD + _row(1))
    (drop / "terminals_01012024.xlsx").write_bytes(files.write_workbook([["T1", "ATM", "A", "x"]], ["a", "b", "c", "d"]))
    monkeypatch.setattr("ledgerwatch.plans.store.rename", lambda *a: False)
    out = run_pipeline(spark, PipelineConfig(warehouse=wh, drop_dir=str(drop)), "2024-02-01 00:00:00")
    assert out["files"] == 2 and len(out["not_archived"]) == 2
    monkeypatch.undo()
    out = run_pipeline(spark, PipelineConfig(warehouse=wh, drop_dir=str(drop)), "2024-02-02 00:00:00")
    assert (out["files"], out["skipped"], out["not_archived"]) == (0, 2, [])
    assert _facts(spark, wh).count() == 1 and os.listdir(drop) == ["archive"]
    # A later drop of the same name is a new one.
    (drop / "transactions_01012024.txt").write_text(HEAD + _row(1) + _row(2))
    assert run_pipeline(spark, PipelineConfig(warehouse=wh, drop_dir=str(drop)), "2024-02-03 00:00:00")["files"] == 1
    assert sorted(r.trans_id for r in _facts(spark, wh).collect()) == ["t1", "t2"]


def test_null_keys_are_counted_and_new_events_only_reported(spark, tmp_path):
    drop, wh = tmp_path / "drops", "file:" + str(tmp_path / "wh")
    drop.mkdir()
    acc = spark.createDataFrame([("A1", dt.datetime(2023, 1, 1), "P1", dt.datetime(2023, 1, 1), None), (" ", None, None, dt.datetime(2023, 1, 1), None)],
                                "account string, valid_to timestamp_ntz, client string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    cards = spark.createDataFrame([("C1", "A1", dt.datetime(2023, 1, 1), None)],
                                  "card_num string, account string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    cfg = PipelineConfig(warehouse=wh, drop_dir=str(drop), sources={"accounts": acc, "cards": cards}, only_new_since=True)
    for day in (1, 2):
        (drop / f"transactions_0{day}012024.txt").write_text(HEAD + _row(day, day))
        out = run_pipeline(spark, cfg, f"2024-02-0{day} 00:00:00")
        assert out["null_keys"] == {"accounts": 1}
    rep = pipeline.read_report(spark, wh)
    per = {str(r.event_dt): r.n for r in rep.groupBy("event_dt").agg(F.countDistinct("report_dt").alias("n")).collect()}
    assert per == {"2024-01-01 10:00:01": 1, "2024-01-02 10:00:02": 1}


@pytest.mark.parametrize("compat", [False, True])
def test_null_reset_as_the_original(spark, tmp_path, compat):
    """A second file of old rows only captures nothing; the original then starts again at the epoch."""
    drop, wh = tmp_path / "drops", "file:" + str(tmp_path / "wh")
    drop.mkdir()
    for day, rows in ((1, _row(1, 5)), (2, _row(2, 3)), (3, _row(3, 4))):
        (drop / f"transactions_0{day}012024.txt").write_text(HEAD + rows)
    run_pipeline(spark, PipelineConfig(warehouse=wh, drop_dir=str(drop), compat_null_reset=compat), "2024-02-01 00:00:00")
    assert sorted(r.trans_id for r in _facts(spark, wh).collect()) == (["t1", "t3"] if compat else ["t1"])


def test_two_streams_load_both_drops(spark, tmp_path):
    wh = "file:" + str(tmp_path / "wh")
    for k in (1, 2):
        drop = tmp_path / f"d{k}"
        drop.mkdir()
        (drop / f"transactions_0{k}012024.txt").write_text(HEAD + _row(k, k))
        run_available(spark, str(drop), wh, "file:" + str(tmp_path / f"c{k}"))
        time.sleep(0.1)
    assert sorted(r.trans_id for r in _facts(spark, wh).collect()) == ["t1", "t2"]


@pytest.mark.parametrize("bad", ["t1;2024-01-01 10:00:00;1;C1;p;SUCCESS\n", "t1;2024-01-01 10:00:00;1;C1;p;SUCCESS;T1;more\n"])
def test_wrong_field_counts_fail_whatever_is_read(spark, tmp_path, bad):
    path = str(tmp_path / "transactions_01012024.txt")
    with open(path, "w") as f:
        f.write(HEAD + _row(1) + "\n" + bad)
    df = files.read_delimited(spark, [path], RAW_TRANSACTION_COLUMNS)
    for ask in (lambda: df.collect(), lambda: df.select("transaction_id").collect(), lambda: df.select("source_file", "amount").collect()):
        with pytest.raises(Exception, match="exactly 7 fields"):
            ask()


def test_fields_are_literal(spark, tmp_path):
    path = str(tmp_path / "transactions_01012024.txt")
    with open(path, "w") as f:
        f.write(HEAD + '"t1; 2024 ;;\\;"x";y; z \n\n')
    r = files.read_delimited(spark, [path], RAW_TRANSACTION_COLUMNS).first()
    assert tuple(r) == ('"t1', " 2024 ", None, "\\", '"x"', "y", " z ", "transactions_01012024.txt")


def _book(sheet, more=()):
    buf = io.BytesIO()
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet xmlns="{ns}"><sheetData>{sheet}</sheetData></worksheet>')
        z.writestr("xl/worksheets/sheet10.xml", f'<worksheet xmlns="{ns}"><sheetData><row><c><v>other</v></c></row></sheetData></worksheet>')
        for name, text in more:
            z.writestr(name, text.replace("NS", ns))
    return buf.getvalue()


def test_cells_dates_and_sheet_order():
    cells = '<row><c s="1"><v>44256</v></c><c s="2"><v>44256.5</v></c><c s="0"><v>44256</v></c><c r="E1" s="3"><v>1</v></c><c t="d"><v>2021-03-01T10:00:00</v></c></row>'
    styles = ('xl/styles.xml', '<styleSheet xmlns="NS"><numFmts><numFmt numFmtId="170" formatCode="dd\\.mm\\.yyyy"/><numFmt numFmtId="171" formatCode="0.0&quot;d&quot;"/></numFmts>'
              '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>')
    want = ["2021-03-01 00:00:00", "2021-03-01 12:00:00", "44256", None, "1", "2021-03-01 10:00:00"]
    assert files.decode_first_sheet(_book(cells, [styles])) == [want]
    rels = 'http://schemas.openxmlformats.org/officeDocument/2006/relationships'
    book = ('xl/workbook.xml', f'<workbook xmlns="NS" xmlns:r="{rels}"><sheets><sheet name="b" r:id="x2"/><sheet name="a" r:id="x1"/></sheets></workbook>')
    links = ('xl/_rels/workbook.xml.rels', '<Relationships><Relationship Id="x1" Target="worksheets/sheet2.xml"/><Relationship Id="x2" Target="worksheets/sheet10.xml"/></Relationships>')
    assert files.decode_first_sheet(_book(cells, [styles, book, links])) == [["other"]]


def test_a_blacklist_of_date_cells_loads_and_days_split(spark, tmp_path):
    drop, wh = tmp_path / "drops", "file:" + str(tmp_path / "wh")
    drop.mkdir()
    raw = spark.range(70).select(F.lit("2024-01-05 00:00:00").alias("date"), F.concat(F.lit("N"), F.col("id").cast("string")).alias("passport"),
                                 F.lit("2024-01-05").cast("date").alias("_day"))
    files.write_workbook_drops(raw, "file:" + str(drop), "_day", "passport_blacklist", RAW_BLACKLIST_COLUMNS, date_columns=("date",), max_rows=40)
    assert len(os.listdir(drop)) >= 3
    run_pipeline(spark, PipelineConfig(warehouse=wh, drop_dir=str(drop)), "2024-02-01 00:00:00")
    from ledgerwatch.schemas import BLACKLIST_SCHEMA
    rows = Warehouse(spark, wh).read_append("fact_blacklist", BLACKLIST_SCHEMA).collect()
    # All books of a day carry one date; the strict watermark keeps the first book's rows, as it does with any two files of a day.
    assert rows and {r.entry_dt for r in rows} == {dt.datetime(2024, 1, 5)}


def test_workbooks_go_to_the_folder_that_a_cluster_names(spark, tmp_path, monkeypatch):
    """On a cluster a shared folder comes as file:/..., with one slash; a bare path is one machine's."""
    raw = spark.range(5).select(F.lit("2024-01-05 00:00:00").alias("date"), F.concat(F.lit("N"), F.col("id").cast("string")).alias("passport"),
                                F.lit("2024-01-05").cast("date").alias("_day"))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://one:7077")
    for scheme in ("file:", "file://"):
        drop = tmp_path / f"drops{len(scheme)}"
        drop.mkdir()
        files.write_workbook_drops(raw, scheme + str(drop), "_day", "passport_blacklist", RAW_BLACKLIST_COLUMNS)
        paths = [r.path for r in files.discover(spark, str(drop), PATTERN_BLACKLIST).select("path").collect()]
        assert sorted(r.passport for r in files.read_workbooks(spark, paths, RAW_BLACKLIST_COLUMNS).collect()) == [f"N{i}" for i in range(5)]
    with pytest.raises(ValueError, match="one machine"):
        files.write_workbook_drops(raw, str(tmp_path), "_day", "passport_blacklist", RAW_BLACKLIST_COLUMNS)
