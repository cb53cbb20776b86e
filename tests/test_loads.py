"""Watermark capture, fact loads, batch replay and file sources."""

import collections
import datetime as dt
from decimal import Decimal
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerwatch.functions import lit_ts
from ledgerwatch.operators import capture, facts
from ledgerwatch.schemas import (PATTERN_BLACKLIST, PATTERN_TERMINALS, PATTERN_TRANSACTIONS,
                                 RAW_BLACKLIST_COLUMNS, RAW_TRANSACTION_COLUMNS)
from ledgerwatch.sources import files


def _d(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


def test_capture_strict_boundaries(spark):
    df = spark.createDataFrame([(1, _d("2024-01-01 00:00:00")), (2, _d("2024-01-01 00:00:01")),
                                (3, None), (4, _d("2023-12-31 23:59:59"))], "id int, d timestamp_ntz")
    got = sorted(r.id for r in capture.capture_strict(df, "d", "2024-01-01 00:00:00").collect())
    assert got == [2]  # equal to the watermark, NULL and older are dropped


def test_capture_or_null(spark):
    df = spark.createDataFrame([(1, _d("2024-01-01 00:00:00")), (2, _d("2024-01-02 00:00:00")), (3, None)],
                               "id int, u timestamp_ntz")
    got = sorted(r.id for r in capture.capture_or_null(df, "u", "2024-01-01 00:00:00").collect())
    assert got == [2, 3]


def test_watermark_lookup_missing_and_null(spark):
    wm = capture.seed_watermarks(spark)
    df = spark.createDataFrame([(1, _d("2024-01-01 00:00:00"))], "id int, d timestamp_ntz")
    # seeded -> epoch -> everything above it
    assert capture.capture_strict(df, "d", capture.watermark_of(wm, "fact_transactions")).count() == 1
    # missing row -> NULL scalar -> nothing captured
    assert capture.capture_strict(df, "d", capture.watermark_of(wm, "no_such_table")).count() == 0
    # NULL stored value reads as epoch
    nulled = wm.withColumn("last_update_dt", F.lit(None).cast("timestamp_ntz"))
    assert capture.capture_strict(df, "d", capture.watermark_of(nulled, "fact_transactions")).count() == 1


def test_fact_watermark_guard_default_and_compat(spark):
    wm = capture.advance_watermark(capture.seed_watermarks(spark), "fact_transactions",
                                   lit_ts("2024-01-05 00:00:00"))
    fact = spark.createDataFrame([(_d("2024-01-05 00:00:00"),)], "trans_date timestamp_ntz")
    empty = spark.createDataFrame([], "trans_date timestamp_ntz")

    def value(w):
        return w.filter("table_name = 'fact_transactions'").first().last_update_dt

    kept = capture.advance_fact_watermark(wm, "fact_transactions", empty, fact, "trans_date")
    assert value(kept) == _d("2024-01-05 00:00:00")
    reset = capture.advance_fact_watermark(wm, "fact_transactions", empty, fact, "trans_date",
                                           compat_null_reset=True)
    assert value(reset) is None


def _sequential(rows, wm0):
    """Plain loop over batches in order."""
    wm = wm0
    kept = []
    for b in sorted({r[0] for r in rows}):
        staged = [r for r in rows if r[0] == b and r[1] is not None and r[1] > wm]
        kept += staged
        if staged:
            wm = max(r[1] for r in staged)
    return collections.Counter(kept)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_closed_form_equals_loop(spark, seed):
    rnd = random.Random(seed)
    base = _d("2024-01-01 00:00:00")
    rows = [(rnd.randint(0, 5), base + dt.timedelta(hours=rnd.randint(0, 150)) if rnd.random() > 0.05 else None)
            for _ in range(200)]
    df = spark.createDataFrame(rows, "b int, d timestamp_ntz")
    got = collections.Counter(tuple(r) for r in facts.replay_batches(df, "d", "b").select("b", "d").collect())
    assert got == _sequential(rows, dt.datetime(1900, 1, 1))


def test_stage_transactions_parsing(spark):
    raw = spark.createDataFrame([(" t1 ", "2024-01-02 03:04:05", "12,5", " C1 ", "pay", "SUCCESS", "T1 "),
                                 ("t2", "2023-01-01 00:00:00", "1.00", "C1", "pay", "SUCCESS", "T1")],
                                ", ".join(f"{c} string" for c in RAW_TRANSACTION_COLUMNS))
    out = capture.stage_transactions(raw, "2024-01-01 00:00:00").collect()
    assert len(out) == 1
    r = out[0]
    assert (r.trans_id, r.card_num, r.terminal, r.amt) == ("t1", "C1", "T1", Decimal("12.5"))


def test_stage_blacklist_day_grain(spark):
    raw = spark.createDataFrame([("2024-01-05 13:00:00", " N1"), ("2024-01-04 23:00:00", "N2")],
                                "date string, passport string")
    out = capture.stage_blacklist(raw, "2024-01-04 12:00:00").collect()
    # same-day later entries are dropped because the date is truncated to the day
    assert [(r.passport_num, r.entry_dt) for r in out] == [("N1", _d("2024-01-05 00:00:00"))]


# -------------------------------------------------------------------- files
def _touch(folder, names):
    for n in names:
        with open(os.path.join(folder, n), "w") as f:
            f.write("h\n")


def test_discovery_patterns_and_order(spark):
    folder = tempfile.mkdtemp(prefix="lw-drop-")
    _touch(folder, ["terminals_01032021.xlsx", "terminals_1.xlsx", "terminals_1x.xlsx",
                    "terminals_02032021.xlsx.backup", "terminals_01042021.xlsx", "terminals_02032021.xlsx",
                    "passport_blacklist_01032021.xlsx", "transactions_01032021.txt", "xterminals_01032021.xlsx"])
    by_date = [r.file_name for r in files.discover(spark, folder, PATTERN_TERMINALS).orderBy("batch_no").collect()]
    # anchored at the start only: '.backup' still matches; '_1.xlsx' needs one more character
    assert "terminals_1.xlsx" not in by_date and "xterminals_01032021.xlsx" not in by_date
    assert "terminals_1x.xlsx" in by_date and "terminals_02032021.xlsx.backup" in by_date
    dated = [n for n in by_date if n[10:18].isdigit()]
    assert dated.index("terminals_02032021.xlsx") < dated.index("terminals_01042021.xlsx")
    by_name = [r.file_name for r in files.discover(spark, folder, PATTERN_TERMINALS, order="name")
               .orderBy("batch_no").collect()]
    assert by_name == sorted(by_name)
    assert [r.file_name for r in files.discover(spark, folder, PATTERN_BLACKLIST).collect()] == \
        ["passport_blacklist_01032021.xlsx"]
    assert files.discover(spark, folder, PATTERN_TRANSACTIONS).count() == 1


def test_delimited_read_rules(spark):
    folder = tempfile.mkdtemp(prefix="lw-csv-")
    p = os.path.join(folder, "transactions_01012024.txt")
    with open(p, "w") as f:
        f.write("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n")
        f.write('1;2024-01-01 00:00:01;1,5;C "1";pay;SUCCESS;T1\n')
        f.write("\n")
        f.write("2;2024-01-01 00:00:02;2.5;C2;pay;SUCCESS;T2\n")
    rows = files.read_delimited(spark, [p], RAW_TRANSACTION_COLUMNS).collect()
    assert len(rows) == 2 and rows[0].card_num == 'C "1"' and rows[0].source_file.endswith(".txt")
    bad = os.path.join(folder, "transactions_02012024.txt")
    with open(bad, "w") as f:
        f.write("h1;h2;h3;h4;h5;h6;h7\n1;2024-01-01 00:00:01;1\n")
    with pytest.raises(Exception):
        files.read_delimited(spark, [bad], RAW_TRANSACTION_COLUMNS).collect()


def test_workbook_round_trip(spark):
    folder = tempfile.mkdtemp(prefix="lw-xlsx-")
    for day, rows in (("01032021", [["2021-03-01 00:00:00", "N1"], ["2021-03-01 00:00:00", " N2 "]]),
                      ("02032021", [["2021-03-02 00:00:00", "N3"]])):
        with open(os.path.join(folder, f"passport_blacklist_{day}.xlsx"), "wb") as f:
            f.write(files.write_workbook(rows, ["date", "passport"]))
    paths = [r.path for r in files.discover(spark, folder, PATTERN_BLACKLIST).collect()]
    df = files.read_workbooks(spark, paths, RAW_BLACKLIST_COLUMNS)
    got = sorted((r.date, r.passport, r.source_file) for r in df.collect())
    assert got == [("2021-03-01 00:00:00", " N2 ", "passport_blacklist_01032021.xlsx"),
                   ("2021-03-01 00:00:00", "N1", "passport_blacklist_01032021.xlsx"),
                   ("2021-03-02 00:00:00", "N3", "passport_blacklist_02032021.xlsx")]
    staged = capture.stage_blacklist(df, "1900-01-01 00:00:00").collect()
    assert sorted(r.passport_num for r in staged) == ["N1", "N2", "N3"]


def test_archive_moves_files(spark):
    folder = tempfile.mkdtemp(prefix="lw-arch-")
    _touch(folder, ["transactions_01012024.txt"])
    moved = files.archive(spark, [f"file:{folder}/transactions_01012024.txt"], f"file:{folder}/archive")
    assert moved and os.path.exists(os.path.join(folder, "archive", "transactions_01012024.txt.backup"))
    assert not os.path.exists(os.path.join(folder, "transactions_01012024.txt"))


def test_load_batch_appends_and_advances(spark):
    fact = spark.createDataFrame([("t1", _d("2024-01-01 10:00:00"))], "trans_id string, trans_date timestamp_ntz")
    batch = spark.createDataFrame([("t0", _d("2024-01-01 09:00:00")), ("t2", _d("2024-01-02 10:00:00"))],
                                  "trans_id string, trans_date timestamp_ntz")
    new_fact, staged, wm = facts.load_batch(fact, batch, "trans_date", "2024-01-01 10:00:00")
    assert sorted(r.trans_id for r in new_fact.collect()) == ["t1", "t2"]
    assert spark.range(1).select(wm.alias("w")).first().w == _d("2024-01-02 10:00:00")
    empty = batch.filter("false")
    _, _, same = facts.load_batch(fact, empty, "trans_date", "2024-01-01 10:00:00")
    assert spark.range(1).select(same.alias("w")).first().w == _d("2024-01-01 10:00:00")
