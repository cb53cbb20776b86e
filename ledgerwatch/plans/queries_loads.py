"""Fact loads, watermarks and source connectors as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerwatch.functions import lit_ts
from ledgerwatch.operators import capture, facts
from ledgerwatch.plans.queries import query
from ledgerwatch.schemas import (PATTERN_BLACKLIST, PATTERN_TRANSACTIONS, RAW_BLACKLIST_COLUMNS,
                                 RAW_TRANSACTION_COLUMNS)
from ledgerwatch.session import scratch_dir
from ledgerwatch.sources import files, tables
from ledgerwatch.sources import testtables as tt

TX_CUT = "2024-01-15 00:00:00"      # existing fact holds rows before this
TX_OVERLAP = "2024-01-10 00:00:00"  # the new drop starts here (overlaps)
BL_CUT = "2024-01-20 00:00:00"

FACT_COLUMNS = ("trans_id", "trans_date", "card_num", "oper_type", "amt", "oper_result", "terminal")


def _raw_tx(spark, sf_dir):
    return tt.raw_transactions(spark, sf_dir)


@query("stage_transactions")
def q_stage_transactions(spark, sf_dir):
    raw = _raw_tx(spark, sf_dir).select(*RAW_TRANSACTION_COLUMNS)
    return capture.stage_transactions(raw, TX_CUT)


@query("stage_blacklist")
def q_stage_blacklist(spark, sf_dir):
    raw = tt.raw_blacklist(spark, sf_dir).select(*RAW_BLACKLIST_COLUMNS)
    return capture.stage_blacklist(raw, BL_CUT)


def _wm_after_existing(spark, sf_dir):
    tx = tt.transactions(spark, sf_dir)
    bl = tt.blacklist(spark, sf_dir)
    existing_tx = tx.filter(F.col("trans_date") < lit_ts(TX_CUT))
    existing_bl = bl.filter(F.col("entry_dt") < lit_ts(BL_CUT))
    wm = capture.seed_watermarks(spark)
    wm = capture.advance_watermark(wm, "fact_transactions", capture.max_of(existing_tx, "trans_date"))
    wm = capture.advance_watermark(wm, "fact_blacklist", capture.max_of(existing_bl, "entry_dt"))
    return wm, existing_tx, existing_bl


@query("cap_watermark_strict")
def q_cap_watermark_strict(spark, sf_dir):
    """P1 with the watermark looked up from the watermark table (scalar subquery)."""
    wm, _, _ = _wm_after_existing(spark, sf_dir)
    tx = tt.transactions(spark, sf_dir)
    return capture.capture_strict(tx, "trans_date", capture.watermark_of(wm, "fact_transactions"))


def _tx_batch(spark, sf_dir):
    raw = _raw_tx(spark, sf_dir)
    return raw.filter(F.col("transaction_date") >= TX_OVERLAP).select(*RAW_TRANSACTION_COLUMNS)


@query("fact_append_transactions")
def q_fact_append_transactions(spark, sf_dir):
    wm, existing, _ = _wm_after_existing(spark, sf_dir)
    staged = capture.stage_transactions(_tx_batch(spark, sf_dir),
                                        capture.watermark_of(wm, "fact_transactions"))
    return facts.append(existing.select(*FACT_COLUMNS), staged)


@query("fact_append_blacklist")
def q_fact_append_blacklist(spark, sf_dir):
    wm, _, existing = _wm_after_existing(spark, sf_dir)
    raw = tt.raw_blacklist(spark, sf_dir).select(*RAW_BLACKLIST_COLUMNS)
    staged = capture.stage_blacklist(raw, capture.watermark_of(wm, "fact_blacklist"))
    return facts.append(existing, staged)


@query("wm_advance_fact")
def q_wm_advance_fact(spark, sf_dir):
    """K5 for facts: transactions advance to the batch max; the blacklist
    batch holds only old rows, so its staging is empty and the guard keeps
    the previous watermark."""
    wm, existing_tx, existing_bl = _wm_after_existing(spark, sf_dir)
    staged_tx = capture.stage_transactions(_tx_batch(spark, sf_dir),
                                           capture.watermark_of(wm, "fact_transactions"))
    old_bl = tt.raw_blacklist(spark, sf_dir).filter(F.col("date") < BL_CUT).select(*RAW_BLACKLIST_COLUMNS)
    staged_bl = capture.stage_blacklist(old_bl, capture.watermark_of(wm, "fact_blacklist"))
    wm = capture.advance_fact_watermark(wm, "fact_transactions", staged_tx,
                                        facts.append(existing_tx, staged_tx), "trans_date")
    wm = capture.advance_fact_watermark(wm, "fact_blacklist", staged_bl,
                                        facts.append(existing_bl, staged_bl), "entry_dt")
    return wm


@query("fact_multi_batch_replay")
def q_fact_multi_batch_replay(spark, sf_dir):
    """T3: one batch per day file; late rows sit in the next day's file and
    are kept only if above everything loaded before."""
    raw = _raw_tx(spark, sf_dir)
    batch_day = F.when(F.col("_late"), F.date_add("_day", 1)).otherwise(F.col("_day"))
    staged = raw.select(
        F.trim("transaction_id").alias("trans_id"),
        F.to_timestamp_ntz(F.col("transaction_date"), F.lit("yyyy-MM-dd HH:mm:ss")).alias("trans_date"),
        batch_day.alias("batch_day"))
    return facts.replay_batches(staged, "trans_date", "batch_day")


# ----------------------------------------------------------------- sources
def _write_tx_drops(spark, sf_dir, name):
    folder = scratch_dir(spark, name)
    raw = _raw_tx(spark, sf_dir)
    files.write_delimited_drops(raw, folder, "_day", "transactions", RAW_TRANSACTION_COLUMNS)
    return folder


@query("src_delimited_drop")
def q_src_delimited_drop(spark, sf_dir):
    """S3: ';' drops written per day, discovered and read back by position."""
    folder = _write_tx_drops(spark, sf_dir, "drop-delim")
    paths = [r.path for r in files.discover(spark, folder, PATTERN_TRANSACTIONS).select("path").collect()]
    return files.read_delimited(spark, paths, RAW_TRANSACTION_COLUMNS)


@query("src_file_discovery")
def q_src_file_discovery(spark, sf_dir):
    folder = _write_tx_drops(spark, sf_dir, "drop-disc")
    return files.discover(spark, folder, PATTERN_TRANSACTIONS).select("file_name", "file_date", "batch_no")


@query("archive_drop")
def q_archive_drop(spark, sf_dir):
    """K7: after a load, consumed drops move to archive/<name>.backup."""
    folder = _write_tx_drops(spark, sf_dir, "drop-arch")
    found = files.discover(spark, folder, PATTERN_TRANSACTIONS)
    paths = [r.path for r in found.select("path").collect()]
    files.archive(spark, paths, f"{folder}/archive")
    listing = spark.read.format("binaryFile").load(f"{folder}/archive").select("path")
    return listing.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"))


@query("src_workbook_drop")
def q_src_workbook_drop(spark, sf_dir):
    """S2: blacklist drops as one workbook per day, scanned back in parallel."""
    folder = scratch_dir(spark, "drop-xlsx")
    raw = tt.raw_blacklist(spark, sf_dir)
    files.write_workbook_drops(raw, folder, "_day", "passport_blacklist", RAW_BLACKLIST_COLUMNS,
                               date_columns=("date",))
    paths = [r.path for r in files.discover(spark, folder, PATTERN_BLACKLIST).select("path").collect()]
    return files.read_workbooks(spark, paths, RAW_BLACKLIST_COLUMNS)


@query("src_table_scan")
def q_src_table_scan(spark, sf_dir):
    """S4: a source table read with projection and a pushed-down predicate."""
    return tables.read_table(spark, "parquet", f"{sf_dir.rstrip('/')}/customer.parquet",
                             columns=["c_custkey", "c_name", "c_mktsegment"],
                             predicate="c_acctbal > 0")

