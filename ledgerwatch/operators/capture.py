"""Watermark capture, staging projections and watermark maintenance.

A watermark is a scalar: either a literal or an uncorrelated scalar
subquery over the watermark table (``DataFrame.scalar()``), so the filter
stays a plain predicate Catalyst can push to the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions import clean_string, epoch_ts, lit_ts, parse_amount, parse_day, parse_ts
from ledgerwatch.schemas import WAREHOUSE_DB, WATERMARK_TABLES, DimSpec

# Source column feeding each staged column (relational sources and file drops).
SOURCE_COLUMNS = {
    "clients": {"client_id": "client_id", "last_name": "last_name", "first_name": "first_name",
                "patronymic": "patronymic", "date_of_birth": "date_of_birth",
                "passport_num": "passport_num", "passport_valid_to": "passport_valid_to",
                "phone": "phone"},
    "accounts": {"account_num": "account", "valid_to": "valid_to", "client": "client"},
    "cards": {"card_num": "card_num", "account_num": "account"},
    "terminals": {"terminal_id": "terminal_id", "terminal_type": "terminal_type",
                  "terminal_city": "terminal_city", "terminal_address": "terminal_address"},
}
FILE_DIMENSIONS = {"terminals"}


def _as_col(wm) -> Column:
    if wm is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(wm, str):
        return lit_ts(wm)
    return wm


# ------------------------------------------------------------ watermark table
def seed_watermarks(spark: SparkSession) -> DataFrame:
    """The initial watermark table: every target at the epoch."""
    rows = [(WAREHOUSE_DB, t, None) for t in WATERMARK_TABLES]
    return (spark.createDataFrame(rows, "table_db string, table_name string, last_update_dt timestamp_ntz")
                 .withColumn("last_update_dt", epoch_ts()))


def watermark_of(wm_table: DataFrame, table_name: str) -> Column:
    """Scalar lookup: coalesce(last_update_dt, epoch) of one row; NULL when
    the row is missing, so nothing is captured strictly above it."""
    return (wm_table.filter((F.col("table_db") == WAREHOUSE_DB) & (F.col("table_name") == table_name))
                    .select(F.coalesce("last_update_dt", epoch_ts()).alias("wm"))
                    .scalar())


def advance_watermark(wm_table: DataFrame, table_name: str, new_value: Column) -> DataFrame:
    """Set one row to ``new_value`` when it is not NULL, else keep it."""
    hit = (F.col("table_db") == WAREHOUSE_DB) & (F.col("table_name") == table_name)
    return wm_table.select(
        "table_db", "table_name",
        F.when(hit, F.coalesce(new_value, F.col("last_update_dt"))).otherwise(F.col("last_update_dt"))
         .alias("last_update_dt"))


def max_of(df: DataFrame, col: str) -> Column:
    return df.agg(F.max(col)).scalar()


def fact_watermark_value(staged: DataFrame, fact_after: DataFrame, date_col: str,
                         compat_null_reset: bool = False) -> Column:
    """New fact watermark. Default: max of the staged batch, kept when the
    batch is empty. ``compat_null_reset`` sets it from the batch but guards on
    the whole fact, so an empty batch resets it to NULL (then read as epoch)."""
    if compat_null_reset:
        return F.when(max_of(fact_after, date_col).isNotNull(), max_of(staged, date_col)) \
                .otherwise(F.lit(None).cast("timestamp_ntz"))
    return max_of(staged, date_col)


def advance_fact_watermark(wm_table: DataFrame, table_name: str, staged: DataFrame,
                           fact_after: DataFrame, date_col: str,
                           compat_null_reset: bool = False) -> DataFrame:
    new = fact_watermark_value(staged, fact_after, date_col, compat_null_reset)
    if compat_null_reset:
        hit = (F.col("table_db") == WAREHOUSE_DB) & (F.col("table_name") == table_name)
        guard = max_of(fact_after, date_col).isNotNull()
        return wm_table.select("table_db", "table_name",
                               F.when(hit & guard, new).otherwise(F.col("last_update_dt"))
                                .alias("last_update_dt"))
    return advance_watermark(wm_table, table_name, new)


# ------------------------------------------------------------------ capture
def capture_strict(df: DataFrame, date_col: str, wm) -> DataFrame:
    """Facts: rows strictly above the watermark (NULL dates and ties dropped)."""
    return df.filter(F.col(date_col) > _as_col(wm))


def capture_or_null(df: DataFrame, date_col: str, wm) -> DataFrame:
    """Dimensions: rows updated after the watermark, or never updated."""
    return df.filter((F.col(date_col) > _as_col(wm)) | F.col(date_col).isNull())


# ------------------------------------------------------------------ staging
def _clean(spec: DimSpec, target: str, source: str) -> Column:
    c = F.col(source)
    return (clean_string(c) if spec.types[target] == "string" else c).alias(target)


def stage_dimension(spec: DimSpec, source: DataFrame, wm, run_ts: str) -> DataFrame:
    """Captured, cleaned rows of one dimension source.

    Relational sources filter on their own update_dt and stage
    update_dt = create_dt when it was never updated, else the run time.
    File sources have no dates: update_dt is the ingest time.
    """
    mapping = SOURCE_COLUMNS[spec.name]
    cols = [_clean(spec, t, s) for t, s in mapping.items()]
    if spec.name in FILE_DIMENSIONS:
        stamped = source.withColumn("update_dt", lit_ts(run_ts))
        return capture_or_null(stamped, "update_dt", wm).select(*cols, "update_dt")
    captured = capture_or_null(source, "update_dt", wm)
    return captured.select(
        *cols, "create_dt",
        F.when(F.col("update_dt").isNull(), F.col("create_dt")).otherwise(lit_ts(run_ts))
         .alias("update_dt"))


def stage_source(spec: DimSpec, source: DataFrame, wm, run_ts: str) -> DataFrame:
    """All rows of one dimension source, cleaned, with ``_captured``: whether the watermark
    lets the row in. One scan gives both the staged rows and the keys now present."""
    cols = [_clean(spec, t, s) for t, s in SOURCE_COLUMNS[spec.name].items()]
    when = lit_ts(run_ts) if spec.name in FILE_DIMENSIONS else F.col("update_dt")
    captured = F.coalesce(when > _as_col(wm), F.lit(False)) | when.isNull()
    return source.select(*cols, captured.alias("_captured"))


def source_keys(spec: DimSpec, source: DataFrame, trim: bool = True) -> DataFrame:
    """All business keys now present in the source (for logical deletes).
    ``trim=False`` reproduces the untrimmed key list of the original loader."""
    col = F.col(SOURCE_COLUMNS[spec.name][spec.key])
    return source.select((clean_string(col) if trim else col).alias(spec.key))


def stage_transactions(raw: DataFrame, wm, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw ';' drop -> typed, trimmed, captured (> watermark) transactions.
    ``keep`` names extra columns carried through unchanged (e.g. a batch id);
    ``wm=None`` skips the capture filter."""
    typed = raw.select(
        clean_string("transaction_id").alias("trans_id"),
        parse_ts(F.trim("transaction_date")).alias("trans_date"),
        clean_string("card_num").alias("card_num"),
        clean_string("oper_type").alias("oper_type"),
        parse_amount("amount").alias("amt"),
        clean_string("oper_result").alias("oper_result"),
        clean_string("terminal").alias("terminal"), *keep)
    return typed if wm is None else capture_strict(typed, "trans_date", wm)


def stage_blacklist(raw: DataFrame, wm, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw blacklist rows -> (passport_num, entry_dt at day grain) above the watermark."""
    typed = raw.select(clean_string("passport").alias("passport_num"),
                       parse_day(F.trim("date")).alias("entry_dt"), *keep)
    return typed if wm is None else capture_strict(typed, "entry_dt", wm)

