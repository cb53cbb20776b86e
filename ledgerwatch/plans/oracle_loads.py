"""DuckDB oracle SQL for the fact loads, watermarks and sources."""

from __future__ import annotations

from ledgerwatch.sources.testtables import sql_with

TX_CUT = "2024-01-15 00:00:00"
TX_OVERLAP = "2024-01-10 00:00:00"
BL_CUT = "2024-01-20 00:00:00"

STAGE_TX = """
SELECT nullif(trim(transaction_id), '') AS trans_id,
       strptime(trim(transaction_date), '%Y-%m-%d %H:%M:%S') AS trans_date,
       nullif(trim(card_num), '') AS card_num, nullif(trim(oper_type), '') AS oper_type,
       CAST(replace(trim(amount), ',', '.') AS DECIMAL(38,10)) AS amt,
       nullif(trim(oper_result), '') AS oper_result, nullif(trim(terminal), '') AS terminal
FROM {src}"""

RAW_BL = ("SELECT strftime(entry_dt, '%Y-%m-%d %H:%M:%S') AS date, passport_num || ' ' AS passport, "
          "CAST(entry_dt AS DATE) AS _day FROM bl")
STAGE_BL = """
SELECT nullif(trim(passport), '') AS passport_num,
       CAST(CAST(substr(trim(date), 1, 10) AS DATE) AS TIMESTAMP) AS entry_dt
FROM {src}"""

FACT_COLS = "trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal"
WM_TX = f"(SELECT max(trans_date) FROM tx WHERE trans_date < TIMESTAMP '{TX_CUT}')"
WM_BL = f"(SELECT max(entry_dt) FROM bl WHERE entry_dt < TIMESTAMP '{BL_CUT}')"
EPOCH = "TIMESTAMP '1900-01-01 00:00:00'"

LOAD_SQL = {
    "stage_transactions": sql_with("raw_tx", extra={"stg": STAGE_TX.format(src="raw_tx")})
    + f"SELECT * FROM stg WHERE trans_date > TIMESTAMP '{TX_CUT}'",
    "stage_blacklist": sql_with("bl", extra={"raw_bl": RAW_BL, "stg": STAGE_BL.format(src="raw_bl")})
    + f"SELECT * FROM stg WHERE entry_dt > TIMESTAMP '{BL_CUT}'",
    "cap_watermark_strict": sql_with("tx") + f"SELECT * FROM tx WHERE trans_date > {WM_TX}",
    "fact_append_transactions": sql_with("tx", "raw_tx", extra={
        "stg": STAGE_TX.format(src=f"(SELECT * FROM raw_tx WHERE transaction_date >= '{TX_OVERLAP}')")})
    + f"SELECT {FACT_COLS} FROM tx WHERE trans_date < TIMESTAMP '{TX_CUT}'\nUNION ALL\n"
      f"SELECT {FACT_COLS} FROM stg WHERE trans_date > {WM_TX}",
    "fact_append_blacklist": sql_with("bl", extra={"raw_bl": RAW_BL, "stg": STAGE_BL.format(src="raw_bl")})
    + f"SELECT passport_num, entry_dt FROM bl WHERE entry_dt < TIMESTAMP '{BL_CUT}'\nUNION ALL\n"
      f"SELECT passport_num, entry_dt FROM stg WHERE entry_dt > {WM_BL}",
    "wm_advance_fact": sql_with("tx", "raw_tx", "bl", extra={
        "stg": STAGE_TX.format(src=f"(SELECT * FROM raw_tx WHERE transaction_date >= '{TX_OVERLAP}')"),
        "new_tx": f"SELECT max(trans_date) AS m FROM stg WHERE trans_date > {WM_TX}"})
    + f"""SELECT 'dwh' AS table_db, 'fact_transactions' AS table_name,
       coalesce((SELECT m FROM new_tx), {WM_TX}) AS last_update_dt
UNION ALL SELECT 'dwh', 'fact_blacklist', {WM_BL}
UNION ALL SELECT 'dwh', 'dim_terminals_hist', {EPOCH}
UNION ALL SELECT 'dwh', 'dim_cards_hist', {EPOCH}
UNION ALL SELECT 'dwh', 'dim_accounts_hist', {EPOCH}
UNION ALL SELECT 'dwh', 'dim_clients_hist', {EPOCH}""",
    # A row survives the sequential per-file load iff no earlier file holds a
    # row at or after its time (and it is above the initial epoch watermark).
    "fact_multi_batch_replay": sql_with("raw_tx", extra={
        "b": "SELECT trim(transaction_id) AS trans_id, "
             "strptime(transaction_date, '%Y-%m-%d %H:%M:%S') AS trans_date, "
             "CASE WHEN _late THEN _day + 1 ELSE _day END AS batch_day FROM raw_tx"})
    + f"""SELECT x.batch_day, x.trans_id, x.trans_date FROM b x
WHERE x.trans_date > {EPOCH}
  AND NOT EXISTS (SELECT 1 FROM b y WHERE y.batch_day < x.batch_day AND y.trans_date >= x.trans_date)""",
    "src_delimited_drop": sql_with("raw_tx")
    + "SELECT transaction_id, transaction_date, amount, card_num, oper_type, oper_result, terminal, "
      "'transactions_' || strftime(_day, '%d%m%Y') || '.txt' AS source_file FROM raw_tx",
    "src_file_discovery": sql_with("raw_tx")
    + "SELECT 'transactions_' || strftime(d, '%d%m%Y') || '.txt' AS file_name, d AS file_date, "
      "CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS batch_no FROM (SELECT DISTINCT _day AS d FROM raw_tx) x",
    "archive_drop": sql_with("raw_tx")
    + "SELECT DISTINCT 'transactions_' || strftime(_day, '%d%m%Y') || '.txt.backup' AS file_name FROM raw_tx",
    "src_workbook_drop": sql_with("bl", extra={"raw_bl": RAW_BL})
    + "SELECT date, passport, 'passport_blacklist_' || strftime(_day, '%d%m%Y') || '.xlsx' AS source_file "
      "FROM raw_bl",
    "src_table_scan": "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0",
}
