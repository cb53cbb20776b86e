"""Domain views over the driver's generic tables (events, customer, supplier, nation).

Each view exists twice: as a Spark DataFrame builder and as DuckDB SQL text
(used only by the oracle). The two are written independently from the same
column rules so that an oracle match means something.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions import end_ts, lit_ts
from ledgerwatch.schemas import END_TS

# Fixed values of the test mapping: history validity of the given versions,
# report timestamp, and the three SCD2 snapshot run times.
HIST_FROM = "2024-01-01 00:00:00"
OLD_FROM = "2023-01-01 00:00:00"
OLD_TO = "2023-12-31 23:59:59"
REPORT_TS = "2024-02-01 00:00:00"
RUN_TS = ("2024-01-01 01:17:00", "2024-01-02 01:17:00", "2024-01-03 01:17:00")
RUN_DAY = ("2024-01-01", "2024-01-02", "2024-01-03")


_READS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table; one resolved DataFrame per session and path
    (the test files are immutable), so repeated views share one relation."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    df = _READS.get(key)
    if df is None:
        df = spark.read.parquet(path)
        _READS[key] = df
    return df


def _s(prefix: str, col: str):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def _day_plus(day: str, col):
    return F.date_add(F.lit(day).cast("date"), col.cast("int")).cast("timestamp_ntz")


def _to_second(col: str):
    """Truncate a TIMESTAMP_NTZ to whole seconds without any time-zone step."""
    c = F.col(col)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                                F.second(c))


def _versions(df: DataFrame, frm: str = HIST_FROM) -> DataFrame:
    return (df.withColumn("deleted_flg", F.lit("n"))
              .withColumn("effective_from", lit_ts(frm))
              .withColumn("effective_to", end_ts()))


def _old(df: DataFrame, deleted: str = "n") -> DataFrame:
    return (df.withColumn("deleted_flg", F.lit(deleted))
              .withColumn("effective_from", lit_ts(OLD_FROM))
              .withColumn("effective_to", lit_ts(OLD_TO)))


def _amount():
    """The event's value with three more decimals, taken from its id."""
    return (F.col("value").cast("decimal(18,2)")
            + (F.col("event_id") % 1000).cast("decimal(4,0)") * F.lit("0.00001").cast("decimal(6,5)"))


def _terminal_of(spark, sf_dir):
    """An event's terminal: over the whole range of supplier keys."""
    last = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).scalar()
    return F.concat(F.lit("T"), (F.col("event_id") % (last + 1)).cast("string"))


# ---------------------------------------------------------------- rule inputs
def transactions(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        _s("t", "event_id").alias("trans_id"),
        _to_second("ts").alias("trans_date"),
        _s("C", "user_id").alias("card_num"),
        F.col("event_type").alias("oper_type"),
        _amount().cast("decimal(38,10)").alias("amt"),
        F.when(F.col("event_type") == "error", "REJECT").otherwise("SUCCESS").alias("oper_result"),
        _terminal_of(spark, sf_dir).alias("terminal"))


def terminals_hist(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    base = s.join(n, s.s_nationkey == n.n_nationkey).select(
        _s("T", "s_suppkey").alias("terminal_id"),
        F.when(F.col("s_suppkey") % 2 == 0, "ATM").otherwise("POS").alias("terminal_type"),
        F.col("n_name").alias("terminal_city"),
        F.col("s_name").alias("terminal_address"),
        F.col("s_suppkey").alias("_n"))
    cur = _versions(base)
    old = (base.filter(F.col("_n") % 5 == 0)
               .withColumn("terminal_city", F.concat(F.lit("OLD_"), "terminal_city"))
               .withColumn("deleted_flg", F.lit("n"))
               .withColumn("effective_from", lit_ts(OLD_FROM))
               .withColumn("effective_to", lit_ts(OLD_TO)))
    return cur.unionByName(old).drop("_n")


def cards_hist(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 13 != 12)
    n = F.col("c_custkey")
    now = _versions(c.select(_s("C", "c_custkey").alias("card_num"), _s("A", "c_custkey").alias("account_num")))
    # Some cards hung on another account before; some were deleted. Rules join all versions.
    other = F.concat(F.lit("A"), (n + 7).cast("string"))
    return (now.unionByName(_old(c.filter(n % 10 == 4).select(_s("C", "c_custkey").alias("card_num"), other.alias("account_num"))))
               .unionByName(_old(c.filter(n % 23 == 7).select(_s("C", "c_custkey").alias("card_num"), _s("A", "c_custkey").alias("account_num")), "y")))


def accounts_hist(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = F.col("c_custkey")
    now = _versions(c.select(
        _s("A", "c_custkey").alias("account_num"),
        F.when(n % 17 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(_day_plus("2024-01-01", n % 60)).alias("valid_to"),
        _s("P", "c_custkey").alias("client")))
    return now.unionByName(_old(c.filter(n % 9 == 2).select(
        _s("A", "c_custkey").alias("account_num"), lit_ts("2024-01-12 00:00:00").alias("valid_to"),
        _s("P", "c_custkey").alias("client"))))


def clients_hist(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 19 != 18)
    nat = table(spark, sf_dir, "nation")
    n = F.col("c_custkey")
    now = _versions(c.join(nat, c.c_nationkey == nat.n_nationkey).select(
        _s("P", "c_custkey").alias("client_id"),
        F.col("c_name").alias("last_name"),
        F.col("n_name").alias("first_name"),
        F.when(n % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("patronymic"),
        _day_plus("1980-01-01", n % 9000).alias("date_of_birth"),
        _s("N", "c_custkey").alias("passport_num"),
        F.when(n % 6 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(_day_plus("2024-01-05", n % 90)).alias("passport_valid_to"),
        _s("+7", "c_custkey").alias("phone")))
    old = (now.drop("deleted_flg", "effective_from", "effective_to").filter(F.substring("phone", 3, 20).cast("long") % 12 == 5)
              .withColumn("passport_num", F.concat("passport_num", F.lit("X")))
              .withColumn("passport_valid_to", lit_ts("2024-01-20 00:00:00")))
    return now.unionByName(_old(old, "y"))


def blacklist(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = F.col("c_custkey")
    first = c.filter(n % 8 == 3).select(_s("N", "c_custkey").alias("passport_num"),
                                        _day_plus("2024-01-10", n % 20).alias("entry_dt"))
    second = c.filter(n % 16 == 3).select(_s("N", "c_custkey").alias("passport_num"),
                                          _day_plus("2024-01-15", n % 20).alias("entry_dt"))
    return first.unionByName(second)


def rule_inputs(spark, sf_dir) -> dict[str, DataFrame]:
    """The six rule inputs; built once per session and folder (lazy plans
    are immutable, so sharing them is safe)."""
    key = (id(spark), spark.sparkContext.applicationId, "rule_inputs", sf_dir.rstrip("/"))
    if key not in _READS:
        _READS[key] = _rule_inputs(spark, sf_dir)
    return dict(_READS[key])


def _rule_inputs(spark, sf_dir) -> dict[str, DataFrame]:
    return {"transactions": transactions(spark, sf_dir),
            "terminals": terminals_hist(spark, sf_dir),
            "cards": cards_hist(spark, sf_dir),
            "accounts": accounts_hist(spark, sf_dir),
            "clients": clients_hist(spark, sf_dir),
            "blacklist": blacklist(spark, sf_dir)}


# -------------------------------------------------------- inputs at two runs
#: Facts from here on come with the second run, and so do late ones from before.
SECOND_RUN_FROM = "2024-01-20 12:00:00"
_KEYS = {"terminals": "terminal_id", "cards": "card_num", "accounts": "account_num", "clients": "client_id"}


def rule_inputs_at_two_runs(spark, sf_dir) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(the rule inputs at a first run, what a second run adds): facts after a point in time and
    every fiftieth one before it, the versions that replaced older ones, second blacklist entries."""
    inp = rule_inputs(spark, sf_dir)
    late = (F.col("trans_date") >= lit_ts(SECOND_RUN_FROM)) | (F.substring("trans_id", 2, 20).cast("long") % 50 == 0)
    first, then = {"transactions": inp["transactions"].where(~late)}, {"transactions": inp["transactions"].where(late)}
    for name, key in _KEYS.items():
        old = inp[name].where(F.col("effective_from") == lit_ts(OLD_FROM))
        now = inp[name].where(F.col("effective_from") == lit_ts(HIST_FROM))
        first[name] = old.unionByName(now.join(old.select(key), key, "left_anti"))
        then[name] = now.join(old.select(key), key, "left_semi")
    second = F.substring("passport_num", 2, 20).cast("long") % 16 == 3
    entry = _day_plus("2024-01-15", F.substring("passport_num", 2, 20).cast("long") % 20)
    second = second & (F.col("entry_dt") == entry)
    first["blacklist"], then["blacklist"] = inp["blacklist"].where(~second), inp["blacklist"].where(second)
    return first, then


# ------------------------------------------------------------ SCD2 snapshots
def _present(day: int):
    n = F.col("_n")
    return [n % 10 != 9, n % 7 != 3, F.lit(True)][day]


def _tracked(day: int, base):
    n = F.col("_n")
    if day == 0:
        return base
    if day == 1:
        return (F.when(n % 11 == 0, F.lit(None).cast("string"))
                 .when(n % 5 == 0, F.lit("BUILDING")).otherwise(base))
    return F.when(n % 14 == 3, F.lit("RETURNED")).otherwise(base)


def _pad_key(prefix: str):
    """Keys of n % 9 = 4 arrive padded with spaces, exercising the trim."""
    key = _s(prefix, "_n")
    return F.when(F.col("_n") % 9 == 4, F.concat(F.lit(" "), key, F.lit(" "))).otherwise(key)


def _update_dt(day: int):
    n = F.col("_n")
    return F.when(n % 3 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.date_sub(F.lit(RUN_DAY[day]).cast("date"), (n % 4).cast("int")).cast("timestamp_ntz"))


def source_snapshot(spark, sf_dir, entity: str, day: int) -> DataFrame:
    """The source system as seen on snapshot `day` (0, 1, 2) for one entity.

    clients/accounts/cards have the relational source layout (with create_dt
    and update_dt); terminals have the raw file layout.
    """
    if entity == "terminals":
        s = table(spark, sf_dir, "supplier")
        nat = table(spark, sf_dir, "nation")
        b = s.join(nat, s.s_nationkey == nat.n_nationkey).withColumn("_n", F.col("s_suppkey"))
        out = b.filter(_present(day)).select(
            _pad_key("T").alias("terminal_id"),
            F.when(F.col("_n") % 2 == 0, "ATM").otherwise("POS").alias("terminal_type"),
            _tracked(day, F.col("n_name")).alias("terminal_city"),
            F.concat(F.col("s_name"), F.lit("  ")).alias("terminal_address"))
        return out
    c = table(spark, sf_dir, "customer").withColumn("_n", F.col("c_custkey"))
    n = F.col("_n")
    common = [_day_plus("2023-06-01", n % 100).alias("create_dt"), _update_dt(day).alias("update_dt")]
    if entity == "cards":
        return c.filter(_present(day)).select(
            _pad_key("C").alias("card_num"), _tracked(day, _s("A", "_n")).alias("account"), *common)
    if entity == "accounts":
        return c.filter(_present(day)).select(
            _pad_key("A").alias("account"),
            F.when(n % 17 == 0, F.lit(None).cast("timestamp_ntz"))
             .otherwise(_day_plus("2024-01-01", n % 60)).alias("valid_to"),
            _tracked(day, _s("P", "_n")).alias("client"), *common)
    if entity == "clients":
        nat = table(spark, sf_dir, "nation")
        j = c.join(nat, c.c_nationkey == nat.n_nationkey)
        return j.filter(_present(day)).select(
            _pad_key("P").alias("client_id"),
            F.concat(F.lit(" "), F.col("c_name")).alias("last_name"),
            F.col("n_name").alias("first_name"),
            _tracked(day, F.col("c_mktsegment")).alias("patronymic"),
            _day_plus("1980-01-01", n % 9000).alias("date_of_birth"),
            _s("N", "_n").alias("passport_num"),
            F.when(n % 6 == 0, F.lit(None).cast("timestamp_ntz"))
             .otherwise(_day_plus("2024-01-05", n % 90)).alias("passport_valid_to"),
            F.when(n % 23 == 7, F.lit("  ")).otherwise(_s("+7", "_n")).alias("phone"),
            *common)
    raise ValueError(entity)


# =============================================================== DuckDB text
# The oracle's copies of the same views. CTE names avoid the driver's tables.
SQL_VIEWS = {
    "tx": """
SELECT 't' || event_id AS trans_id, date_trunc('second', ts) AS trans_date,
       'C' || user_id AS card_num, event_type AS oper_type,
       CAST(CAST(value AS DECIMAL(18,2)) + CAST(event_id % 1000 AS DECIMAL(4,0)) * CAST('0.00001' AS DECIMAL(6,5)) AS DECIMAL(38,10)) AS amt,
       CASE WHEN event_type = 'error' THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
       'T' || (event_id % (SELECT max(s_suppkey) + 1 FROM supplier)) AS terminal
FROM events""",
    "term_h": f"""
SELECT 'T' || s_suppkey AS terminal_id,
       CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
       n_name AS terminal_city, s_name AS terminal_address, 'n' AS deleted_flg,
       TIMESTAMP '{HIST_FROM}' AS effective_from, TIMESTAMP '{END_TS}' AS effective_to
FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL
SELECT 'T' || s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END,
       'OLD_' || n_name, s_name, 'n', TIMESTAMP '{OLD_FROM}', TIMESTAMP '{OLD_TO}'
FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE s_suppkey % 5 = 0""",
    "card_h": f"""
SELECT 'C' || c_custkey AS card_num, 'A' || c_custkey AS account_num, 'n' AS deleted_flg,
       TIMESTAMP '{HIST_FROM}' AS effective_from, TIMESTAMP '{END_TS}' AS effective_to
FROM customer WHERE c_custkey % 13 <> 12
UNION ALL
SELECT 'C' || c_custkey, 'A' || (c_custkey + 7), 'n', TIMESTAMP '{OLD_FROM}', TIMESTAMP '{OLD_TO}'
FROM customer WHERE c_custkey % 13 <> 12 AND c_custkey % 10 = 4
UNION ALL
SELECT 'C' || c_custkey, 'A' || c_custkey, 'y', TIMESTAMP '{OLD_FROM}', TIMESTAMP '{OLD_TO}'
FROM customer WHERE c_custkey % 13 <> 12 AND c_custkey % 23 = 7""",
    "acct_h": f"""
SELECT 'A' || c_custkey AS account_num,
       CASE WHEN c_custkey % 17 = 0 THEN NULL
            ELSE CAST(DATE '2024-01-01' + CAST(c_custkey % 60 AS INTEGER) AS TIMESTAMP) END AS valid_to,
       'P' || c_custkey AS client, 'n' AS deleted_flg,
       TIMESTAMP '{HIST_FROM}' AS effective_from, TIMESTAMP '{END_TS}' AS effective_to
FROM customer
UNION ALL
SELECT 'A' || c_custkey, TIMESTAMP '2024-01-12 00:00:00', 'P' || c_custkey, 'n', TIMESTAMP '{OLD_FROM}', TIMESTAMP '{OLD_TO}'
FROM customer WHERE c_custkey % 9 = 2""",
    "cli_h": f"""
SELECT 'P' || c_custkey AS client_id, c_name AS last_name, n_name AS first_name,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS patronymic,
       CAST(DATE '1980-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS TIMESTAMP) AS date_of_birth,
       'N' || c_custkey AS passport_num,
       CASE WHEN c_custkey % 6 = 0 THEN NULL
            ELSE CAST(DATE '2024-01-05' + CAST(c_custkey % 90 AS INTEGER) AS TIMESTAMP) END AS passport_valid_to,
       '+7' || c_custkey AS phone, 'n' AS deleted_flg,
       TIMESTAMP '{HIST_FROM}' AS effective_from, TIMESTAMP '{END_TS}' AS effective_to
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 19 <> 18
UNION ALL
SELECT 'P' || c_custkey, c_name, n_name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END,
       CAST(DATE '1980-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS TIMESTAMP), 'N' || c_custkey || 'X',
       TIMESTAMP '2024-01-20 00:00:00', '+7' || c_custkey, 'y', TIMESTAMP '{OLD_FROM}', TIMESTAMP '{OLD_TO}'
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 19 <> 18 AND c_custkey % 12 = 5""",
    "bl": """
SELECT 'N' || c_custkey AS passport_num,
       CAST(DATE '2024-01-10' + CAST(c_custkey % 20 AS INTEGER) AS TIMESTAMP) AS entry_dt
FROM customer WHERE c_custkey % 8 = 3
UNION ALL
SELECT 'N' || c_custkey, CAST(DATE '2024-01-15' + CAST(c_custkey % 20 AS INTEGER) AS TIMESTAMP)
FROM customer WHERE c_custkey % 16 = 3""",
}


# The same inputs as a first of two runs saw them.
SQL_VIEWS |= {
    "tx_0": f"SELECT * FROM tx WHERE trans_date < TIMESTAMP '{SECOND_RUN_FROM}' AND CAST(substr(trans_id, 2) AS BIGINT) % 50 <> 0",
    **{f"{view}_0": f"SELECT * FROM {view} WHERE effective_from = TIMESTAMP '{OLD_FROM}' "
                    f"OR {key} NOT IN (SELECT {key} FROM {view} WHERE effective_from = TIMESTAMP '{OLD_FROM}')"
       for view, key in (("term_h", "terminal_id"), ("card_h", "card_num"), ("acct_h", "account_num"), ("cli_h", "client_id"))},
    "bl_0": "SELECT 'N' || c_custkey AS passport_num, CAST(DATE '2024-01-10' + CAST(c_custkey % 20 AS INTEGER) AS TIMESTAMP) AS entry_dt "
            "FROM customer WHERE c_custkey % 8 = 3",
}


def sql_with(*names: str, extra: dict | None = None) -> str:
    """A WITH clause defining the named views (plus extra name -> sql)."""
    parts = [f"{n} AS ({SQL_VIEWS[n]}\n)" for n in names]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v}\n)")
    return "WITH " + ",\n".join(parts) + "\n"


def _sql_present(day: int) -> str:
    return ["n % 10 <> 9", "n % 7 <> 3", "TRUE"][day]


def _sql_tracked(day: int, base: str) -> str:
    if day == 0:
        return base
    if day == 1:
        return f"CASE WHEN n % 11 = 0 THEN NULL WHEN n % 5 = 0 THEN 'BUILDING' ELSE {base} END"
    return f"CASE WHEN n % 14 = 3 THEN 'RETURNED' ELSE {base} END"


def _sql_key(prefix: str) -> str:
    return f"CASE WHEN n % 9 = 4 THEN ' ' || '{prefix}' || n || ' ' ELSE '{prefix}' || n END"


def sql_source_snapshot(entity: str, day: int) -> str:
    upd = (f"CASE WHEN n % 3 = 0 THEN NULL ELSE CAST(DATE '{RUN_DAY[day]}' - CAST(n % 4 AS INTEGER) "
           f"AS TIMESTAMP) END AS update_dt")
    crt = "CAST(DATE '2023-06-01' + CAST(n % 100 AS INTEGER) AS TIMESTAMP) AS create_dt"
    if entity == "terminals":
        return f"""
SELECT {_sql_key('T')} AS terminal_id,
       CASE WHEN n % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
       {_sql_tracked(day, 'n_name')} AS terminal_city, s_name || '  ' AS terminal_address
FROM (SELECT s_suppkey AS n, * FROM supplier JOIN nation ON s_nationkey = n_nationkey) b
WHERE {_sql_present(day)}"""
    frm = "(SELECT c_custkey AS n, * FROM customer) b"
    if entity == "cards":
        return f"""
SELECT {_sql_key('C')} AS card_num, {_sql_tracked(day, "'A' || n")} AS account, {crt}, {upd}
FROM {frm} WHERE {_sql_present(day)}"""
    if entity == "accounts":
        return f"""
SELECT {_sql_key('A')} AS account,
       CASE WHEN n % 17 = 0 THEN NULL
            ELSE CAST(DATE '2024-01-01' + CAST(n % 60 AS INTEGER) AS TIMESTAMP) END AS valid_to,
       {_sql_tracked(day, "'P' || n")} AS client, {crt}, {upd}
FROM {frm} WHERE {_sql_present(day)}"""
    if entity == "clients":
        return f"""
SELECT {_sql_key('P')} AS client_id, ' ' || c_name AS last_name, n_name AS first_name,
       {_sql_tracked(day, 'c_mktsegment')} AS patronymic,
       CAST(DATE '1980-01-01' + CAST(n % 9000 AS INTEGER) AS TIMESTAMP) AS date_of_birth,
       'N' || n AS passport_num,
       CASE WHEN n % 6 = 0 THEN NULL
            ELSE CAST(DATE '2024-01-05' + CAST(n % 90 AS INTEGER) AS TIMESTAMP) END AS passport_valid_to,
       CASE WHEN n % 23 = 7 THEN '  ' ELSE '+7' || n END AS phone, {crt}, {upd}
FROM (SELECT c_custkey AS n, * FROM customer JOIN nation ON c_nationkey = n_nationkey) b
WHERE {_sql_present(day)}"""
    raise ValueError(entity)


# ------------------------------------------------------------------ raw drops
def raw_transactions(spark, sf_dir) -> DataFrame:
    """Transactions as a ';' drop carries them: all strings, some padded,
    some amounts with a decimal comma. Helper columns: _day (drop file day),
    _late (row arrives in the next day's file)."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    amt = _amount().cast("decimal(23,5)").cast("string")
    return ev.select(
        F.when(eid % 7 == 1, F.concat(F.lit(" t"), eid.cast("string"), F.lit(" ")))
         .otherwise(_s("t", "event_id")).alias("transaction_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        F.when(eid % 3 == 0, F.regexp_replace(amt, r"\.", ",")).otherwise(amt).alias("amount"),
        F.when(eid % 5 == 2, F.concat(_s("C", "user_id"), F.lit("  "))).otherwise(_s("C", "user_id"))
         .alias("card_num"),
        F.col("event_type").alias("oper_type"),
        F.when(F.col("event_type") == "error", "REJECT").otherwise("SUCCESS").alias("oper_result"),
        _terminal_of(spark, sf_dir).alias("terminal"),
        F.to_date("ts").alias("_day"),
        (eid % 50 == 0).alias("_late"))


def raw_blacklist(spark, sf_dir) -> DataFrame:
    b = blacklist(spark, sf_dir)
    return b.select(F.date_format("entry_dt", "yyyy-MM-dd HH:mm:ss").alias("date"),
                    F.concat(F.col("passport_num"), F.lit(" ")).alias("passport"),
                    F.to_date("entry_dt").alias("_day"))


SQL_VIEWS["raw_tx"] = """
SELECT CASE WHEN event_id % 7 = 1 THEN ' t' || event_id || ' ' ELSE 't' || event_id END AS transaction_id,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS transaction_date,
       CASE WHEN event_id % 3 = 0 THEN replace(CAST(CAST(CAST(value AS DECIMAL(18,2)) + CAST(event_id % 1000 AS DECIMAL(4,0)) * CAST('0.00001' AS DECIMAL(6,5)) AS DECIMAL(23,5)) AS VARCHAR), '.', ',')
            ELSE CAST(CAST(CAST(value AS DECIMAL(18,2)) + CAST(event_id % 1000 AS DECIMAL(4,0)) * CAST('0.00001' AS DECIMAL(6,5)) AS DECIMAL(23,5)) AS VARCHAR) END AS amount,
       CASE WHEN event_id % 5 = 2 THEN 'C' || user_id || '  ' ELSE 'C' || user_id END AS card_num,
       event_type AS oper_type,
       CASE WHEN event_type = 'error' THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
       'T' || (event_id % (SELECT max(s_suppkey) + 1 FROM supplier)) AS terminal,
       CAST(ts AS DATE) AS _day, event_id % 50 = 0 AS _late
FROM events"""
