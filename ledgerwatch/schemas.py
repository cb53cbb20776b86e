"""Table shapes, sentinels and the dimension/fact specifications."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's conventions.
# Open-version sentinel, watermark epoch, deleted flags, report event types,
# and the file-drop name patterns (matched at the start of the name only).
END_TS = "9999-01-01 00:00:00"
EPOCH_TS = "1900-01-01 00:00:00"
FLAG_LIVE = "n"
FLAG_DELETED = "y"
EVENT_BLOCKED_OR_EXPIRED_PASSPORT = 1
EVENT_INVALID_CONTRACT = 2
EVENT_TWO_CITIES_ONE_HOUR = 3
PATTERN_TERMINALS = r"terminals_[0-9]+.\.xlsx"
PATTERN_BLACKLIST = r"passport_blacklist_[0-9]+.\.xlsx"
PATTERN_TRANSACTIONS = r"transactions_[0-9]+.\.txt"
DELIMITER = ";"
# ---------------------------------------------------------------------------

TS_FMT = "yyyy-MM-dd HH:mm:ss"
NTZ = T.TimestampNTZType()
STR = T.StringType()
AMOUNT = T.DecimalType(38, 10)


@dataclass(frozen=True)
class DimSpec:
    """One SCD2 dimension: business key and the columns whose change opens a version."""

    name: str
    key: str
    tracked: tuple[str, ...]
    types: dict  # column -> Spark SQL type for business columns

    @property
    def business(self) -> tuple[str, ...]:
        return (self.key,) + self.tracked

    @property
    def history_columns(self) -> tuple[str, ...]:
        return self.business + ("deleted_flg", "effective_from", "effective_to")

    def history_schema(self) -> T.StructType:
        fields = [T.StructField(c, _spark_type(self.types[c])) for c in self.business]
        fields += [T.StructField("deleted_flg", STR), T.StructField("effective_from", NTZ),
                   T.StructField("effective_to", NTZ)]
        return T.StructType(fields)


def _spark_type(name: str) -> T.DataType:
    return {"string": STR, "timestamp_ntz": NTZ}[name]


TERMINALS = DimSpec(
    "terminals", "terminal_id", ("terminal_type", "terminal_city", "terminal_address"),
    {"terminal_id": "string", "terminal_type": "string", "terminal_city": "string",
     "terminal_address": "string"})
CARDS = DimSpec("cards", "card_num", ("account_num",),
                {"card_num": "string", "account_num": "string"})
ACCOUNTS = DimSpec("accounts", "account_num", ("valid_to", "client"),
                   {"account_num": "string", "valid_to": "timestamp_ntz", "client": "string"})
CLIENTS = DimSpec(
    "clients", "client_id",
    ("last_name", "first_name", "patronymic", "date_of_birth", "passport_num",
     "passport_valid_to", "phone"),
    {"client_id": "string", "last_name": "string", "first_name": "string",
     "patronymic": "string", "date_of_birth": "timestamp_ntz", "passport_num": "string",
     "passport_valid_to": "timestamp_ntz", "phone": "string"})

DIMENSIONS = {d.name: d for d in (TERMINALS, CARDS, ACCOUNTS, CLIENTS)}


@dataclass(frozen=True)
class FactSpec:
    name: str
    date_col: str
    columns: tuple[str, ...]


TRANSACTIONS = FactSpec("transactions", "trans_date",
                        ("trans_id", "trans_date", "card_num", "oper_type", "amt",
                         "oper_result", "terminal"))
BLACKLIST = FactSpec("blacklist", "entry_dt", ("passport_num", "entry_dt"))
FACTS = {f.name: f for f in (TRANSACTIONS, BLACKLIST)}

TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("trans_id", STR), T.StructField("trans_date", NTZ),
    T.StructField("card_num", STR), T.StructField("oper_type", STR),
    T.StructField("amt", AMOUNT), T.StructField("oper_result", STR),
    T.StructField("terminal", STR)])
BLACKLIST_SCHEMA = T.StructType([T.StructField("passport_num", STR),
                                 T.StructField("entry_dt", NTZ)])

REPORT_SCHEMA = T.StructType([
    T.StructField("event_dt", NTZ), T.StructField("passport", STR), T.StructField("fio", STR),
    T.StructField("phone", STR), T.StructField("event_type", T.IntegerType()),
    T.StructField("report_dt", NTZ)])

# Counted alerts: n is signed, rows of all runs add up.
ALERTS_SCHEMA = T.StructType([
    T.StructField("card_num", STR), *REPORT_SCHEMA.fields[:5], T.StructField("n", T.LongType()), REPORT_SCHEMA.fields[5]])

# Watermark table: one row per target table.
WATERMARK_SCHEMA = T.StructType([T.StructField("table_db", STR),
                                 T.StructField("table_name", STR),
                                 T.StructField("last_update_dt", NTZ)])
WAREHOUSE_DB = "dwh"
WATERMARK_TABLES = ("fact_transactions", "fact_blacklist", "dim_terminals_hist",
                    "dim_cards_hist", "dim_accounts_hist", "dim_clients_hist")

# Raw drop layouts, bound by position (headers are ignored).
RAW_TRANSACTION_COLUMNS = ("transaction_id", "transaction_date", "amount", "card_num",
                           "oper_type", "oper_result", "terminal")
RAW_BLACKLIST_COLUMNS = ("date", "passport")
RAW_TERMINAL_COLUMNS = ("terminal_id", "terminal_type", "terminal_city", "terminal_address")
