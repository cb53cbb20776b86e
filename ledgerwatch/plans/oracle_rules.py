"""DuckDB oracle SQL for the fraud rules, written in the literal form:
a five-way left-join chain re-evaluated per rule and an explicit self-join
for rule 3, so agreement with the Spark plan (which never builds pairs)
is a real check."""

from __future__ import annotations

import re

from ledgerwatch.sources.testtables import REPORT_TS, sql_with

FIO = ("coalesce(cl.last_name, '') || ' ' || coalesce(cl.first_name, '') || ' ' "
       "|| coalesce(cl.patronymic, '')")

J1 = f"""
SELECT t.trans_id, t.trans_date, t.card_num, t.terminal, te.terminal_city,
       c.account_num, a.valid_to, cl.client_id, cl.passport_num AS passport,
       {FIO} AS fio, cl.phone, cl.passport_valid_to,
       b.passport_num AS bl_passport, b.entry_dt
FROM tx t
LEFT JOIN term_h te ON t.terminal = te.terminal_id
LEFT JOIN card_h c ON t.card_num = c.card_num
LEFT JOIN acct_h a ON c.account_num = a.account_num
LEFT JOIN cli_h cl ON a.client = cl.client_id
LEFT JOIN bl b ON cl.passport_num = b.passport_num"""

HEAD = sql_with("tx", "term_h", "card_h", "acct_h", "cli_h", "bl", extra={"j1": J1})


def _report(where: str, event_type: int, date: str = "trans_date", src: str = "j1") -> str:
    return (f"SELECT {date} AS event_dt, passport, fio, phone, {event_type} AS event_type, "
            f"TIMESTAMP '{REPORT_TS}' AS report_dt FROM {src} WHERE {where}")


BLOCKED = "(bl_passport IS NOT NULL AND entry_dt IS NOT NULL AND trans_date >= entry_dt)"
EXPIRED = "(passport_valid_to IS NOT NULL AND trans_date >= passport_valid_to)"
INVALID = "(valid_to IS NOT NULL AND trans_date >= valid_to)"

PAIRS = """
SELECT t1.trans_date AS d1, t1.passport AS passport, t1.fio AS fio, t1.phone AS phone,
       t2.trans_date AS d2
FROM j1 t1 JOIN j1 t2
  ON t1.card_num = t2.card_num
 AND t2.trans_date > t1.trans_date
 AND t2.trans_date - t1.trans_date <= INTERVAL 1 HOUR
 AND t1.terminal_city <> t2.terminal_city"""

R3_EARLIER = (f"SELECT d1 AS event_dt, passport, fio, phone, 3 AS event_type, "
              f"TIMESTAMP '{REPORT_TS}' AS report_dt FROM pairs")
R3_LATER = (f"SELECT d2 AS event_dt, passport, fio, phone, 3 AS event_type, "
            f"TIMESTAMP '{REPORT_TS}' AS report_dt FROM pairs")

# The whole report, and the same over the inputs of a first run.
REPORT = (_report(f"{BLOCKED} OR {EXPIRED}", 1) + "\nUNION ALL\n" + _report(INVALID, 2) + "\nUNION ALL\n"
          + R3_EARLIER + "\nUNION ALL\n" + R3_LATER)
COUNTS = "SELECT event_dt, passport, fio, phone, event_type, {n} AS n FROM ({rows}) GROUP BY ALL"


def _first_run(sql: str) -> str:
    """The text over the first run's views."""
    for name in ("tx", "term_h", "card_h", "acct_h", "cli_h", "bl", "j1", "pairs"):
        sql = re.sub(rf"(FROM|JOIN) {name}\b", rf"\1 {name}_0", sql)
    return sql


_VIEWS = ("tx", "term_h", "card_h", "acct_h", "cli_h", "bl")
BOTH_RUNS = sql_with(*_VIEWS, *[f"{v}_0" for v in _VIEWS],
                     extra={"j1": J1, "pairs": PAIRS, "j1_0": _first_run(J1), "pairs_0": _first_run(PAIRS)})

RULE_SQL = {
    "fraud_enriched": HEAD + "SELECT trans_id, trans_date, card_num, terminal, terminal_city, "
                             "account_num, valid_to, client_id, passport, fio, phone, "
                             "passport_valid_to, entry_dt FROM j1",
    "fraud_rule1": HEAD + _report(f"{BLOCKED} OR {EXPIRED}", 1),
    "fraud_rule1_blocked": HEAD + _report(BLOCKED, 1),
    "fraud_rule1_expired": HEAD + _report(EXPIRED, 1),
    "fraud_rule2": HEAD + _report(INVALID, 2),
    "fraud_rule3_earlier": HEAD.rstrip() + f",\npairs AS ({PAIRS})\n" + R3_EARLIER,
    "fraud_rule3_later": HEAD.rstrip() + f",\npairs AS ({PAIRS})\n" + R3_LATER,
    "fraud_rule3": HEAD.rstrip() + f",\npairs AS ({PAIRS})\n" + R3_EARLIER + "\nUNION ALL\n" + R3_LATER,
    "fraud_report": HEAD.rstrip() + f",\npairs AS ({PAIRS})\n" + REPORT,
    # Two runs add up to what one run over everything reports.
    "fraud_report_two_runs": HEAD.rstrip() + f",\npairs AS ({PAIRS})\n" + REPORT,
    "fraud_report_counted": HEAD.rstrip() + f",\npairs AS ({PAIRS})\n" + COUNTS.format(n="count(*)", rows=REPORT),
    "fraud_report_changes": BOTH_RUNS + "SELECT event_dt, passport, fio, phone, event_type, CAST(sum(n) AS BIGINT) AS n FROM ("
                            + COUNTS.format(n="count(*)", rows=REPORT) + "\nUNION ALL\n"
                            + COUNTS.format(n="-count(*)", rows=_first_run(REPORT)) + ") GROUP BY ALL HAVING sum(n) <> 0",
    # Pair counts per (card, second, city) cell over facts x terminal versions.
    "fraud_rule3_pairs": sql_with("tx", "term_h", extra={
        "r": "SELECT t.card_num, t.trans_date, te.terminal_city FROM tx t "
             "LEFT JOIN term_h te ON t.terminal = te.terminal_id WHERE t.card_num IS NOT NULL "
             "AND t.trans_date IS NOT NULL",
        "cells": "SELECT card_num, trans_date, terminal_city, count(*) AS n_rows FROM r "
                 "GROUP BY card_num, trans_date, terminal_city",
        "lat": "SELECT a.card_num, a.trans_date, a.terminal_city, count(*) AS k FROM r a JOIN r b "
               "ON a.card_num = b.card_num AND b.trans_date > a.trans_date "
               "AND b.trans_date - a.trans_date <= INTERVAL 1 HOUR AND a.terminal_city <> b.terminal_city "
               "GROUP BY 1, 2, 3",
        "ear": "SELECT b.card_num, b.trans_date, b.terminal_city, count(*) AS k FROM r a JOIN r b "
               "ON a.card_num = b.card_num AND b.trans_date > a.trans_date "
               "AND b.trans_date - a.trans_date <= INTERVAL 1 HOUR AND a.terminal_city <> b.terminal_city "
               "GROUP BY 1, 2, 3"})
    + """SELECT c.card_num, c.trans_date, c.terminal_city, c.n_rows,
       coalesce(lat.k, 0) AS later_partners, coalesce(ear.k, 0) AS earlier_partners
FROM cells c
LEFT JOIN lat ON c.card_num = lat.card_num AND c.trans_date = lat.trans_date
             AND c.terminal_city = lat.terminal_city
LEFT JOIN ear ON c.card_num = ear.card_num AND c.trans_date = ear.trans_date
             AND c.terminal_city = ear.terminal_city
WHERE lat.k IS NOT NULL OR ear.k IS NOT NULL""",
    "fn_full_name": sql_with("cli_h") + "SELECT client_id, " + FIO + " AS fio FROM cli_h cl",
}
