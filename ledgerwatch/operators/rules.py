"""Fraud rules over the fact table and the dimension histories.

Enrichment joins every fact to *all* versions of each dimension on the
business key alone (version dates and the deleted flag are ignored), so a
dimension with k versions multiplies rows by k. That bag semantics is kept.

Plan shape, chosen for scale:
* ``R`` = facts LEFT JOIN terminal versions (city only). Only the enriched frame needs raw facts
  there, and spreads hot terminals and cards (``skew``); rules 1 and 2 send counts of alerts,
  rule 3 and the report counts of facts.
* ``P`` = card -> account -> client -> blacklist chain, dimensions only. It is a
  function of ``card_num`` alone, so the fact side joins it once on one key.
  Left-join associativity makes ``R ⟕ P`` equal to the five-way chain.
* Rule 3 never materialises pairs. Each (card, second, city) cell learns how
  many cells of *other* cities fall in (t, t+1h] and [t-1h, t); a fact row's
  report multiplicity is that count times the card's person fan-out |P|.
  Windows run per (card, hour bucket) over pre-aggregated cells (each cell
  copied into its own and the previous bucket), so a hot card is split by
  time and a hot second collapses to one cell per city.
* The report needs only (time, person), so it runs on cells: the facts are
  aggregated to (card, second, city, n_rows) once, the cells carry the rule-3
  partner counts and join the profile P once, and each (cell, person) row
  explodes into the alerts it raises, repeated by multiplicity in bounded
  chunks. The fact table is scanned once and never joined back.

No side is broadcast by hint: AQE converts a join to broadcast only when the
measured side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and
keeps the shuffle join beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions import epoch_micros, full_name, lit_ts
from ledgerwatch.schemas import (EVENT_BLOCKED_OR_EXPIRED_PASSPORT, EVENT_INVALID_CONTRACT,
                                 EVENT_TWO_CITIES_ONE_HOUR)
from ledgerwatch.operators.skew import hot_keys, spread_left_join

HOUR_US = 3600 * 1_000_000
REPEAT_CHUNK = 4096

# ------------------------------------------------------------------ joins J1
def with_terminal_city(transactions: DataFrame, terminals: DataFrame) -> DataFrame:
    """R: facts x terminal versions (left join on terminal id only)."""
    t = terminals.select(F.col("terminal_id"), F.col("terminal_city"))
    return transactions.join(t, transactions["terminal"] == t["terminal_id"], "left").drop("terminal_id")


def card_profile(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                 blacklist: DataFrame) -> DataFrame:
    """P: per card, every (card, account, client, blacklist entry) version combination."""
    c = cards.select("card_num", "account_num")
    a = accounts.select(F.col("account_num").alias("_acct"), "valid_to", "client")
    cl = clients.select("client_id", "last_name", "first_name", "patronymic", "passport_num",
                        "passport_valid_to", "phone")
    b = blacklist.select(F.col("passport_num").alias("bl_passport"), "entry_dt")
    p = (c.join(a, c["account_num"] == a["_acct"], "left")
          .join(cl, F.col("client") == cl["client_id"], "left")
          .join(b, F.col("passport_num") == b["bl_passport"], "left"))
    return p.select(
        "card_num", "account_num", "valid_to", "client_id",
        F.col("passport_num").alias("passport"),
        full_name("last_name", "first_name", "patronymic").alias("fio"),
        "phone", "passport_valid_to", "bl_passport", "entry_dt")


def _person_of_missing_card() -> list[Column]:
    # A fact with no card match keeps one row of NULL person fields; its
    # name is still the concatenation of three empty parts.
    return [F.coalesce(F.col("fio"), full_name(F.lit(None), F.lit(None), F.lit(None))).alias("fio")]


def enriched(inp: dict) -> DataFrame:
    """J1 as one frame: facts LEFT JOIN every dimension version and blacklist entry.

    Here raw facts have to meet both sides, so the rows of hot terminals and cards are spread."""
    tx = inp["transactions"]
    t = inp["terminals"].select("terminal_id", "terminal_city")
    p = card_profile(inp["cards"], inp["accounts"], inp["clients"], inp["blacklist"]).withColumnRenamed("card_num", "_card")
    r = spread_left_join(tx, t, "terminal", "terminal_id", hot_keys(tx, "terminal"))
    e = spread_left_join(r, p, "card_num", "_card", hot_keys(tx, "card_num"))
    return e.select("trans_id", "trans_date", "card_num", "terminal", "terminal_city",
                    "account_num", "valid_to", "client_id", "passport",
                    *_person_of_missing_card(), "phone", "passport_valid_to", "entry_dt")


# --------------------------------------------------------------- conditions
def blocked(col_date: str = "trans_date") -> Column:
    return (F.col("bl_passport").isNotNull() & F.col("entry_dt").isNotNull()
            & (F.col(col_date) >= F.col("entry_dt")))


def expired(col_date: str = "trans_date") -> Column:
    return F.col("passport_valid_to").isNotNull() & (F.col(col_date) >= F.col("passport_valid_to"))


def contract_invalid(col_date: str = "trans_date") -> Column:
    return F.col("valid_to").isNotNull() & (F.col(col_date) >= F.col("valid_to"))


def _report(df: DataFrame, event_type: int, report_ts: str) -> DataFrame:
    return df.select(F.col("trans_date").alias("event_dt"), "passport", "fio", "phone",
                     F.lit(event_type).cast("int").alias("event_type"),
                     lit_ts(report_ts).alias("report_dt"))


# ------------------------------------------------------------- rules 1 and 2
def _weighted_rule(inp: dict, p_side: Column, cond: Column, event_type: int, report_ts: str) -> DataFrame:
    """Alerts of one fact and one person, times the versions of the fact's terminal (1 when none).

    These rules use the terminal join only for its multiplicity. Facts meet the profile first, and
    those that raise an alert are counted per alert and terminal; the counts alone meet the
    terminals, and are expanded last."""
    p = card_profile(inp["cards"], inp["accounts"], inp["clients"], inp["blacklist"])
    f = inp["transactions"].select("card_num", "trans_date", "terminal")
    raised = (f.join(p.filter(p_side), "card_num", "inner").filter(cond)
               .groupBy("trans_date", "passport", "fio", "phone", "terminal").agg(F.count(F.lit(1)).alias("_n")))
    versions = inp["terminals"].groupBy("terminal_id").agg(F.count(F.lit(1)).alias("_tv"))
    rows = raised.join(versions, raised["terminal"] == versions["terminal_id"], "left")
    rows = rows.withColumn("_m", F.col("_n") * F.coalesce("_tv", F.lit(1)))
    return _report(repeat_rows(rows.select("trans_date", "passport", "fio", "phone", "_m"), "_m"), event_type, report_ts)


def rule1(inp: dict, report_ts: str, which: str = "both") -> DataFrame:
    """Blocked or expired passport. Only facts whose chain reaches a client
    with a usable date can qualify, so the profile is pre-filtered and joined
    inner."""
    cond = {"both": blocked() | expired(), "blocked": blocked(), "expired": expired()}[which]
    p_side = {"both": F.col("entry_dt").isNotNull() | F.col("passport_valid_to").isNotNull(),
              "blocked": F.col("entry_dt").isNotNull(),
              "expired": F.col("passport_valid_to").isNotNull()}[which]
    return _weighted_rule(inp, p_side, cond, EVENT_BLOCKED_OR_EXPIRED_PASSPORT, report_ts)


def rule2(inp: dict, report_ts: str) -> DataFrame:
    """Transaction on or after the account's valid_to."""
    return _weighted_rule(inp, F.col("valid_to").isNotNull(), contract_invalid(),
                          EVENT_INVALID_CONTRACT, report_ts)


# -------------------------------------------------------------------- rule 3
def city_cells(transactions: DataFrame, terminals: DataFrame) -> DataFrame:
    """(card, second, city, n_rows): facts x terminal versions, counted. The
    facts are counted per (card, second, terminal) first (map-side), so only
    counts, and no raw facts, move to meet the terminals."""
    seen = (transactions.filter(F.col("card_num").isNotNull() & F.col("trans_date").isNotNull())
            .groupBy("card_num", "trans_date", "terminal").agg(F.count(F.lit(1)).alias("_n")))
    return (with_terminal_city(seen, terminals).groupBy("card_num", "trans_date", "terminal_city")
            .agg(F.sum("_n").alias("n_rows")))


def city_pair_rows(cells: DataFrame, window_us: int = HOUR_US) -> DataFrame:
    """J2 in count form over ``city_cells``; each cell appears twice:

    * in its own hour bucket h, where the range (t, t + window] lies in
      buckets h and h+1: this row carries ``later_partners``;
    * in bucket h-1, where [t - window, t) lies in buckets h-1 and h: this
      row carries ``earlier_partners``.

    A (card, bucket) window group therefore holds two hours of one card, and
    partners of a different non-NULL city are counted as all minus same-city.
    ``_own`` marks the first kind of row; both kinds carry ``n_rows``.
    """
    cells = (cells.withColumn("_us", epoch_micros("trans_date"))
                  # exact floor division (pmod keeps negative times in 1h buckets)
                  .withColumn("_h", F.expr(f"(_us - pmod(_us, {window_us}L)) div {window_us}L")))
    copies = F.explode(F.array(
        F.struct(F.col("_h").alias("_b"), F.lit(True).alias("_own")),
        F.struct((F.col("_h") - 1).alias("_b"), F.lit(False).alias("_own"))))
    u = cells.select("*", copies.alias("_c")).select("*", "_c._b", "_c._own").drop("_c")
    contrib = F.when(F.col("terminal_city").isNotNull(), F.col("n_rows")).otherwise(F.lit(0))
    w_all = Window.partitionBy("card_num", "_b").orderBy("_us")
    w_city = Window.partitionBy("card_num", "_b", "terminal_city").orderBy("_us")

    def upto(w, bound):
        # A frame that only grows costs one addition per row; a sliding one is summed anew at each row.
        return F.coalesce(F.sum(contrib).over(w.rangeBetween(Window.unboundedPreceding, bound)), F.lit(0))

    def span(w, lo, hi):
        return upto(w, hi) - upto(w, lo - 1)

    later = span(w_all, 1, window_us) - span(w_city, 1, window_us)
    earlier = span(w_all, -window_us, -1) - span(w_city, -window_us, -1)
    city_known = F.col("terminal_city").isNotNull()
    return u.select("card_num", "trans_date", "terminal_city", "n_rows", "_own",
                    F.when(city_known & F.col("_own"), later).otherwise(0).cast("long").alias("later_partners"),
                    F.when(city_known & ~F.col("_own"), earlier).otherwise(0).cast("long")
                     .alias("earlier_partners"))


def city_pair_counts(cells: DataFrame, window_us: int = HOUR_US) -> DataFrame:
    """Per cell: n_rows, later_partners, earlier_partners (one row per cell
    that takes part in a pair)."""
    rows = city_pair_rows(cells, window_us).filter((F.col("later_partners") > 0) | (F.col("earlier_partners") > 0))
    return (rows.groupBy("card_num", "trans_date", "terminal_city")
                .agg(F.max("n_rows").alias("n_rows"), F.sum("later_partners").alias("later_partners"),
                     F.sum("earlier_partners").alias("earlier_partners")))


def repeat_rows(df: DataFrame, times: str, spread: bool = False) -> DataFrame:
    """Each row `times` times (>= 1). Arrays hold at most REPEAT_CHUNK numbers for up to its
    third power of repetitions; ``spread`` deals a row's chunks to many tasks before
    the last step."""
    ch = REPEAT_CHUNK
    out = (df.withColumn("_block", F.explode(F.expr(f"sequence(0L, ({times} - 1) div {ch * ch}L)")))
             .withColumn("_left", F.expr(f"least({ch * ch}L, {times} - _block * {ch * ch}L)"))
             .withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_left - 1) div {ch})"))))
    if spread:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartition(parts, "_block", "_chunk", *df.columns)
    return (out.withColumn("_i", F.explode(F.expr(f"sequence(1L, least({ch}L, _left - _chunk * {ch}))")))
               .drop("_block", "_left", "_chunk", "_i"))


_PAIRED = "later_partners > 0 or earlier_partners > 0"


def report_cells(inp: dict, pairs_only: bool = False) -> DataFrame:
    """Cells with their partner counts; ``pairs_only`` leaves out those without partners."""
    cells = city_pair_rows(city_cells(inp["transactions"], inp["terminals"]))
    return cells.filter(_PAIRED if pairs_only else f"_own or {_PAIRED}")


def with_persons(cells: DataFrame, inp: dict) -> DataFrame:
    """Cells joined to the card profile.

    The report needs only (event time, person), so nothing below the cell
    level is kept: a cell's n_rows facts share time, card and city, and each
    (cell, person row) stands for n_rows enriched rows.
    """
    p = card_profile(inp["cards"], inp["accounts"], inp["clients"], inp["blacklist"])
    # The fan-out is counted where the profile already lies by card for the join below.
    p_n = p.filter(F.col("card_num").isNotNull()).withColumn(
        "person_rows", F.count(F.lit(1)).over(Window.partitionBy("card_num")))
    e = cells.join(p_n, "card_num", "left")
    return (e.withColumn("person_rows", F.coalesce("person_rows", F.lit(1)).cast("long"))
             .withColumn("fio", F.coalesce("fio", full_name(F.lit(None), F.lit(None), F.lit(None)))))


def _rule3_multiplicities(side: str) -> list[Column]:
    rows = F.col("n_rows") * F.col("person_rows")
    parts = []
    if side in ("earlier", "both"):
        parts.append(F.when(F.col("later_partners") > 0, rows * F.col("later_partners")))
    if side in ("later", "both"):
        parts.append(F.when(F.col("earlier_partners") > 0, rows * F.col("earlier_partners")))
    return parts


def rule3(inp: dict, report_ts: str, side: str = "both") -> DataFrame:
    """Card used in two different cities within one hour.

    side='earlier': one row per pair at the earlier event's time;
    side='later': at the later event's time (person fields are the earlier
    event's, which are the same multiset since both share the card);
    'both': union of the two.
    """
    e = with_persons(report_cells(inp, pairs_only=True), inp)
    m = F.explode(F.filter(F.array(*_rule3_multiplicities(side)), lambda x: x.isNotNull()))
    rows = e.select("trans_date", "passport", "fio", "phone", m.alias("_m"))
    return _report(repeat_rows(rows, "_m", spread=True), EVENT_TWO_CITIES_ONE_HOUR, report_ts)


def rule3_pairs(inp: dict) -> DataFrame:
    """J2 pair counts per (card, second, city) cell that takes part in a pair."""
    return city_pair_counts(city_cells(inp["transactions"], inp["terminals"]))


# ------------------------------------------------------------------- report
def alert_rows(e: DataFrame) -> DataFrame:
    """The alerts that each (cell, person) row raises, with their number ``_m``: rules 1 and 2
    once per fact in the cell, rule 3 by its partner multiplicity (as earlier and as later event)."""
    once = F.when(F.col("_own"), F.col("n_rows").cast("long"))
    r3 = _rule3_multiplicities("both")

    def alert(kind, mult):
        return F.struct(F.lit(kind).alias("t"), mult.alias("m"))

    alerts = F.filter(F.array(
        F.when(F.col("_own") & (blocked() | expired()), alert(EVENT_BLOCKED_OR_EXPIRED_PASSPORT, once)),
        F.when(F.col("_own") & contract_invalid(), alert(EVENT_INVALID_CONTRACT, once)),
        F.when(r3[0].isNotNull(), alert(EVENT_TWO_CITIES_ONE_HOUR, r3[0])),
        F.when(r3[1].isNotNull(), alert(EVENT_TWO_CITIES_ONE_HOUR, r3[1]))),
        lambda x: x.isNotNull())
    return (e.select("card_num", F.col("trans_date").alias("event_dt"), "passport", "fio", "phone", F.explode(alerts).alias("_a"))
             .select("card_num", "event_dt", "passport", "fio", "phone",
                     F.col("_a.t").cast("int").alias("event_type"), F.col("_a.m").alias("_m")))


def fraud_report(inp: dict, report_ts: str) -> DataFrame:
    """All three rules in one pass over cells ⟕ card profile, one row per alert.
    No dedupe: the output is the same bag as appending the rules one after another."""
    rows = alert_rows(with_persons(report_cells(inp), inp)).drop("card_num")
    return repeat_rows(rows, "_m", spread=True).drop("_m").withColumn("report_dt", lit_ts(report_ts))
