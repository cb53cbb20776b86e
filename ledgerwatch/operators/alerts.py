"""The report as counted alerts, kept up to date from changes.

The report is a bag: one row per alert, quadratic in a busy card-hour. Here equal alerts are one row
with their number, at most one per (cell, person, rule), so storage is linear in the cells;
``expanded`` gives the bag back.

The counted alerts of a run are stored as signed changes: ``changes`` derives from the rows that
its inputs have gained since the last run which cards, and which hours of cards, can raise
other alerts than before, recomputes those alone, and gives the difference to what is
stored. Adding up all runs' changes gives the report over everything, whatever came late:
* a new fact touches its card in its own hour and the hours beside it, since rule 3 pairs facts at most an hour apart;
* a terminal's new version touches the hours of all its facts and those beside them;
* a new version of a card, account or client, or a new blacklist entry, touches the whole card.
Inputs are histories and append-only facts: they gain rows and lose none.

Facts of untouched cards are dropped where they are read: the touched cards and hours are
broadcast while they are measured to be few (TOUCHED_BROADCAST), and a fact table partitioned by
``trans_day`` is read only in the touched days unless whole cards are touched. Beyond the bound the same
semi-joins run as shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions import epoch_micros, lit_ts
from ledgerwatch.operators import rules
from ledgerwatch.session import scratch_dir

KEY = ("card_num", "event_dt", "passport", "fio", "phone", "event_type")
#: Rows of touched cards or hours, or of keys of one dimension, that are broadcast at most (about 10 MB).
TOUCHED_BROADCAST = 200_000
#: Facts there are per touched hour, at most, for whole cards to be recomputed instead of very many hours.
MOST_FACTS = 4
#: Days that are listed in a partition filter at most.
MOST_DAYS = 1000


def counted(inp: dict, touched: "Touched | None" = None) -> DataFrame:
    """KEY and ``n``: how often each alert occurs; with ``touched``, those of its cards and hours."""
    if touched is not None:
        inp = {**inp, "transactions": touched.facts(inp["transactions"]), **touched.persons(inp)}
    cells = rules.report_cells(inp)
    if touched is not None:
        cells = touched.rows(cells, "trans_date")
    return (rules.alert_rows(rules.with_persons(cells, inp)).groupBy(*KEY).agg(F.sum("_m").alias("n")))


def expanded(stored: DataFrame, report_ts: str) -> DataFrame:
    """The bag of alerts that stored (signed) counts add up to, in the layout of the report."""
    total = stored.groupBy(*KEY).agg(F.sum("n").alias("_m"))
    wrong = F.raise_error(F.concat(F.lit("more alerts withdrawn than raised for card "), F.coalesce("card_num", F.lit("NULL"))))
    total = total.where("_m <> 0").withColumn("_m", F.when(F.col("_m") < 0, wrong.cast("long")).otherwise(F.col("_m")))
    rows = rules.repeat_rows(total.drop("card_num"), "_m", spread=True)
    return rows.select("event_dt", "passport", "fio", "phone", F.col("event_type").cast("int").alias("event_type"),
                       lit_ts(report_ts).alias("report_dt"))


# ------------------------------------------------------------------- changes
@dataclass
class Changes:
    """Rows that each input has gained since the last report; None: none."""
    transactions: DataFrame | None = None
    terminals: DataFrame | None = None
    cards: DataFrame | None = None
    accounts: DataFrame | None = None
    clients: DataFrame | None = None
    blacklist: DataFrame | None = None


def hour_of(date: str) -> Column:
    """The hour's number; floor also for times before the epoch."""
    us = epoch_micros(date)
    return ((us - F.pmod(us, F.lit(rules.HOUR_US))) / rules.HOUR_US).cast("long")


class _Keys:
    """A written table of distinct keys, broadcast while it is small."""

    def __init__(self, df: DataFrame, name: str, scratch: list[str]) -> None:
        path = scratch_dir(df.sparkSession, name)
        scratch.append(path)
        df.write.mode("overwrite").parquet(path)
        self.df = df.sparkSession.read.schema(df.schema).parquet(path)
        self.count = self.df.count()

    def hinted(self) -> DataFrame:
        return F.broadcast(self.df) if self.count <= TOUCHED_BROADCAST else self.df


def _in(df: DataFrame, column: str, keys: _Keys) -> DataFrame:
    k = keys.hinted()
    return df.join(k.withColumnRenamed(k.columns[0], "_key"), df[column] == F.col("_key"), "left_semi")


@dataclass
class Touched:
    """Cards whose alerts may differ: in all hours (``cards``) or in some (``hours``)."""
    cards: _Keys
    hours: _Keys
    near: _Keys  # the hours, and those beside them
    days: list | None
    scratch: list[str] = field(default_factory=list)

    def _rows(self, df: DataFrame, date: str, hours: _Keys) -> DataFrame:
        """Rows of touched cards and of ``hours``, by equal keys and in one pass: a card of many
        touched hours is not compared hour by hour."""
        if not hours.count:
            return _in(df, "card_num", self.cards) if self.cards.count else df.limit(0)
        h = hours.hinted().select(F.col("card_num").alias("_card"), F.col("hour").alias("_hour"), F.lit(True).alias("_some"))
        on = (df["card_num"] == F.col("_card")) & (hour_of(date) == F.col("_hour"))
        if not self.cards.count:
            return df.join(h, on, "left_semi")
        c = self.cards.hinted().select(F.col("card_num").alias("_whole"), F.lit(True).alias("_all"))
        # Both hold a key once, so the joins mark rows and add none.
        return (df.join(c, df["card_num"] == F.col("_whole"), "left").join(h, on, "left").where("_all or _some").select(*df.columns))

    def facts(self, tx: DataFrame) -> DataFrame:
        """Facts that decide the touched alerts: those of touched cards, and of hours an hour around."""
        if not self.cards.count and self.days is not None and "trans_day" in tx.columns:
            tx = tx.where(F.col("trans_day").isin(self.days))
        return self._rows(tx, "trans_date", self.near)

    def rows(self, df: DataFrame, date: str) -> DataFrame:
        """Rows of touched cards and hours."""
        return self._rows(df, date, self.hours)

    def persons(self, inp: dict) -> dict:
        """The dimension rows that the touched cards lead to; all, if the cards are too many to be
        broadcast: looking for the rows would move the dimensions as often as joining them does."""
        def keys(df: DataFrame, column: str, name: str) -> _Keys:
            return _Keys(df.select(column).where(F.col(column).isNotNull()).distinct(), name, self.scratch)

        own = _Keys(self.hours.df.select("card_num").unionByName(self.cards.df.select("card_num")).distinct(), "touched-own", self.scratch)
        if own.count > TOUCHED_BROADCAST:
            return {}
        cards = _in(inp["cards"], "card_num", own)
        accounts = _in(inp["accounts"], "account_num", keys(cards, "account_num", "touched-accounts"))
        clients = _in(inp["clients"], "client_id", keys(accounts, "client", "touched-clients"))
        blacklist = _in(inp["blacklist"], "passport_num", keys(clients, "passport_num", "touched-passports"))
        return {"cards": cards, "accounts": accounts, "clients": clients, "blacklist": blacklist}


def touched(inp: dict, gained: Changes, scratch: list[str]) -> Touched:
    """The cards and hours whose alerts can differ from those before ``gained`` came in (``inp`` holds it already)."""
    spark = inp["transactions"].sparkSession

    def keys(df: DataFrame, column: str, name: str) -> _Keys:
        return _Keys(df.select(column).where(F.col(column).isNotNull()).distinct(), name, scratch)

    whole = [] if gained.cards is None else [gained.cards.select("card_num")]
    clients = [] if gained.clients is None else [gained.clients.select("client_id")]
    if gained.blacklist is not None:
        clients.append(_in(inp["clients"], "passport_num", keys(gained.blacklist, "passport_num", "gained-passports")).select("client_id"))
    accounts = [] if gained.accounts is None else [gained.accounts.select("account_num")]
    if clients:
        of = keys(reduce(DataFrame.unionByName, clients), "client_id", "gained-clients")
        accounts.append(_in(inp["accounts"], "client", of).select("account_num"))
    if accounts:
        of = keys(reduce(DataFrame.unionByName, accounts), "account_num", "gained-accounts")
        whole.append(_in(inp["cards"], "account_num", of).select("card_num"))
    none = spark.createDataFrame([], "card_num string")
    cards = keys(reduce(DataFrame.unionByName, whole, none), "card_num", "touched-cards")

    facts = [] if gained.transactions is None else [gained.transactions.select("card_num", "trans_date")]
    if gained.terminals is not None:
        at = keys(gained.terminals, "terminal_id", "gained-terminals")
        facts.append(_in(inp["transactions"], "terminal", at).select("card_num", "trans_date"))
    hours = spark.createDataFrame([], "card_num string, hour long")
    if facts:
        seen = reduce(DataFrame.unionByName, facts).where("card_num is not null and trans_date is not null")
        seen = _Keys(seen.select("card_num", hour_of("trans_date").alias("hour")).distinct(), "seen-hours", scratch)
        if seen.count > TOUCHED_BROADCAST and inp["transactions"].count() <= MOST_FACTS * seen.count:
            whole.append(seen.df.select("card_num"))
            cards = keys(reduce(DataFrame.unionByName, whole), "card_num", "touched-cards")
        else:
            around = seen.df.select("card_num", F.explode(F.array(*[F.col("hour") + k for k in (-1, 0, 1)])).alias("hour")).distinct()
            c = cards.hinted().select(F.col("card_num").alias("_card"))
            hours = around.join(c, around["card_num"] == F.col("_card"), "left_anti")
    hours = _Keys(hours, "touched-hours", scratch)
    beside = F.explode(F.array(*[F.col("hour") + k for k in (-1, 0, 1)])).alias("hour")
    near = _Keys(hours.df.select("card_num", beside).distinct(), "touched-near", scratch)
    # The days of these hours; a number of days at most reaches the driver.
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("hour") / 24).cast("int"))
    days = [r[0] for r in near.df.select(day.alias("d")).distinct().limit(MOST_DAYS + 1).collect()]
    return Touched(cards, hours, near, sorted(days) if len(days) <= MOST_DAYS else None, scratch)


def changes(inp: dict, gained: Changes, stored: DataFrame, scratch: list[str]) -> DataFrame:
    """KEY and signed ``n``: what has to be added to the ``stored`` counts so that they add up to
    the alerts of ``inp``, which holds the rows ``gained`` since they were stored."""
    at = touched(inp, gained, scratch)
    before = at.rows(stored.select(*KEY, "n"), "event_dt").withColumn("n", -F.col("n"))
    return counted(inp, at).unionByName(before).groupBy(*KEY).agg(F.sum("n").alias("n")).where("n <> 0")
