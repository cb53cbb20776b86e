"""The daily load as one function: drops and source tables in, a new
warehouse snapshot out.

Order follows the original job: terminals, passport blacklist,
transactions, accounts, cards, clients, then the fraud report. Every batch
gets its own timestamp, strictly increasing by one second, taken before any
data is read (no sleeps, no clock reads inside statements).

Storage layout under ``cfg.warehouse``:
  dim_<e>_latest/v=<n>   one row per key (rewritten each run)
  dim_<e>_archive/...    superseded versions (append-only batches)
  fact_transactions/...  append-only batches, partitioned by trans_day
  fact_blacklist/...     append-only batches
  rep_fraud/...          append-only batches, partitioned by report_day
  rep_alerts/...         counted alerts as signed changes (append-only), if asked for
  _manifest-<n>.json     table versions, batch lists, watermarks, consumed drops
Nothing becomes visible before the manifest is published at the end; drops are
archived only after it. The manifest lists the drops it has consumed (name,
size and time), so a drop whose move to the archive failed is not loaded again.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions import lit_ts
from ledgerwatch.operators import alerts, capture, facts, rules, scd2
from ledgerwatch.plans.store import Warehouse
from ledgerwatch.session import drop_scratch, scratch_dir
from ledgerwatch.schemas import (ALERTS_SCHEMA, BLACKLIST_SCHEMA, DIMENSIONS, EPOCH_TS, PATTERN_BLACKLIST,
                                 PATTERN_TERMINALS, PATTERN_TRANSACTIONS, RAW_BLACKLIST_COLUMNS,
                                 RAW_TERMINAL_COLUMNS, RAW_TRANSACTION_COLUMNS, REPORT_SCHEMA,
                                 TRANSACTIONS_SCHEMA)
from ledgerwatch.sources import files

FMT = "%Y-%m-%d %H:%M:%S"


@dataclass
class PipelineConfig:
    warehouse: str
    drop_dir: str | None = None
    # Relational sources: entity -> DataFrame with the source layout
    # (clients/accounts/cards). Read through ``sources.tables.read_table``.
    sources: dict[str, DataFrame] = field(default_factory=dict)
    archive: bool = True
    revive_unchanged: bool = False
    compat_untrimmed_keys: bool = False
    # An empty fact batch resets the watermark, as the original loader did.
    compat_null_reset: bool = False
    # "full": every run reports the whole history again, one row per alert, as the original did.
    # "counted": every run stores the signed changes of the counted alerts and reports nothing else.
    # "new": as "counted", and the alerts that were not there before are reported, one row each.
    report: str = "full"
    # The same as report="new".
    only_new_since: bool = False
    drop_order: str = "date"


class Clock:
    """Strictly increasing batch timestamps, one second apart."""

    def __init__(self, start: str):
        self.t = dt.datetime.strptime(start, FMT)

    def next(self) -> str:
        out = self.t.strftime(FMT)
        self.t += dt.timedelta(seconds=1)
        return out


@dataclass(frozen=True)
class Drop:
    """One dropped file: its path, its own name, and what tells it from a later file of that name."""
    path: str
    name: str
    mark: str


def _files(spark, cfg, pattern, consumed: set[str]) -> tuple[list[Drop], list[Drop]]:
    """(drops to load, in order; drops that an earlier run has loaded already)."""
    if not cfg.drop_dir:
        return [], []
    found = files.discover_empty_ok(spark, cfg.drop_dir, pattern, cfg.drop_order)
    # The listing (one row per file) is all that reaches the driver.
    drops = [Drop(r.path, r.file_name, r.mark) for r in found.orderBy("batch_no").select("path", "file_name", "mark").collect()]
    return [d for d in drops if d.mark not in consumed], [d for d in drops if d.mark in consumed]


def _load_dimension(wh: Warehouse, entity: str, source: DataFrame, run_ts: str, cfg, scratch: list[str]) -> int:
    """Loads one source; returns how many captured rows had no business key (they are
    inserted anew by every load that captures them)."""
    spec = DIMENSIONS[entity]
    # Read the source once: a consistent snapshot in the shared checkpoint
    # folder feeds both the captured rows and the list of present keys.
    spark = source.sparkSession
    snap = scratch_dir(spark, f"source-{entity}")
    scratch.append(snap)
    source.write.mode("overwrite").parquet(snap)
    source = spark.read.schema(source.schema).parquet(snap)
    latest = wh.read(f"dim_{entity}_latest", spec.history_schema())
    wm = wh.watermark(f"dim_{entity}_hist") or EPOCH_TS
    # The merge frame (one row per key) feeds two tables: persist it so the
    # join runs once; lost blocks are recomputed from lineage.
    if cfg.compat_untrimmed_keys:
        staged = capture.stage_dimension(spec, source, wm, run_ts)
        keys = capture.source_keys(spec, source, trim=False)
        m = scd2.merge_latest_frame(spec, latest, staged, keys, run_ts, cfg.revive_unchanged)
        m = m.persist(StorageLevel.MEMORY_AND_DISK)
        new_latest, retired = scd2.split_latest(spec, m, latest, staged, run_ts)
    else:
        rows = capture.stage_source(spec, source, wm, run_ts)
        m = scd2.merge_source_frame(spec, latest, rows, run_ts, cfg.revive_unchanged)
        m = m.persist(StorageLevel.MEMORY_AND_DISK)
        new_latest, retired = scd2.split_source(m)
    # Counted while the table is written: no run but this one begins versions at run_ts.
    seen = Observation()
    lost = F.col(spec.key).isNull() & (F.col("effective_from") == lit_ts(run_ts))
    wh.stage(f"dim_{entity}_latest", new_latest.observe(seen, F.max("effective_from").alias("top"), F.count_if(lost).alias("lost")))
    wh.append(f"dim_{entity}_archive", retired)
    m.unpersist()
    top = seen.get["top"]
    wh.set_watermark(f"dim_{entity}_hist", top.strftime(FMT) if top else None)
    return seen.get["lost"]


def _load_fact_files(spark, wh: Warehouse, name: str, drops: list[Drop], reader, stager,
                     date_col: str, cfg, scratch: list[str], partition_by: tuple[str, ...] = ()) -> None:
    """All drops of one kind in one job: batch number = file order; the
    closed-form replay keeps exactly what a file-by-file load keeps. A row
    from a file without a number fails the load."""
    if not drops:
        return
    wm = wh.watermark(name) or EPOCH_TS
    raw = reader([d.path for d in drops])
    numbers = spark.createDataFrame([(d.name, i) for i, d in enumerate(drops)], "_name string, _batch int")
    # One row per file; the left join keeps rows of unknown files, which the replay refuses.
    raw = raw.join(numbers, raw["source_file"] == numbers["_name"], "left")
    typed = stager(raw)
    # Parse the drops once: stage the typed rows as Parquet in the shared
    # checkpoint folder. The replay's per-file maxima then read two columns,
    # and the filter reads the staged copy instead of re-parsing text.
    staged_path = scratch_dir(spark, f"staged-{name}")
    scratch.append(staged_path)
    typed.write.mode("overwrite").parquet(staged_path)
    typed = spark.read.schema(typed.schema).parquet(staged_path)
    kept = facts.replay_batches(typed, date_col, "_batch", wm)
    if cfg.compat_null_reset:
        kept = _replay_with_reset(wh, name, typed, date_col, len(drops), wm)
    kept = kept.drop("_batch")
    if partition_by:
        kept = kept.withColumn("trans_day", F.to_date(date_col))
    seen = Observation()
    wh.append(name, kept.observe(seen, F.max(date_col).alias("top")), partition_by)
    top = seen.get["top"]
    if top is not None and (cfg.compat_null_reset or top.strftime(FMT) > wm):
        wh.set_watermark(name, top.strftime(FMT))


def _replay_with_reset(wh: Warehouse, name: str, typed: DataFrame, date_col: str, n: int, wm: str) -> DataFrame:
    """The original's watermark guard, batch by batch: a batch that captures nothing sets
    the watermark back to the epoch once the fact holds rows."""
    per = {r["_batch"]: r.m for r in typed.groupBy("_batch").agg(F.max(date_col).alias("m")).collect()}  # one row per file
    if None in per:
        raise ValueError("a row of the load belongs to no batch")
    bars, bar = [], wm
    filled = bool(wh.manifest.get("batches", {}).get(name))
    for i in range(n):
        m = per.get(i)
        top = m.strftime(FMT) if m is not None else None
        bars.append((i, bar))
        if top is not None and top > bar:
            bar, filled = top, True
        elif filled:
            bar = EPOCH_TS
    if bar == EPOCH_TS and filled:
        wh.manifest["watermarks"].pop(name, None)
    limits = typed.sparkSession.createDataFrame(bars, "_b int, _bar string")
    return (typed.join(limits, typed["_batch"] == limits["_b"])
                 .filter(F.col(date_col) > F.col("_bar").cast("timestamp_ntz")).drop("_b", "_bar"))


def run_pipeline(spark: SparkSession, cfg: PipelineConfig, run_ts: str) -> dict:
    """One daily load. Scratch copies of the run are removed when it ends, well or not."""
    scratch: list[str] = []
    try:
        return _run(spark, cfg, run_ts, scratch)
    finally:
        drop_scratch(spark, scratch)


def _run(spark: SparkSession, cfg: PipelineConfig, run_ts: str, scratch: list[str]) -> dict:
    wh = Warehouse(spark, cfg.warehouse)
    clock = Clock(run_ts)
    known = set(wh.manifest.get("consumed", []))
    consumed: list[Drop] = []
    again: list[Drop] = []
    null_keys: dict[str, int] = {}

    # terminals: file drops, one SCD2 batch per file, in file order
    todo, old = _files(spark, cfg, PATTERN_TERMINALS, known)
    for d in todo:
        raw = files.read_workbooks(spark, [d.path], RAW_TERMINAL_COLUMNS)
        lost = _load_dimension(wh, "terminals", raw, clock.next(), cfg, scratch)
        null_keys["terminals"] = null_keys.get("terminals", 0) + lost
    consumed, again = consumed + todo, again + old

    # passport blacklist and transactions: append-only facts
    todo, old = _files(spark, cfg, PATTERN_BLACKLIST, known)
    _load_fact_files(spark, wh, "fact_blacklist", todo,
                     lambda ps: files.read_workbooks(spark, ps, RAW_BLACKLIST_COLUMNS),
                     lambda df: capture.stage_blacklist(df, None, keep=("_batch",)), "entry_dt", cfg, scratch)
    consumed, again = consumed + todo, again + old
    todo, old = _files(spark, cfg, PATTERN_TRANSACTIONS, known)
    _load_fact_files(spark, wh, "fact_transactions", todo,
                     lambda ps: files.read_delimited(spark, ps, RAW_TRANSACTION_COLUMNS),
                     lambda df: capture.stage_transactions(df, None, keep=("_batch",)),
                     "trans_date", cfg, scratch, partition_by=("trans_day",))
    consumed, again = consumed + todo, again + old

    # relational sources
    for entity in ("accounts", "cards", "clients"):
        if entity in cfg.sources:
            null_keys[entity] = _load_dimension(wh, entity, cfg.sources[entity], clock.next(), cfg, scratch)

    report_ts = clock.next()
    _report(wh, "new" if cfg.only_new_since else cfg.report, run_ts, report_ts, scratch)

    # Drops that stay in the folder must be known to the next run; the marks of archived
    # files leave the list with the run after.
    wh.manifest["consumed"] = sorted(d.mark for d in consumed + again)
    wh.publish()
    failed: list[str] = []
    if cfg.archive and consumed + again:
        _, failed = files.archive(spark, [d.path for d in consumed + again], f"{cfg.drop_dir.rstrip('/')}/archive")
    return {"run_ts": run_ts, "report_ts": report_ts, "files": len(consumed), "skipped": len(again),
            "not_archived": failed, "null_keys": {k: n for k, n in null_keys.items() if n},
            "watermarks": dict(wh.manifest["watermarks"])}


def _report(wh: Warehouse, mode: str, run_ts: str, report_ts: str, scratch: list[str]) -> None:
    """The report of the run: the whole bag, or the changes of the counted alerts."""
    if mode not in ("full", "counted", "new"):
        raise ValueError(f"unknown report mode {mode!r}")
    inp = _rule_inputs(wh)
    if mode == "full":
        report = rules.fraud_report(inp, report_ts)
        wh.append("rep_fraud", report.withColumn("report_day", F.to_date("report_dt")), ("report_day",))
        return
    last = wh.manifest.get("alerts")
    if last is None:
        found = alerts.counted(inp)
    else:
        if run_ts <= last["upto"]:
            raise ValueError(f"run {run_ts} is not later than the last report ({last['upto']})")
        stored = wh.read_append("rep_alerts", ALERTS_SCHEMA)
        found = alerts.changes(inp, _gained(wh, inp, last), stored, scratch)
    added = wh.append("rep_alerts", found.withColumn("report_dt", F.lit(report_ts).cast("timestamp_ntz")))
    if mode == "new":
        report = alerts.expanded(added.where("n > 0"), report_ts)
        wh.append("rep_fraud", report.withColumn("report_day", F.to_date("report_dt")), ("report_day",))
    batches = wh.manifest.get("batches", {})
    wh.manifest["alerts"] = {"upto": report_ts, "batches": {t: list(batches.get(t, [])) for t in ("fact_transactions", "fact_blacklist")}}


def _gained(wh: Warehouse, inp: dict, last: dict) -> alerts.Changes:
    """What the inputs have gained since the last counted report: batches of facts that it had not
    seen, and versions that begin after it."""
    seen = {t: last["batches"].get(t, []) for t in ("fact_transactions", "fact_blacklist")}
    fresh = {t: set(wh.manifest.get("batches", {}).get(t, [])) - set(paths) for t, paths in seen.items()}
    new = {e: inp[e].where(F.col("effective_from") > F.lit(last["upto"]).cast("timestamp_ntz")) for e in DIMENSIONS}
    return alerts.Changes(
        transactions=wh.read_append("fact_transactions", TRANSACTIONS_SCHEMA, seen["fact_transactions"]) if fresh["fact_transactions"] else None,
        blacklist=wh.read_append("fact_blacklist", BLACKLIST_SCHEMA, seen["fact_blacklist"]) if fresh["fact_blacklist"] else None,
        **{e: None if df.isEmpty() else df for e, df in new.items()})


#: Facts as they are stored, with the day that partitions them.
STORED_TRANSACTIONS = T.StructType([*TRANSACTIONS_SCHEMA.fields, T.StructField("trans_day", T.DateType())])


def _rule_inputs(wh: Warehouse) -> dict:
    def hist(entity):
        spec = DIMENSIONS[entity]
        latest = wh.read(f"dim_{entity}_latest", spec.history_schema())
        return latest.unionByName(wh.read_append(f"dim_{entity}_archive", spec.history_schema()))
    return {"transactions": wh.read_append("fact_transactions", STORED_TRANSACTIONS),
            "terminals": hist("terminals"), "cards": hist("cards"), "accounts": hist("accounts"),
            "clients": hist("clients"),
            "blacklist": wh.read_append("fact_blacklist", BLACKLIST_SCHEMA)}


# Append-only tables: schema and partition columns.
APPEND_TABLES = {
    "fact_transactions": (TRANSACTIONS_SCHEMA, ("trans_day",)),
    "fact_blacklist": (BLACKLIST_SCHEMA, ()),
    "rep_fraud": (REPORT_SCHEMA, ("report_day",)),
    "rep_alerts": (ALERTS_SCHEMA, ()),
    **{f"dim_{e}_archive": (DIMENSIONS[e].history_schema(), ()) for e in DIMENSIONS},
}


def compact_all(spark: SparkSession, warehouse: str, tables: list[str] | None = None) -> dict:
    """Merge each append-only table's batches into one (one publish per table)."""
    wh = Warehouse(spark, warehouse)
    return {t: wh.compact(t, *APPEND_TABLES[t]) for t in (tables or list(APPEND_TABLES))}


def read_report(spark: SparkSession, warehouse: str) -> DataFrame:
    return Warehouse(spark, warehouse).read_append("rep_fraud", REPORT_SCHEMA)


def read_alerts(spark: SparkSession, warehouse: str, report_ts: str) -> DataFrame:
    """The whole report as the counted alerts of all runs add up to, one row per alert."""
    return alerts.expanded(Warehouse(spark, warehouse).read_append("rep_alerts", ALERTS_SCHEMA), report_ts)
