"""SCD2 queries over the three daily source snapshots (FIXTURES B.2).

Each day: capture (watermark = max effective_from of the history so far),
stage, then the single-pass merge. The history is checkpointed to the
shared checkpoint folder (as Parquet) after every day, which cuts the
lineage so a long replay neither re-plans nor recomputes earlier days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions import epoch_ts
from ledgerwatch.operators import capture, reconcile, scd2
from ledgerwatch.plans.queries import query
from ledgerwatch.plans.store import has_data_files, path_exists
from ledgerwatch.session import scratch_dir
from ledgerwatch.schemas import DIMENSIONS, FLAG_DELETED, WAREHOUSE_DB
from ledgerwatch.sources import testtables as tt


def _wm(hist: DataFrame):
    return F.coalesce(scd2.history_watermark(hist), epoch_ts())


def day_inputs(spark, sf_dir, entity: str, day: int, hist: DataFrame):
    spec = DIMENSIONS[entity]
    src = tt.source_snapshot(spark, sf_dir, entity, day)
    staged = capture.stage_dimension(spec, src, _wm(hist), tt.RUN_TS[day])
    keys = capture.source_keys(spec, src)
    return src, staged, keys


def replay(spark: SparkSession, sf_dir: str, entity: str, days: int,
           lazy_last: bool = False) -> DataFrame:
    """History after loading snapshots 0..days-1 from an empty warehouse.

    Runs the O(keys) form: each day merges the batch into the latest table
    only and writes one table partitioned by _kind (latest | retired) in the
    shared checkpoint folder, which also cuts the lineage. The next day reads
    just the latest partition; the history is every retired partition plus
    the last latest table. With ``lazy_last`` the last day is not written
    (its result is consumed once)."""
    spec = DIMENSIONS[entity]
    schema = spec.history_schema()
    latest = scd2.empty_history(spark, spec)
    retired = []
    root = scratch_dir(spark, f"scd2-{entity}")
    for d in range(days):
        src = tt.source_snapshot(spark, sf_dir, entity, d)
        staged = capture.stage_source(spec, src, _wm(latest), tt.RUN_TS[d])
        rows = scd2.latest_and_retired(spec, scd2.merge_source_frame(spec, latest, staged, tt.RUN_TS[d]))
        if d == days - 1 and lazy_last:
            latest = rows.filter(F.col("_kind") == "latest").drop("_kind")
            retired.append(rows.filter(F.col("_kind") == "retired").drop("_kind"))
            break
        path = f"{root}/day={d}"
        rows.write.mode("overwrite").partitionBy("_kind").parquet(path)
        latest = _read_kind(spark, path, "latest", schema)
        retired.append(_read_kind(spark, path, "retired", schema))
    hist = latest
    for r in retired:
        hist = hist.unionByName(r)
    return hist


def _read_kind(spark, path: str, kind: str, schema):
    part = f"{path}/_kind={kind}"
    if not has_data_files_or_missing(spark, part):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(part)


def has_data_files_or_missing(spark, path: str) -> bool:
    return path_exists(spark, path) and has_data_files(spark, path)


def _full(entity):
    def q(spark, sf_dir):
        spec = DIMENSIONS[entity]
        return scd2.render(spec, replay(spark, sf_dir, entity, 3, lazy_last=True))
    return q


for _e in ("terminals", "accounts", "cards", "clients"):
    query(f"scd2_full_{_e}")(_full(_e))

CL = DIMENSIONS["clients"]


def _day2(spark, sf_dir):
    h1 = replay(spark, sf_dir, "clients", 2)
    _, staged, keys = day_inputs(spark, sf_dir, "clients", 2, h1)
    return h1, staged, keys


@query("dim_current")
def q_dim_current(spark, sf_dir):
    return scd2.render(CL, scd2.current_versions(replay(spark, sf_dir, "clients", 2)))


@query("dim_latest_version")
def q_dim_latest_version(spark, sf_dir):
    return scd2.render(CL, scd2.latest_versions(CL, replay(spark, sf_dir, "clients", 2), keep_ties=True))


@query("scd2_changes")
def q_scd2_changes(spark, sf_dir):
    h1, staged, _ = _day2(spark, sf_dir)
    return scd2.detect_changes(CL, h1, staged)


@query("scd2_close")
def q_scd2_close(spark, sf_dir):
    h1, staged, _ = _day2(spark, sf_dir)
    return scd2.render(CL, scd2.close_versions(CL, h1, staged, tt.RUN_TS[2]))


@query("scd2_new_versions")
def q_scd2_new_versions(spark, sf_dir):
    h1, staged, _ = _day2(spark, sf_dir)
    closed = scd2.close_versions(CL, h1, staged, tt.RUN_TS[2])
    return scd2.render(CL, scd2.new_versions(CL, closed, staged, tt.RUN_TS[2]))


@query("scd2_deletes")
def q_scd2_deletes(spark, sf_dir):
    """D5 on day 1, when keys leave the source: the rows it closes, new state."""
    h0 = replay(spark, sf_dir, "clients", 1)
    _, staged, keys = day_inputs(spark, sf_dir, "clients", 1, h0)
    closed = scd2.close_versions(CL, h0, staged, tt.RUN_TS[1])
    inserted = closed.unionByName(scd2.new_versions(CL, closed, staged, tt.RUN_TS[1]))
    return scd2.render(CL, scd2.deleted_rows(CL, inserted, keys, tt.RUN_TS[1]))


@query("cap_watermark_or_null")
def q_cap_watermark_or_null(spark, sf_dir):
    h0 = replay(spark, sf_dir, "clients", 1)
    src1 = tt.source_snapshot(spark, sf_dir, "clients", 1)
    return capture.capture_or_null(src1, "update_dt", _wm(h0))


def _stage(entity):
    def q(spark, sf_dir):
        h0 = replay(spark, sf_dir, entity, 1)
        _, staged, _ = day_inputs(spark, sf_dir, entity, 1, h0)
        return staged
    return q


for _e in ("clients", "accounts", "cards", "terminals"):
    query(f"stage_{_e}")(_stage(_e))


@query("hist_ordered")
def q_hist_ordered(spark, sf_dir):
    spec = DIMENSIONS["terminals"]
    return scd2.ordered(spec, scd2.render(spec, replay(spark, sf_dir, "terminals", 3, lazy_last=True)))


def _final_histories(spark, sf_dir, days: int = 3):
    """The four entities are independent: replay them as concurrent jobs."""
    from concurrent.futures import ThreadPoolExecutor
    ents = ("clients", "accounts", "cards", "terminals")
    with ThreadPoolExecutor(max_workers=len(ents)) as pool:
        hists = list(pool.map(lambda e: replay(spark, sf_dir, e, days, lazy_last=days == 3), ents))
    return dict(zip(ents, hists))


@query("reconcile_counts")
def q_reconcile_counts(spark, sf_dir):
    """A3: source vs history counts per entity after the last snapshot."""
    parts = []
    for e, h in _final_histories(spark, sf_dir).items():
        src = tt.source_snapshot(spark, sf_dir, e, 2)
        counts = h.agg(F.count(F.lit(1)).alias("history_rows"),
                       F.count_if(scd2.is_open()).alias("open_rows"),
                       F.count_if(F.col("deleted_flg") == FLAG_DELETED).alias("deleted_rows"))
        parts.append(counts.select(F.lit(e).alias("entity"),
                                   src.agg(F.count(F.lit(1))).scalar().alias("source_rows"),
                                   "history_rows", "open_rows", "deleted_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("reconcile_content")
def q_reconcile_content(spark, sf_dir):
    """A3 by content: the keys in which the open versions after two loads differ from the third snapshot."""
    parts = []
    for e, h in _final_histories(spark, sf_dir, days=2).items():
        spec = DIMENSIONS[e]
        src = capture.stage_source(spec, tt.source_snapshot(spark, sf_dir, e, 2), epoch_ts(), tt.RUN_TS[2])
        keys = reconcile.differing_keys(src, scd2.current_versions(h), spec.key, spec.tracked)
        parts.append(keys.select(F.lit(e).alias("entity"), "key", "kind"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("scd2_vanished_keys")
def q_scd2_vanished_keys(spark, sf_dir):
    """J5 by key ranges: open keys that have left the source, read only in ranges whose key sums differ."""
    h0 = replay(spark, sf_dir, "clients", 1)
    keys = capture.source_keys(CL, tt.source_snapshot(spark, sf_dir, "clients", 1)).distinct()
    found = reconcile.differing_keys(keys, scd2.current_versions(h0), CL.key, [])
    return found.where("kind = 'extra'").select(F.col("key").alias(CL.key))


@query("wm_advance_dim")
def q_wm_advance_dim(spark, sf_dir):
    """K5/D6: dimension watermarks after the last snapshot."""
    wm = capture.seed_watermarks(spark)
    for e, h in _final_histories(spark, sf_dir).items():
        wm = capture.advance_watermark(wm, f"dim_{e}_hist", scd2.history_watermark(h))
    return wm.filter(F.col("table_name").startswith("dim_") & (F.col("table_db") == WAREHOUSE_DB))

