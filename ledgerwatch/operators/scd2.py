"""SCD type-2 dimension maintenance as pure DataFrame -> DataFrame functions.

Notation: H history, S staged rows, K all source keys now, END the open
sentinel, run_ts the batch time (one value per batch; closed versions end
one second before it).

Two forms are provided:
* step-wise operators (detect, close, insert, delete), one per statement of
  the original load, for inspection and tests;
* ``merge_history`` / ``merge_latest``: the whole load as one plan. Only the
  latest version per key can change, so the plan joins S and K to one row
  per key. ``merge_latest`` works on a "latest" table (one row per key) and
  returns (new latest, retired versions), so a run costs O(keys + |S|)
  instead of O(|history|); the full history is the retired archive plus the
  latest table.

Behaviour kept from the original load (and pinned by tests):
* a deleted key that returns unchanged stays closed (``revive_unchanged``
  opts into reopening it);
* NULL business keys never match: such rows are inserted every run and never
  closed or deleted;
* the first version starts at load time, not at the source create date.
Changed: duplicate staged keys raise (the original MERGE fails on them too,
but only when the key already exists).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions import changed, end_ts, lit_ts, minus_one_second, ts_string
from ledgerwatch.schemas import FLAG_DELETED, FLAG_LIVE, DimSpec


def empty_history(spark: SparkSession, spec: DimSpec) -> DataFrame:
    return spark.createDataFrame([], spec.history_schema())


def is_open(prefix: str = "") -> Column:
    """Open-version predicate; NULL bounds or flags count as not open."""
    return F.coalesce((F.col(f"{prefix}effective_to") == end_ts())
                      & (F.col(f"{prefix}deleted_flg") == FLAG_LIVE), F.lit(False))


def current_versions(hist: DataFrame) -> DataFrame:
    """P4: open rows."""
    return hist.filter(is_open())


def latest_versions(spec: DimSpec, hist: DataFrame, keep_ties: bool = True) -> DataFrame:
    """D4: the row(s) with the greatest effective_to per key.

    ``keep_ties`` returns every tied row, as the original correlated
    max() did, by a window maximum over the key (one scan, one shuffle).
    Otherwise one row per key via max_by, a single aggregation.
    """
    k = spec.key
    h = hist.filter(F.col(k).isNotNull())
    if keep_ties:
        mx = F.max("effective_to").over(Window.partitionBy(k))
        return (h.withColumn("_mx", mx).filter(F.col("effective_to") == F.col("_mx"))
                 .select(*spec.history_columns))
    return (h.groupBy(k).agg(F.max_by(F.struct(*spec.history_columns), "effective_to").alias("_v"))
             .select("_v.*"))


# ---------------------------------------------------------------- step-wise
def _staged_business(spec: DimSpec, staged: DataFrame) -> DataFrame:
    return staged.select(*spec.business)


def detect_changes(spec: DimSpec, hist: DataFrame, staged: DataFrame) -> DataFrame:
    """D1: staged rows with no open version, or whose open version differs."""
    k = spec.key
    s = _staged_business(spec, staged).alias("s")
    t = current_versions(hist).select(*spec.business).alias("t")
    j = s.join(t, F.col(f"s.{k}") == F.col(f"t.{k}"), "left")
    no_open = F.col(f"t.{k}").isNull()
    return (j.filter(no_open | changed(spec.tracked, "s", "t"))
             .select(*[F.col(f"s.{c}").alias(c) for c in spec.business],
                     F.when(no_open, "insert").otherwise("update").alias("change_kind")))


def close_versions(spec: DimSpec, hist: DataFrame, staged: DataFrame, run_ts: str) -> DataFrame:
    """D2: open rows of changed keys end at run_ts - 1s (flag unchanged)."""
    k = spec.key
    keys = detect_changes(spec, hist, staged).select(F.col(k).alias("_ck")).distinct()
    h = hist.join(keys, hist[k] == keys["_ck"], "left")
    hit = F.col("_ck").isNotNull() & (F.col("effective_to") == end_ts())
    return h.select(*[c for c in spec.history_columns if c != "effective_to"],
                    F.when(hit, minus_one_second(lit_ts(run_ts))).otherwise(F.col("effective_to"))
                     .alias("effective_to")).select(*spec.history_columns)


def new_versions(spec: DimSpec, hist_closed: DataFrame, staged: DataFrame, run_ts: str,
                 revive_unchanged: bool = False) -> DataFrame:
    """D3 (after D2): staged rows whose key is unseen, or whose latest version
    is closed and differs. One row per tied latest version, as the original."""
    k = spec.key
    s = _staged_business(spec, staged).alias("s")
    lat = latest_versions(spec, hist_closed, keep_ties=True).alias("t")
    j = s.join(lat, F.col(f"s.{k}") == F.col(f"t.{k}"), "left")
    seen = F.col(f"t.{k}").isNotNull()
    closed = F.col("t.effective_to") != end_ts()
    differs = changed(spec.tracked, "s", "t")
    if revive_unchanged:
        differs = differs | (F.col("t.deleted_flg") == FLAG_DELETED)
    return (j.filter(~seen | (differs & closed))
             .select(*[F.col(f"s.{c}").alias(c) for c in spec.business],
                     F.lit(FLAG_LIVE).alias("deleted_flg"), lit_ts(run_ts).alias("effective_from"),
                     end_ts().alias("effective_to")))


def logical_deletes(spec: DimSpec, hist: DataFrame, keys: DataFrame, run_ts: str) -> DataFrame:
    """D5: H with open rows whose key left the source closed and flagged 'y'."""
    k = spec.key
    present = keys.filter(F.col(k).isNotNull()).select(F.col(k).alias("_pk")).distinct()
    h = hist.join(present, hist[k] == present["_pk"], "left")
    gone = F.col(k).isNotNull() & F.col("_pk").isNull() & is_open()
    return h.select(*spec.business,
                    F.when(gone, F.lit(FLAG_DELETED)).otherwise(F.col("deleted_flg")).alias("deleted_flg"),
                    "effective_from",
                    F.when(gone, minus_one_second(lit_ts(run_ts))).otherwise(F.col("effective_to"))
                     .alias("effective_to"))


def deleted_rows(spec: DimSpec, hist: DataFrame, keys: DataFrame, run_ts: str) -> DataFrame:
    """The rows D5 changes, in their new state."""
    k = spec.key
    present = keys.filter(F.col(k).isNotNull()).select(F.col(k).alias("_pk")).distinct()
    return (hist.filter(is_open() & F.col(k).isNotNull())
                .join(present, hist[k] == present["_pk"], "left_anti")
                .select(*spec.business, F.lit(FLAG_DELETED).alias("deleted_flg"), "effective_from",
                        minus_one_second(lit_ts(run_ts)).alias("effective_to")))


def step_history(spec: DimSpec, hist: DataFrame, staged: DataFrame, keys: DataFrame,
                 run_ts: str, revive_unchanged: bool = False) -> DataFrame:
    """D2 -> D3 -> D5 composed statement by statement (reference form)."""
    h1 = close_versions(spec, hist, staged, run_ts)
    h2 = h1.unionByName(new_versions(spec, h1, staged, run_ts, revive_unchanged))
    return logical_deletes(spec, h2, keys, run_ts)


# -------------------------------------------------------------- single pass
def _merge_frame(spec: DimSpec, latest: DataFrame, staged: DataFrame, keys: DataFrame,
                 run_ts: str, revive_unchanged: bool) -> DataFrame:
    """One row per non-NULL key seen in the latest table or the batch.

    S and K are aggregated together by key (duplicate staged keys raise),
    then full-joined to the latest rows on that key; the aggregation leaves
    its side hash-partitioned on the key, so the join adds no shuffle there.
    """
    k = spec.key
    hist_cols = spec.history_columns
    t = latest.filter(F.col(k).isNotNull()).select(k, F.struct(*hist_cols).alias("_t"))
    # Staged rows and source keys go through ONE aggregation by key: count of
    # staged rows (duplicates raise), the staged row, and key presence.
    s_struct = F.struct(*spec.business)
    sk = (staged.filter(F.col(k).isNotNull())
                .select(k, s_struct.alias("_row"), F.lit(False).alias("_is_key"))
                .unionByName(keys.filter(F.col(k).isNotNull())
                                 .select(k, F.lit(None).cast(s_struct_type(spec, staged)).alias("_row"),
                                         F.lit(True).alias("_is_key"))))
    s = (sk.groupBy(k)
           .agg(F.count("_row").alias("_n"), F.first("_row", ignorenulls=True).alias("_s"),
                F.max("_is_key").alias("_present"))
           .select(k, F.when(F.col("_n") > 1,
                             F.raise_error(F.concat(F.lit(f"duplicate staged {k}: "), F.col(k))))
                    .otherwise(F.col("_s")).alias("_s"),
                   F.when(F.col("_present"), F.lit(True)).alias("_present")))
    return _resolve(spec, t.join(s, k, "full"), run_ts, revive_unchanged)


def _source_frame(spec: DimSpec, latest: DataFrame, rows: DataFrame, run_ts: str,
                  revive_unchanged: bool) -> DataFrame:
    """As ``_merge_frame``, from ``capture.stage_source``: the source is scanned and dealt by
    key once, and the sort by key that finds a key's staged row also serves the join.

    Rows without a business key match nothing: each stands under a name of its
    own, so they also spread over all tasks."""
    k = spec.key

    def named(df: DataFrame, mark: str) -> Column:
        return F.coalesce(df[k], F.concat(F.lit(mark), F.monotonically_increasing_id().cast("string")))

    t = latest.select(named(latest, "\u0001").alias("_k"), F.struct(*spec.history_columns).alias("_t"))
    w = Window.partitionBy("_k").orderBy(F.desc("_captured"))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (rows.withColumn("_k", named(rows, "\u0000"))
             .withColumn("_n", F.sum(F.col("_captured").cast("int")).over(whole))
             .withColumn("_i", F.row_number().over(w)).filter("_i = 1"))
    s = s.select("_k", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"duplicate staged {k}: "), F.col("_k"))))
                        .when(F.col("_n") == 1, F.struct(*spec.business)).alias("_s"),
                 F.lit(True).alias("_present"))
    return _resolve(spec, t.join(s, "_k", "full"), run_ts, revive_unchanged)


def _resolve(spec: DimSpec, j: DataFrame, run_ts: str, revive_unchanged: bool) -> DataFrame:
    """What becomes of each key: _t latest row, _s staged row, _present in the source."""
    has_t, has_s = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    t_open = has_t & is_open("_t.")
    differs = has_t & has_s & _differs(spec)
    revive = (has_t & (F.col("_t.deleted_flg") == FLAG_DELETED)) if revive_unchanged else F.lit(False)
    insert = has_s & (~has_t | differs | (has_s & revive))
    # A history row without a key is never deleted.
    gone = F.col("_present").isNull() & F.coalesce(F.col(f"_t.{spec.key}"), F.col(f"_s.{spec.key}")).isNotNull()
    cutoff = minus_one_second(lit_ts(run_ts))

    def t_with(eff_to: Column, flag: Column) -> Column:
        return F.struct(*[F.col(f"_t.{c}").alias(c) for c in spec.business],
                        flag.alias("deleted_flg"), F.col("_t.effective_from").alias("effective_from"),
                        eff_to.alias("effective_to"))

    t_new = (F.when(t_open & has_s & differs, t_with(cutoff, F.col("_t.deleted_flg")))
              .when(t_open & gone, t_with(cutoff, F.lit(FLAG_DELETED)))
              .otherwise(F.col("_t")))
    s_new = F.struct(*[F.col(f"_s.{c}").alias(c) for c in spec.business],
                     F.when(gone, F.lit(FLAG_DELETED)).otherwise(F.lit(FLAG_LIVE)).alias("deleted_flg"),
                     lit_ts(run_ts).alias("effective_from"),
                     F.when(gone, cutoff).otherwise(end_ts()).alias("effective_to"))
    return j.select(has_t.alias("_has_t"), t_open.alias("_t_open"), insert.alias("_insert"),
                    t_new.alias("_t_new"), s_new.alias("_s_new"))


def s_struct_type(spec: DimSpec, staged: DataFrame):
    """Type of struct(business columns) as staged (from the known schema)."""
    fields = {f.name: f for f in staged.schema.fields}
    return T.StructType([fields[c] for c in spec.business])


def _differs(spec: DimSpec) -> Column:
    parts = [~F.col(f"_s.{c}").eqNullSafe(F.col(f"_t.{c}")) for c in spec.tracked]
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def _null_key_inserts(spec: DimSpec, staged: DataFrame, run_ts: str) -> DataFrame:
    return (staged.filter(F.col(spec.key).isNull())
                  .select(*spec.business, F.lit(FLAG_LIVE).alias("deleted_flg"),
                          lit_ts(run_ts).alias("effective_from"), end_ts().alias("effective_to")))


def _pick(*parts: tuple[str, str]) -> Column:
    """explode() of the non-NULL structs among (condition column, struct column)."""
    arr = F.array(*[F.when(F.col(cond), F.col(val)) for cond, val in parts])
    return F.explode(F.filter(arr, lambda x: x.isNotNull()))


def merge_history(spec: DimSpec, hist: DataFrame, staged: DataFrame, keys: DataFrame,
                  run_ts: str, revive_unchanged: bool = False) -> DataFrame:
    """D7 in one plan over a full history (assumes at most one open row per key).

    Untouched rows stream through a filter; the merge frame is evaluated
    once and yields the updated open row and the new version of each key
    from the same row."""
    k = spec.key
    lat = latest_versions(spec, hist, keep_ties=False)
    m = _merge_frame(spec, lat, staged, keys, run_ts, revive_unchanged)
    untouched = hist.filter(~is_open() | F.col(k).isNull()).select(*spec.history_columns)
    changed_rows = (m.select(_pick(("_t_open", "_t_new"), ("_insert", "_s_new")).alias("_v"))
                     .select("_v.*"))
    return (untouched.unionByName(changed_rows)
                     .unionByName(_null_key_inserts(spec, staged, run_ts)))


def merge_latest(spec: DimSpec, latest: DataFrame, staged: DataFrame, keys: DataFrame,
                 run_ts: str, revive_unchanged: bool = False) -> tuple[DataFrame, DataFrame]:
    """D7 over the latest table. Returns (new latest, retired versions).

    Both outputs come from one merge frame; callers that write both should
    persist it (``merge_latest_frame``) so the join runs once."""
    m = merge_latest_frame(spec, latest, staged, keys, run_ts, revive_unchanged)
    return split_latest(spec, m, latest, staged, run_ts)


def merge_latest_frame(spec: DimSpec, latest: DataFrame, staged: DataFrame, keys: DataFrame,
                       run_ts: str, revive_unchanged: bool = False) -> DataFrame:
    return _outcomes(_merge_frame(spec, latest, staged, keys, run_ts, revive_unchanged))


def merge_source_frame(spec: DimSpec, latest: DataFrame, rows: DataFrame, run_ts: str,
                       revive_unchanged: bool = False) -> DataFrame:
    """``merge_latest_frame`` from one scan of the source (``capture.stage_source``); rows
    without a key are in it too."""
    return _outcomes(_source_frame(spec, latest, rows, run_ts, revive_unchanged))


def _outcomes(m: DataFrame) -> DataFrame:
    return m.select(F.when(F.col("_insert"), F.col("_s_new")).otherwise(F.col("_t_new")).alias("_latest"),
                    F.when(F.col("_insert") & F.col("_has_t"), F.col("_t_new")).alias("_retired"),
                    (F.col("_has_t") | F.col("_insert")).alias("_keep"))


def latest_and_retired(spec: DimSpec, m: DataFrame) -> DataFrame:
    """Both outputs of ``merge_source_frame`` as one frame tagged by
    ``_kind`` ('latest' | 'retired'), for a single write partitioned by it."""
    cols = spec.history_columns

    def tagged(kind: str, src: str) -> Column:
        return F.struct(F.lit(kind).alias("_kind"), *[F.col(f"{src}.{c}").alias(c) for c in cols])

    return (m.select(F.explode(F.filter(F.array(
                F.when(F.col("_keep"), tagged("latest", "_latest")),
                F.when(F.col("_retired").isNotNull(), tagged("retired", "_retired"))),
                lambda x: x.isNotNull())).alias("_v"))
             .select("_v.*"))


def split_source(m: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new latest, retired versions) of ``merge_source_frame``."""
    return m.filter("_keep").select("_latest.*"), m.filter(F.col("_retired").isNotNull()).select("_retired.*")


def split_latest(spec: DimSpec, m: DataFrame, latest: DataFrame, staged: DataFrame,
                 run_ts: str) -> tuple[DataFrame, DataFrame]:
    k = spec.key
    new_latest = (m.filter("_keep").select("_latest.*")
                   .unionByName(latest.filter(F.col(k).isNull()).select(*spec.history_columns))
                   .unionByName(_null_key_inserts(spec, staged, run_ts)))
    retired = m.filter(F.col("_retired").isNotNull()).select("_retired.*")
    return new_latest, retired


def history_watermark(hist: DataFrame) -> Column:
    """D6: max(effective_from) as a scalar (NULL for an empty history)."""
    return hist.agg(F.max("effective_from")).scalar()


def render(spec: DimSpec, hist: DataFrame) -> DataFrame:
    """History with the validity bounds as 'yyyy-MM-dd HH:mm:ss' strings."""
    return hist.select(*spec.business, "deleted_flg",
                       ts_string("effective_from").alias("effective_from"),
                       ts_string("effective_to").alias("effective_to"))


def ordered(spec: DimSpec, hist: DataFrame) -> DataFrame:
    """O1: listing by key then effective_from."""
    return hist.orderBy(spec.key, "effective_from")

