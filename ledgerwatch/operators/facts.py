"""Append-only fact loads with a strict high-watermark.

One batch: capture rows strictly above the watermark, append them, move the
watermark to the batch maximum (kept when the batch is empty).

Several batches in order (one per dropped file) have a closed form: a row of
batch b is kept iff its date is above max(wm0, max date of every earlier
batch). Reason: a batch raises the watermark exactly to its own maximum
whenever that maximum is above it, and never lowers it. So the replay is one
aggregation per batch, a running max over the (few) batch values, and a
join with the per-batch thresholds, instead of a loop of dependent jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions import lit_ts
from ledgerwatch.operators.capture import capture_strict
from ledgerwatch.schemas import EPOCH_TS


def append(fact: DataFrame, staged: DataFrame) -> DataFrame:
    """K4: bag append, no dedupe, columns matched by name."""
    return fact.unionByName(staged.select(*fact.columns))


def load_batch(fact: DataFrame, batch: DataFrame, date_col: str, wm):
    """T1/T2 for one typed batch: (new fact, staged rows, new watermark column)."""
    staged = capture_strict(batch, date_col, wm)
    new_wm = F.coalesce(staged.agg(F.max(date_col)).scalar(), wm if not isinstance(wm, str) else lit_ts(wm))
    return append(fact, staged), staged, new_wm


def replay_batches(rows: DataFrame, date_col: str, batch_col: str, wm0=None) -> DataFrame:
    """T3: rows that a sequential per-batch load keeps (batches ordered by
    ``batch_col``), with the default watermark guard. A row without a batch
    fails the load.

    One aggregation yields each batch's maximum (one row per dropped file),
    a window over those few rows the running maximum before each batch, and
    the rows meet their threshold by a join on the batch, which the adaptive
    planner broadcasts while the thresholds are measured to be small.
    """
    start = EPOCH_TS if wm0 is None else wm0
    if not isinstance(start, str):
        raise TypeError("wm0 must be a 'yyyy-MM-dd HH:mm:ss' string")
    known = F.when(F.col(batch_col).isNull(),
                   F.raise_error(F.concat(F.lit("a row of the load belongs to no batch; its date is "),
                                          F.coalesce(F.col(date_col).cast("string"), F.lit("NULL")))))
    rows = rows.withColumn(batch_col, F.coalesce(known.cast(rows.schema[batch_col].dataType), F.col(batch_col)))
    per_batch = rows.groupBy(F.col(batch_col).alias("_b")).agg(F.max(date_col).alias("_bmax"))
    # One row per dropped file in the window's only partition.
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bars = per_batch.select("_b", F.greatest(lit_ts(start), F.max("_bmax").over(before)).alias("_bar"))
    return (rows.join(bars, F.col(batch_col) == F.col("_b"))
                .filter(F.col(date_col) > F.col("_bar")).drop("_b", "_bar"))
