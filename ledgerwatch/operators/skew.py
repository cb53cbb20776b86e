"""Left joins whose hot keys are spread over many tasks.

A key that holds a large share of the rows would meet its matches in one task. A frequent-items
sketch finds such keys in one pass over the key column; their rows are dealt to several parts, and
only their matches are copied to each part. Rows without a key match nothing and are
dealt evenly. The sketch decides where rows go, never what the join gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it stands in more than one in SHARE rows, so hot keys are at most as many.
SHARE = 200
#: Rows below which a key is not split.
LEAST_ROWS = 100_000
#: Keys that the sketch tracks; its error is a few rows in so many.
TRACKED = 8192


def hot_keys(df: DataFrame, key: str, least_rows: int = LEAST_ROWS) -> DataFrame:
    """(_hot, _parts): the hot keys, SHARE at most, and the number of parts their rows are dealt to."""
    found = (df.where(F.col(key).isNotNull())
               .agg(F.expr(f"approx_top_k({key}, {SHARE}, {TRACKED})").alias("_top"), F.count(F.lit(1)).alias("_rows")))
    part = F.greatest(F.col("_rows") / SHARE, F.lit(least_rows))
    return (found.select(F.explode("_top").alias("_i"), part.alias("_part"))
                 .select(F.col("_i.item").alias("_hot"), F.ceil(F.col("_i.count") / F.col("_part")).cast("long").alias("_parts"))
                 .where("_parts > 1"))


def spread_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: DataFrame) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``left_key = right_key``, with the columns of both but the
    right key; ``hot`` is from ``hot_keys``, of ``left`` or of the rows it comes from."""
    few = F.broadcast(hot)  # SHARE rows at most
    l_hot = left.join(few, left[left_key] == F.col("_hot"), "left")
    dealt = F.xxhash64(*left.columns)
    part = F.when(F.col(left_key).isNull(), dealt).otherwise(F.pmod(dealt, F.coalesce("_parts", F.lit(1))))
    l_part = l_hot.select(*left.columns, part.alias("_l_part"))
    r_hot = right.join(few, right[right_key] == F.col("_hot"), "left")
    r_part = r_hot.select(*[F.col(c).alias("_r_key" if c == right_key else c) for c in right.columns],
                          F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1)).alias("_r_part"))
    return l_part.join(r_part, (F.col(left_key) == F.col("_r_key")) & (F.col("_l_part") == F.col("_r_part")), "left").drop("_r_key", "_l_part", "_r_part")
