"""Source and history compared by content.

Rows are summed into checksums per range of keys, added on one side and subtracted on the other, so
equal sides give zero whatever the order of rows. Only ranges that are not zero are read key by key.
The first pass moves at most one row per range and task, the second one only what lies in
ranges that differ.

Defined results: rows without a key match nothing and are left out (``reconcile_counts`` has them);
repeated rows count as often as they stand there; columns are compared null-safe and in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges of keys, by hash. The list of those that differ is broadcast, so this bounds it.
RANGES = 4096
_SUMS = ("_n", "_a", "_b", "_c", "_d")


def _prints(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row as four numbers of 32 bits, whose sums can't pass 64 bits before
    two thousand million rows share a range. A null is told from a value and from its neighbour's."""
    parts: list[Column] = []
    for c in columns:
        parts += [F.col(c).isNull(), F.col(c)]
    out = []
    for seed in (0, 1):
        h = F.xxhash64(F.lit(seed), *parts)
        out += [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))]
    return out


def _signed(df: DataFrame, key: str, columns: list[str], sign: int) -> DataFrame:
    values = [F.lit(1).cast("long"), *_prints([key, *columns])]
    return df.where(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.lit(sign).alias("_sign"),
        *[(v * sign).alias(n) for n, v in zip(_SUMS, values, strict=True)])


def _range(ranges: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(ranges)).cast("int")


_UNEQUAL = " or ".join(f"{c} <> 0" for c in _SUMS)


def differing_ranges(source: DataFrame, history: DataFrame, key: str, columns: list[str], ranges: int = RANGES) -> DataFrame:
    """(range): the ranges of keys in which the two sides differ."""
    both = _signed(source, key, columns, 1).unionByName(_signed(history, key, columns, -1))
    return (both.groupBy(_range(ranges).alias("range")).agg(*[F.sum(c).alias(c) for c in _SUMS])
                .where(_UNEQUAL).select("range"))


def differing_keys(source: DataFrame, history: DataFrame, key: str, columns: list[str], ranges: int = RANGES) -> DataFrame:
    """(key, kind) of the keys whose rows differ: ``missing`` from the history, ``extra`` in it, or
    ``differs`` in ``columns`` or in number. Without columns only the keys' presence and number count."""
    found = F.broadcast(differing_ranges(source, history, key, columns, ranges))
    both = _signed(source, key, columns, 1).unionByName(_signed(history, key, columns, -1))
    some = both.join(found, _range(ranges) == F.col("range"), "left_semi")
    sums = some.groupBy("key").agg(*[F.sum(c).alias(c) for c in _SUMS], F.max("_sign").alias("_most"), F.min("_sign").alias("_least"))
    kind = F.when(F.col("_least") == 1, "missing").when(F.col("_most") == -1, "extra").otherwise("differs")
    return sums.where(_UNEQUAL).select("key", kind.alias("kind"))
