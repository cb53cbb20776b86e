"""Small helpers the operators of this package share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.session import drop_scratch, scratch_dir

#: Arrow batches handed to Python tasks hold at most this many bytes, so a run
#: of very long texts cannot fill a worker.
BATCH_BYTES = 4 << 20
#: Bits for each key in a bitmap of keys: one in about as many rows of other keys passes it.
KEY_BITS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Session settings that bound what one Python task holds, and the path by which local
    Python workers find this package (a cluster gets it by --py-files or an install)."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder, read it back."""
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path, mode="overwrite", compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Remove the table that ``written`` made, once everything derived from it is written too."""
    drop_scratch(df.sparkSession, [os.path.dirname(f) for f in df.inputFiles()[:1]])


def told_apart(df: DataFrame, key: Column, keys: DataFrame, among: Column, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows of ``df`` whose key may be one of ``keys``, rows whose key is none). A broadcast bitmap
    of hashed keys, KEY_BITS bits for each, tells most rows apart where they are read, so that
    long rows needn't move to meet few keys; the first ones still have to be joined."""
    bits = 32768 * max(1, -(-KEY_BITS * keys.count() // 32768))

    def place(k: Column) -> Column:
        return F.pmod(F.xxhash64(k), F.lit(bits)) + 1

    at = F.col("__at")
    maps = (keys.select(place(among).alias("__at")).groupBy(F.bitmap_bucket_number(at).alias("__bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("__map")))
    maps = F.broadcast(written(maps, name))
    held = df.withColumn("__at", place(key)).join(maps, F.bitmap_bucket_number(at) == F.col("__bucket"), "left")
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("__map", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    may = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return held.where(may).select(*df.columns), held.where(~may).select(*df.columns)


def fold(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id folds as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % mod


def uniform(*parts: Column, seed: str) -> Column:
    """A number in [0, 1) from the md5 of the seed and the parts (52 bits)."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def ranked(df: DataFrame, order: list, name: str) -> tuple[DataFrame, int]:
    """``df`` with its rank from 1 in the given order, and its number of rows. Parts of a range
    partitioning are numbered apart and shifted by the sizes of the parts before them."""
    place = "__place"
    parts = written(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn(place, F.monotonically_increasing_id()), name)
    part = F.shiftright(place, 33)
    sizes = parts.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = written(sizes.withColumn("__before", F.coalesce(F.sum("__size").over(before), F.lit(0))), f"{name}-sizes")
    total = sizes.agg(F.sum("__size")).first()[0] or 0
    rank = F.col("__before") + F.col(place) - F.shiftleft(part, 33) + 1
    return (parts.withColumn("__part", part).join(F.broadcast(sizes), "__part")
            .withColumn("rank", rank).drop(place, "__part", "__size", "__before")), total
