"""Transaction drops loaded as a Structured Streaming query.

The file source remembers which drops it has consumed (checkpoint), reads
one file per micro-batch, and each micro-batch is the usual strict-watermark
fact load committed through the warehouse manifest. The manifest also
records the last committed epoch of each stream (by the id its checkpoint
carries), so a micro-batch replayed after a failure is skipped instead of
appended twice, and a stream with a new checkpoint starts on its own count.

Differences from the batch loader: the file source orders drops by
modification time, not by the date in the name; archiving is left to the
source's ``cleanSource`` option.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.operators import capture
from ledgerwatch.plans.store import Warehouse, read_text
from ledgerwatch.schemas import DELIMITER, EPOCH_TS, PATTERN_TRANSACTIONS, RAW_TRANSACTION_COLUMNS
from ledgerwatch.sources.files import own_name

FMT = "%Y-%m-%d %H:%M:%S"


def transaction_drop_stream(spark: SparkSession, drop_dir: str, archive_dir: str | None = None) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in RAW_TRANSACTION_COLUMNS])
    reader = (spark.readStream.schema(schema)
              .option("sep", DELIMITER).option("header", "true").option("quote", "").option("escape", "")
              .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
              .option("mode", "FAILFAST").option("maxFilesPerTrigger", 1)
              .option("pathGlobFilter", "transactions_*"))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    df = reader.csv(drop_dir)
    return df.withColumn("source_file", own_name()).filter(F.col("source_file").rlike("^" + PATTERN_TRANSACTIONS))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query keeps in its checkpoint folder for life."""
    text = read_text(spark, f"{checkpoint.rstrip('/')}/metadata")
    if text is None:
        raise FileNotFoundError(f"{checkpoint} is not the checkpoint of a started stream")
    return json.loads(text)["id"]


def load_transactions_batch(spark: SparkSession, warehouse: str, checkpoint: str,
                            table: str = "fact_transactions"):
    """foreachBatch body: capture above the watermark, append, publish."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        wh = Warehouse(spark, warehouse)
        key = f"{table}/{stream_id(spark, checkpoint)}"
        if epoch_id <= wh.manifest.setdefault("stream_epochs", {}).get(key, -1):
            return
        wm = wh.watermark(table) or EPOCH_TS
        staged = capture.stage_transactions(batch, wm).withColumn("trans_day", F.to_date("trans_date"))
        written = wh.append(table, staged, ("trans_day",))
        mx = written.agg(F.max("trans_date").alias("m")).first().m
        if mx is not None and mx.strftime(FMT) > wm:
            wh.set_watermark(table, mx.strftime(FMT))
        wh.manifest.setdefault("stream_epochs", {})[key] = epoch_id
        wh.publish()

    return run


def run_available(spark: SparkSession, drop_dir: str, warehouse: str, checkpoint: str,
                  archive_dir: str | None = None) -> None:
    """Process every drop present now, one file per micro-batch, then stop."""
    q = (transaction_drop_stream(spark, drop_dir, archive_dir)
         .writeStream.foreachBatch(load_transactions_batch(spark, warehouse, checkpoint))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
