"""Mixing sources to target weights by Poisson replication (operator 7).

A source's mean repetition rate is its target share of all characters over its
actual share, times the epochs. Each document draws its number of copies by
inverting the Poisson distribution of that mean at a uniform number hashed from
the seed and its id, so any run draws the same. Copies are dealt to partitions,
and sorted within them, by further hashes: a global shuffle.

Defined results: sources without a target share what the named ones leave, in
proportion to their size; a null source is a source; a source of empty texts
only has a rate of ``epochs``; null texts count no characters; rows that repeat an
id draw alike; columns of documents named copy, rate or shuffle_key are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import table, uniform, written

#: Target shares of characters; the rest is shared by all other sources.
WEIGHTS = {"src0": 0.20, "src1": 0.10, "src2": 0.10}
EPOCHS = 1.0
SEED = "mix-1"


def rates(documents: DataFrame, weights: dict[str, float], epochs: float) -> DataFrame:
    """source, rate and cdf (the Poisson distribution function from 0 on), a row per source."""
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    per = documents.select("source", size.alias("size")).groupBy("source").agg(F.sum("size").alias("size"))
    named = F.lit(None).cast("double")
    for source, weight in sorted(weights.items()):
        named = F.when(F.col("source") == source, F.lit(float(weight))).otherwise(named)
    per = written(per.withColumn("named", named), "source-sizes")
    row = per.where("size > 0").agg(
        F.sum("size").alias("total"), F.sum(F.when(F.col("named").isNull(), F.col("size"))).alias("free"),
        F.sum("named").alias("given")).first()
    total, free, given = float(row.total or 0), float(row.free or 0), float(row.given or 0)
    # If every source is named, or none is left for the rest, the named shares are scaled to one.
    scale = 1.0 if free else 1.0 / (given or 1.0)
    share = F.when(F.col("named").isNotNull(), F.col("named") * scale).otherwise(
        F.lit(max(0.0, 1.0 - given)) * F.col("size") / F.lit(free or 1.0))
    rate = F.when(F.col("size") == 0, F.lit(float(epochs))).otherwise(share * F.lit(float(epochs)) * F.lit(total) / F.col("size"))
    per = per.select("source", rate.alias("rate"))
    last = F.ceil(F.col("rate") + 10 * F.sqrt("rate") + 20).cast("int")

    def step(acc: Column, k: Column) -> Column:
        log_p = acc["log_p"] + F.when(k == 0, F.lit(0.0)).otherwise(F.log("rate") - F.log(k.cast("double")))
        total = acc["c"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), total.alias("c"), F.array_append(acc["cdf"], total).alias("cdf"))

    start = F.struct((-F.col("rate")).alias("log_p"), F.lit(0.0).alias("c"), F.array().cast("array<double>").alias("cdf"))
    cdf = F.when(F.col("rate") > 0, F.aggregate(F.sequence(F.lit(0), last), start, step, lambda acc: acc["cdf"])).otherwise(F.array(F.lit(1.0)))
    return per.withColumn("cdf", cdf)


def mix(documents: DataFrame, weights: dict[str, float] | None = None, epochs: float = EPOCHS, seed: str = SEED) -> DataFrame:
    """Columns of documents, copy (1, 2, ...), rate, and shuffle_key in shuffled order."""
    documents = documents.drop("copy", "rate", "shuffle_key")
    # Written first, so the planner knows how small it is and needn't shuffle the documents.
    per = written(rates(documents, WEIGHTS if weights is None else weights, epochs), "rates")
    # The caller's columns travel in one struct, so no name of theirs meets one of these.
    doc = F.col("doc")
    drawn = documents.select(F.struct("*").alias("doc")).join(per, doc["source"].eqNullSafe(F.col("source")))
    u = uniform(doc["doc_id"], seed=seed)
    copies = drawn.withColumn("n", F.size(F.filter("cdf", lambda c: c <= u))).where("n > 0")
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n").cast("long"))))
    key = uniform(doc["doc_id"], F.col("copy"), seed=f"{seed}-order")
    out = copies.withColumn("shuffle_key", key).select(*[doc[c].alias(c) for c in documents.columns], "copy", "rate", "shuffle_key")
    return out.repartition("shuffle_key").sortWithinPartitions("shuffle_key", "doc_id", "copy")


def op7_poisson_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def oracle(weights: dict[str, float] = WEIGHTS, epochs: float = EPOCHS, seed: str = SEED) -> str:
    cases = " ".join(f"WHEN source = '{s}' THEN {w!r}::DOUBLE" for s, w in sorted(weights.items()))
    draw = "('0x' || substr(md5({}), 1, 13))::BIGINT / 4503599627370496.0"
    u = draw.format(f"concat_ws(':', '{seed}', coalesce(doc_id::VARCHAR, ''))")
    key = draw.format(f"concat_ws(':', '{seed}-order', coalesce(doc_id::VARCHAR, ''), c.copy::VARCHAR)")
    return f"""
WITH per AS (SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS size, CASE {cases} END AS named FROM documents GROUP BY source),
s AS (SELECT sum(size) AS total, coalesce(sum(size) FILTER (named IS NULL), 0) AS free, coalesce(sum(named), 0) AS given FROM per WHERE size > 0),
r AS (SELECT source, CASE WHEN size = 0 THEN {epochs!r}::DOUBLE ELSE (CASE WHEN named IS NOT NULL THEN named * (CASE WHEN free > 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE / given END)
  ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE - given) * size / free END) * {epochs!r}::DOUBLE * total / size END AS rate FROM per, s),
k AS (SELECT source, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 20)::BIGINT + 1)) AS k FROM r),
p AS (SELECT source, rate, k, sum(CASE WHEN rate <= 0 THEN (k = 0)::INT ELSE exp(-rate + k * ln(CASE WHEN rate > 0 THEN rate ELSE 1 END) - lgamma(k + 1)) END)
  OVER (PARTITION BY source ORDER BY k) AS cdf FROM k),
d AS (SELECT documents.*, r.rate, {u} AS u, row_number() OVER () AS row FROM documents JOIN r ON documents.source IS NOT DISTINCT FROM r.source),
c AS (SELECT d.row, row_number() OVER (PARTITION BY d.row ORDER BY p.k) AS copy FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND p.cdf <= d.u)
SELECT doc_id, text, lang, source, n_chars, c.copy, rate, {key} AS shuffle_key FROM c JOIN d ON c.row = d.row"""
