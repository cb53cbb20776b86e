"""Importance resampling towards a target text (op13): bit-sliced aggregation of bucket gains.

Features are a text's words and pairs of neighbouring words, hashed into 10,000 buckets. A bucket's
gain is the logarithm of how much likelier it is in the target than in the corpus; a document's
weight is the mean gain over its features. Gumbel noise from a hash of the id turns the highest
scores into a sample without replacement, proportional to exp(weight).

Weights are computed bit-sliced: a document's bucket counts become planes of one bit per bucket
(plane j holds bit j of each count), the gains become signed planes of the same width (two's
complement, the top plane counts negative), and a weight is the sum of 2^(j + k) times the number
of bits that plane j of the counts and plane k of the gains share: exact integers.

The corpus is read twice, once to count the buckets (one row per bucket and task is shuffled) and
once to weigh; only numbers per document move. Ranks come from a range-partitioned sort and the
sizes of its parts, so no task sees all documents. The 10,000 gains are the one thing sent to
tasks; their number is fixed.

Defined results: a null text has no features (weight 0) and cannot be drawn; a null id hashes as
the empty text and goes before other ids in ties; a repeated id makes a row each, in the order of
feature counts; an empty target or corpus gives the gains of its zero counts; no table's other
columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm.common import prepare, ranked, table, written
from ledgerwatch.llm.tokens import ALNUM, chunks
from ledgerwatch.llm.words import spans

BUCKETS = 10_000
#: Words of at most so many bytes are hashed together, longer ones one by one.
TOGETHER = 64
#: Documents whose planes are built at once: 128 rows of 10,048 flags are 1.3 MB.
AT_ONCE = 128
_WIDE = -(-BUCKETS // 64) * 64

_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _TABLE = np.where(_TABLE & 1, (_TABLE >> 1) ^ np.uint32(0xEDB88320), _TABLE >> 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _fed(state: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _TABLE[(state ^ byte) & 255] ^ (state >> np.uint32(8))


def _crc(state: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The CRC register after the bytes raw[start:end] of each row, from the given registers."""
    size = end - start
    order = np.argsort(-np.minimum(size, TOGETHER), kind="stable")
    out, at, left = state[order], start[order], size[order]
    many = len(left) - np.searchsorted(np.minimum(left, TOGETHER)[::-1], np.arange(TOGETHER), "right")
    for p in range(TOGETHER):
        n = int(many[p])
        if not n:
            break
        out[:n] = _fed(out[:n], raw[at[:n] + p])
    for i in np.flatnonzero(left > TOGETHER):
        rest = raw[at[i] + TOGETHER:at[i] + left[i]].tobytes()
        out[i] = zlib.crc32(rest, int(out[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    back = np.empty_like(out)
    back[order] = out
    return back


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of every feature, and the number of words per document."""
    raw = _LOWER[raw]
    words = spans(raw, offsets, ALNUM)
    doc = words.doc
    one = _crc(np.full(len(doc), 0xFFFFFFFF, np.uint32), raw, words.start, words.end)
    first = np.flatnonzero(doc[1:] == doc[:-1])
    two = _crc(_fed(one[first], ord(" ")), raw, words.start[first + 1], words.end[first + 1])
    bucket = (np.concatenate((one, two)) ^ np.uint32(0xFFFFFFFF)) % np.uint32(BUCKETS)
    return np.concatenate((doc, doc[first])), bucket.astype(np.int64), np.diff(words.bounds)


def _counting(column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, raw, offsets in chunks(batch, column):
                total += np.bincount(features(raw, offsets)[1], minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])
    return run


def bucket_counts(df: DataFrame, column: str = "text") -> DataFrame:
    """(bucket, n) over all texts."""
    return (df.select(column).mapInArrow(_counting(column), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """A gain per bucket: floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))), in doubles, where S and T are
    the sums of the counts s and t. The two tables of counts hold a row per bucket at most."""
    counts = np.zeros((2, BUCKETS))
    for row, df in zip(counts, (docs, target)):
        for bucket, n in bucket_counts(df).collect():
            row[bucket] = n
    (s, t), (s_all, t_all) = counts, counts.sum(axis=1)
    return np.floor(1000 * np.log((t + 1) * (s_all + BUCKETS) / ((s + 1) * (t_all + BUCKETS)))).astype(np.int64)


def sliced(gain: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Signed planes of the gains (two's complement) as 64-bit words, and each plane's factor."""
    bits = max(int(np.abs(gain).max(initial=0)).bit_length(), 1) + 1
    flags = np.zeros((bits, _WIDE), np.uint8)
    flags[:, :len(gain)] = gain[None, :] >> np.arange(bits)[:, None] & 1
    return np.packbits(flags, axis=1).view(np.uint64), [1 << k for k in range(bits - 1)] + [-(1 << bits - 1)]


def summed(doc: np.ndarray, bucket: np.ndarray, n: int, planes: np.ndarray, factors: list[int]) -> np.ndarray:
    """The sum of gains over the features (doc, bucket) of n documents, bit-sliced."""
    out = np.zeros(n, np.int64)
    key, count = np.unique(doc * BUCKETS + bucket, return_counts=True)
    for lo in range(0, n, AT_ONCE):
        a, b = np.searchsorted(key, [lo * BUCKETS, (lo + AT_ONCE) * BUCKETS])
        row, col, c = key[a:b] // BUCKETS - lo, key[a:b] % BUCKETS, count[a:b]
        for j in range(int(c.max(initial=0)).bit_length()):
            on = c >> j & 1 == 1
            rows, at = np.unique(row[on], return_inverse=True)
            flags = np.zeros((len(rows), _WIDE), np.uint8)
            flags[at, col[on]] = 1
            plane = np.packbits(flags, axis=1).view(np.uint64)
            for gain, factor in zip(planes, factors):
                shared = np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
                out[lo + rows] += shared * (factor << j)
    return out


def _weighing(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, factors = sliced(gain)
        for batch in batches:
            for part, raw, offsets in chunks(batch, "text"):
                doc, bucket, words = features(raw, offsets)
                n = np.bincount(doc, minlength=len(words))
                total = summed(doc, bucket, len(words), planes, factors)
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(weight), pa.array(words >= MIN_WORDS)],
                                                 ["doc_id", "n_features", "weight", "able"])
    return run


#: Shorter documents cannot be drawn.
MIN_WORDS = 20


def weights(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_features, weight, able) per document; able: long enough to be drawn."""
    prepare(docs.sparkSession)
    gain = gains(docs, target)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        _weighing(gain), f"doc_id {kind}, n_features long, weight long, able boolean")


def scored(weighed: DataFrame, seed: int) -> DataFrame:
    """Adds score: the weight plus Gumbel noise from the seed and the id, in thousandths."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(float(1 << 32)))))
    return weighed.withColumn("score", F.col("weight") + noise)


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, and rank for those drawn, the
    ``percent`` % highest scores of the documents of at least MIN_WORDS words."""
    every = written(scored(weights(docs, target), seed), "resample")
    columns = ["doc_id", "n_features", "weight", "score"]
    able, total = ranked(every.where("able").select(*columns), [F.desc("score"), "doc_id", "n_features"], "resample-order")
    drawn = percent * total // 100
    able = able.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return able.unionByName(every.where("not able").select(*columns, F.lit(None).cast("long").alias("rank")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql_features(name: str) -> str:
    return f"""{name}_words AS (
  SELECT {'doc_id' if name == 'd' else 'item_id AS doc_id'}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {'documents' if name == 'd' else 'benchmark'}),
{name}_features AS (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM {name}_words),
{name}_counts AS (SELECT doc_id, f, count(*) AS c FROM {name}_features GROUP BY ALL)"""


#: The CRC is spelled out: a table of 256 remainders by its rule, then a fold over the bytes.
ORACLE = f"""
WITH {_sql_features('d')},
{_sql_features('b')},
remainders AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS r
  FROM range(256) AS t(i)),
hashed AS (
  SELECT f, xor(list_reduce(list_transform(range(octet_length(encode(f))), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, r[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT f FROM d_counts UNION SELECT f FROM b_counts), remainders),
s AS (SELECT bucket, sum(c) AS s FROM d_counts JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(c) AS t FROM b_counts JOIN hashed USING (f) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS s_all, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS t_all),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all + {BUCKETS}) / ((coalesce(s, 0)::DOUBLE + 1) * (t_all + {BUCKETS}))))::BIGINT AS gain
  FROM range({BUCKETS}) AS x(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), totals),
sums AS (
  SELECT doc_id, sum(c)::BIGINT AS n, sum(c * gain)::BIGINT AS g
  FROM d_counts JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
weighed AS (
  SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features,
    coalesce(CASE WHEN g % n < 0 THEN g // n - 1 ELSE g // n END, 0) AS weight
  FROM d_words d LEFT JOIN sums USING (doc_id)),
scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM weighed),
ordered AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS total FROM scored WHERE n_words >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= total * 25 // 100 THEN rank END AS rank
FROM scored LEFT JOIN ordered USING (doc_id)
"""
