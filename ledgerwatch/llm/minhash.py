"""Near-duplicate documents by MinHash, odd sketches and exact sets (operator 5).

Words are lower-cased runs of non-space; a document's set is its distinct runs
of five words. Equal sets are one class from the start. MinHash samples of each
class are banded for candidates and folded into a parity bitmap (odd sketch):
the population count of two bitmaps' XOR estimates their similarity, and only
pairs whose estimate is near the threshold or above go on to be confirmed on
their full sets.

A bucket is never expanded into all its pairs. Its members are first confirmed
against one hub, the class with the smallest document id. Then only members of
buckets that still hold more than one component are compared, across
components, in blocks of bounded size; a task unites what it finds linked and
passes on only the links that united something.

Defined results: a null or empty text, or one without words, has an empty set
and links with nothing; a text of fewer than five words is one shingle;
repeated rows are equal sets and link; further columns are ignored. A null id
takes part like any other and its component is the smallest non-null id.

Bands: 32 of 5 samples, so a pair at the threshold of 0.85 is no candidate
with a probability of (1 - 0.85^5)^32 = 7e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm import tokens as tk
from ledgerwatch.llm.common import prepare, table, told_apart, written
from ledgerwatch.llm.components import components

SHINGLE = 5
BANDS, ROWS = 32, 5
SAMPLES = BANDS * ROWS
BITS = 512
THRESHOLD = 85
#: Six standard deviations of the bitmap's estimate at the threshold.
SLACK = 0.17
#: Members of a bucket, and bytes of their sets, in one block.
BLOCK, BLOCK_BYTES = 2048, 16 << 20

_A = (tk.mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)
_B = tk.mix(np.arange(1001, SAMPLES + 1001, dtype=np.uint64)).astype(np.uint32)


def _sets(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    h, bounds = tk.shingles(tk.split(raw, offsets), SHINGLE)
    return [np.unique(h[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def _key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set: two sums over its differently mixed members."""
    if not len(s):
        return 0, 0
    n = np.uint64(len(s))
    one = tk.mix(np.array([tk.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + n]))[0]
    two = tk.mix(np.array([tk.mix(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64) ^ n]))[0]
    return int(one.view(np.int64)), int(two.view(np.int64))


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash samples (documents x SAMPLES) of non-empty sets."""
    x = np.concatenate(sets)
    x = (x ^ (x >> np.uint64(32))).astype(np.uint32)
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), SAMPLES), np.uint32)
    buf = np.empty_like(x)
    for i in range(SAMPLES):
        np.multiply(x, _A[i], out=buf)
        np.add(buf, _B[i], out=buf)
        buf ^= buf >> np.uint32(15)
        np.multiply(buf, np.uint32(0x2C1B3C6D), out=buf)
        out[:, i] = np.minimum.reduceat(buf, at)
    return out


def _bands(sig: np.ndarray) -> np.ndarray:
    s = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), s.shape[:2]).copy()
    for j in range(ROWS):
        h = tk.mix(h * np.uint64(0x9E3779B97F4A7C15) + s[:, :, j])
    return h


def _odd(sig: np.ndarray) -> np.ndarray:
    """Parity bitmaps: each sample flips one of BITS bits."""
    place = tk.mix(sig.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))) % np.uint64(BITS)
    flat = (place + np.arange(len(sig), dtype=np.uint64)[:, None] * np.uint64(BITS)).astype(np.int64).ravel()
    bits = np.bincount(flat, minlength=len(sig) * BITS).reshape(len(sig), BITS) & 1
    return np.packbits(bits.astype(np.uint8), axis=1)


def odd_similarity(differing: np.ndarray) -> np.ndarray:
    """Similarity estimate from the number of bits that differ."""
    share = np.minimum(1 - 2 * differing / BITS, 1)
    return np.where(share > 0, 1 + BITS / (4 * SAMPLES) * np.log(np.maximum(share, 1e-9)), -1.0)


#: Most differing bits that still pass the filter.
MAX_BITS = int(max(d for d in range(BITS // 2) if odd_similarity(np.array([d]))[0] >= THRESHOLD / 100 - SLACK))


def sketch(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, k1, k2 (the set's name), bands, odd. Empty sets have null names.
    Ids may be of any type that has an order."""
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_shingles long, k1 long, k2 long, bands array<long>, odd binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in tk.chunks(batch, "text", 1 << 20):
                sets = _sets(raw, offsets)
                sizes = np.array([len(s) for s in sets], np.int64)
                keys = [_key(s) if len(s) else (None, None) for s in sets]
                bands: list = [None] * len(sets)
                odd: list = [None] * len(sets)
                full = np.flatnonzero(sizes)
                if len(full):
                    sig = _signatures([sets[i] for i in full])
                    for i, b, o in zip(full, _bands(sig).view(np.int64), _odd(sig), strict=True):
                        bands[i], odd[i] = b, o.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), pa.array([k[0] for k in keys], pa.int64()),
                     pa.array([k[1] for k in keys], pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(odd, pa.binary())],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands", "odd"])

    prepare(documents.sparkSession)
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that reach the threshold on their full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            last, left = None, None
            for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"), strict=True)):
                x, y = x.as_buffer(), np.frombuffer(y.as_buffer(), np.uint64)
                if last is None or not x.equals(last):
                    last, left = x, np.frombuffer(x, np.uint64)
                small, big = (left, y) if len(left) < len(y) else (y, left)
                if 100 * len(small) < THRESHOLD * len(big):
                    continue
                at = np.searchsorted(big, small)
                at[at == len(big)] = 0
                both = int((big[at] == small).sum())
                keep[i] = 100 * both >= THRESHOLD * (len(small) + len(big) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    right = sets.select(F.col("k").alias("b"), F.col("items").alias("sb"))
    left = sets.select(F.col("k").alias("a"), F.col("items").alias("sa"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _full_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(k, items) of the wanted classes (k, doc_id), read from their documents' texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, raw, offsets in tk.chunks(batch, "text"):
                sets = _sets(raw, offsets)
                yield pa.RecordBatch.from_arrays([pa.array([_key(s)[0] for s in sets], pa.int64()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], names=["k", "items"])

    texts, _ = told_apart(documents.select(F.col("doc_id").alias("id"), "text"), F.col("id"), wanted, F.col("doc_id"), "wanted-bits")
    found = texts.join(wanted.select("doc_id").distinct(), F.col("id").eqNullSafe(F.col("doc_id")), "left_semi")
    return (found.select("text").mapInArrow(run, "k long, items binary")
            .join(wanted.select("k"), "k", "left_semi").dropDuplicates(["k"]))


def _sets_of(documents: DataFrame, classes: DataFrame, ks: DataFrame, step: str) -> DataFrame:
    wanted = written(ks.distinct().join(classes.select("k", "doc_id"), "k"), f"wanted-{step}")
    return written(_full_sets(documents, wanted), f"sets-{step}")


def _near(pairs: DataFrame, odd: DataFrame) -> DataFrame:
    """Pairs whose bitmaps differ in few enough bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(n, -1) for c in ("oa", "ob"))
                keep = np.bitwise_count(x ^ y).sum(axis=1) <= MAX_BITS
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    right = odd.select(F.col("k").alias("b"), F.col("odd").alias("ob"))
    left = odd.select(F.col("k").alias("a"), F.col("odd").alias("oa"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "oa", "ob").mapInArrow(run, "a long, b long")


class _Members:
    """Members of one bucket (of one pair of its blocks): who is near whom across components."""

    def __init__(self, rows: pa.Table):
        self.k, comp, blk = (rows.column(c).to_numpy() for c in ("k", "comp", "blk"))
        self.n = rows.column("n").to_numpy()
        self.odd = np.frombuffer(b"".join(rows.column("odd").to_pylist()), np.uint64).reshape(len(self.k), -1)
        self.bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(self.k), -1)
        self.bucket, lo, hi = (rows.column(c)[0].as_py() for c in ("bucket", "lo", "hi"))
        self.first = int(np.argmax(self.bands[0] == self.bucket))
        self.label = np.unique(comp, return_inverse=True)[1]
        self.lower, self.upper, self.same = np.flatnonzero(blk == lo), np.flatnonzero(blk == hi), lo == hi

    def near(self, i: int) -> np.ndarray:
        """Members of other components, nearest first, whose bitmaps are near that of i and
        that share no earlier band with it."""
        js = self.upper[self.upper > i] if self.same else self.upper
        js = js[self.label[js] != self.label[i]]
        apart = np.bitwise_count(self.odd[js] ^ self.odd[i]).sum(axis=1)
        small, big = np.minimum(self.n[js], self.n[i]), np.maximum(self.n[js], self.n[i])
        keep = (apart <= MAX_BITS) & (100 * small >= THRESHOLD * big)
        js, apart = js[keep], apart[keep]
        if self.first:
            new = ~(self.bands[js, :self.first] == self.bands[i, :self.first]).any(axis=1)
            js, apart = js[new], apart[new]
        return js[np.argsort(apart, kind="stable")]


def _involved(rows: pa.Table) -> list[tuple[int, int]]:
    """(bucket, k) of the members that are near one of another component."""
    m, out = _Members(rows), set()
    for i in m.lower:
        js = m.near(i)
        if len(js):
            out.update([i, *js.tolist()])
    return [(m.bucket, int(m.k[i])) for i in sorted(out)]


def _links(rows: pa.Table) -> list[tuple[int, int]]:
    """Confirmed links (a, b), as many as unite what is linked. Full sets are compared only
    while an earlier link has not united the two."""
    m, out = _Members(rows), []
    items = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("items")]
    for i in m.lower:
        js = m.near(i)
        step = 4  # the nearest first: a link there settles the rest of its component
        while len(js):
            now, js = js[:step], js[step:]
            flat = np.concatenate([items[j] for j in now])
            at = np.searchsorted(items[i], flat)
            at[at == m.n[i]] = 0
            both = np.add.reduceat((items[i][at] == flat).astype(np.int64), np.concatenate(([0], np.cumsum(m.n[now])[:-1])))
            for j in now[100 * both >= THRESHOLD * (m.n[i] + m.n[now] - both)]:
                if m.label[j] != m.label[i]:
                    out.append((int(m.k[i]), int(m.k[j])))
                    m.label[m.label == m.label[j]] = m.label[i]
            js = js[m.label[js] != m.label[i]]
            step = min(4 * step, 256)
    return out


def _by_blocks(members: DataFrame, find, names: tuple[str, str]) -> DataFrame:
    """Pairs that ``find`` returns for each two blocks of each bucket. members: bucket, blocks,
    k, comp, n, odd, bands and what find needs. A task holds two blocks, of bounded size."""
    columns = [c for c in members.columns if c not in ("bucket", "blocks")]
    m = members.withColumn("blk", F.pmod(F.xxhash64("k", F.lit(7)), F.col("blocks")).cast("int"))
    # Each member meets every block of its bucket: (lower block, upper block).
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
    m = m.select("bucket", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"), "blk", *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            found = find(pa.Table.from_batches(held))
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=list(names))

        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "lo", "hi")), strict=True))
            at = 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[at]:
                    if held and now != keys[at]:
                        yield flush(held)
                        held = []
                    now = keys[at]
                    held.append(batch.slice(at, i - at))
                    at = i
        if held:
            yield flush(held)

    return (m.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
            .mapInArrow(run, f"{names[0]} long, {names[1]} long").distinct())


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of documents, and k1: the set's name."""
    rows = written(sketch(documents), "sketch")
    classes = written(rows.where("k1 is not null").groupBy("k1", "k2")
                      .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("odd").alias("odd"))
                      .withColumnRenamed("k1", "k"), "classes")
    banded = classes.select("k", "doc_id", F.explode("bands").alias("bucket"))
    hubs = (banded.groupBy("bucket").agg(F.min_by("k", "doc_id").alias("hub"), F.min("k").alias("some"), F.count(F.lit(1)).alias("size"))
            .where("size > 1").select("bucket", F.coalesce("hub", "some").alias("a"), "size"))
    shared = written(banded.select("bucket", "k").join(written(hubs, "hubs"), "bucket"), "shared")

    near = written(_near(shared.where("a <> k").select("a", F.col("k").alias("b")).distinct(), classes.select("k", "odd")), "near")
    sets = _sets_of(documents, classes, near.select(F.col("a").alias("k")).union(near.select("b")), "star")
    star = written(_confirm(near, sets), "links")
    comp = components(star.select(F.col("a").alias("u"), F.col("b").alias("v")), "star")
    # Buckets of three or more that more than one component shares: members other than the hub
    # haven't met each other yet. By their bitmaps most need no look at the full sets.
    labelled = (shared.where("size > 2").join(comp.withColumnRenamed("node", "k"), "k", "left")
                .select("bucket", "k", F.coalesce("component", "k").alias("comp")))
    labelled = written(labelled, "labelled")
    mixed = (labelled.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("size"))
             .where("x <> y").select("bucket", F.ceil(F.col("size") / BLOCK).alias("blocks")))
    members = (labelled.join(written(mixed, "mixed"), "bucket").join(classes.select("k", "n", "odd", "bands"), "k"))
    involved = written(_by_blocks(members, _involved, ("bucket", "k")), "involved")
    left = written(labelled.join(involved, ["bucket", "k"], "left_semi").join(classes.select("k", "n", "odd", "bands"), "k"), "left")
    sizes = left.groupBy("bucket").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).alias("blocks"))
    # Most of them were read for the hubs' pairs already.
    missing = left.select("k").distinct().join(sets.select("k"), "k", "left_anti")
    sets = sets.unionByName(_sets_of(documents, classes, missing, "open"))
    rest = written(_by_blocks(left.join(written(sizes, "sizes"), "bucket").join(sets, "k"), _links, ("a", "b")), "open")
    every = star.unionByName(rest).select(F.col("a").alias("u"), F.col("b").alias("v"))
    final = components(every, "all") if rest.take(1) else comp
    named = (classes.select("k", "doc_id").join(final.withColumnRenamed("node", "k"), "k", "left")
             .select("k", "doc_id", F.coalesce("component", "k").alias("comp")))
    named = written(named, "named")
    least = written(named.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "least")
    ids = written(named.join(least, "comp").select(F.col("k").alias("k1"), "component_id"), "ids")
    out = rows.select("doc_id", "n_shingles", "k1").join(ids, "k1", "left")
    component = F.when(F.col("k1").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "k1")


def op5_minhash_odd_sketch(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("k1")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, the one with the smallest id; documents without a
    set all stay. A row is told by its id and text, so rows that share an id (or have none) go or
    stay each by their own text; of equal rows one stays."""
    # Missing ids come last.
    row = F.struct(F.isnull("doc_id").alias("none"), "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text"))
    found = near_duplicates(docs.select(row.alias("doc_id"), "text")).where("k1 is not null")
    dropped = written(found.where("not kept").select(F.col("doc_id").alias("row")).distinct(), "dropped")
    again = written(found.where("kept").groupBy(F.col("doc_id").alias("row")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row"), "again")

    def among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        # The caller's columns travel in one struct, so no name of theirs meets one of these.
        some, others = told_apart(rows.select(F.struct("*").alias("doc"), row.alias("own")), F.col("own"), keys, F.col("row"), "row-bits")
        held = some.join(keys, F.col("own").eqNullSafe(F.col("row")), how)
        if how == "left_anti":
            held = held.unionByName(others)
        return held.select(*[F.col("doc")[c].alias(c) for c in docs.columns])

    rest = among(docs, dropped, "left_anti")
    if not again.take(1):
        return rest
    return among(rest, again, "left_anti").unionByName(among(rest, again, "left_semi").dropDuplicates(["doc_id", "text"]))
