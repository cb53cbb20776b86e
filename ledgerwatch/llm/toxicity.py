"""Toxicity by nearest labelled examples (operator 2).

All terms of the labelled sample are features. A text is its TF-IDF vector over
them, document frequencies being counted over all documents; a term weighs more
the more the sample ties it to either class (chi-square). Each text takes part in
a vote of its nearest labelled examples by exact cosine. They come from a block-max
inverted index: examples of like terms lie in blocks; of a text's long lists that add
least only the greatest weight in each block is looked at first, and those blocks are opened
whose bound reaches the nearest examples found.
Votes weigh by distance, and by how many labelled rows of its class an example
stands for; they are calibrated on leave-one-out votes of the examples themselves.

Defined results: a null or empty text, and a text without any feature, has no
neighbours and gets the calibrated prior; equal similarities go to the smaller
example number; a label table without rows of both classes gives every text the
observed (or one half) prior below 0.5; repeated rows are scored alike; of the texts
of a repeated labelled id the least term vector is the example; further
columns of either table are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm import tokens as tk
from ledgerwatch.llm.common import fold, prepare, table

#: Examples kept per class: the documented bound of the labelled sample.
MAX_EXAMPLES = 3000
#: Chi-square from which a term has its full weight, and the share of it that any term has.
FULL_CHI2 = 30.0
LEAST_WEIGHT = 0.05
NEIGHBOURS = 15
#: Examples in a block of the index.
BLOCK = 8
#: Lists whose greatest contributions sum up to this share of the bound are left to the blocks.
BOUNDED = 0.2
#: A vote has this much of the prior in it.
PRIOR_WEIGHT = 0.25


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first[i] .. first[i] + size[i] - 1 of each i, one after the other."""
    return np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)


class Index:
    """Block-max inverted index over unit vectors of the examples."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]],
                 labels: np.ndarray, ids: np.ndarray, weights: np.ndarray | None = None):
        self.terms, self.idf = terms, idf
        n = len(ids)
        dense = [self.unit(*v) for v in vectors]
        # Examples of the same heaviest terms share blocks, so the bounds tell blocks apart.
        heavy = np.full((n, 3), -1)
        for i, (t, w) in enumerate(dense):
            best = t[np.lexsort((t, -w))[:3]]
            heavy[i, :len(best)] = best
        order = np.lexsort((np.arange(n), *heavy.T[::-1]))
        dense = [dense[i] for i in order]
        self.labels, self.ids = labels[order].astype(float), ids[order]
        #: Labelled rows that an example of the bounded sample stands for, one on average.
        self.stands = (np.ones(n) if weights is None or not n else weights / weights.mean())[order]
        # Postings of all terms, by term and example.
        term = np.concatenate([t for t, _ in dense] or [np.zeros(0, np.int64)])
        row = np.repeat(np.arange(n), [len(t) for t, _ in dense])
        by = np.lexsort((row, term))
        term, row = term[by], row[by]
        self.rows = row.astype(np.int32)
        self.weights = np.concatenate([w for _, w in dense] or [np.zeros(0)])[by]
        # A cell is a term's postings in one block: those of cell c are start[c]:start[c + 1], and
        # the cells of term t are cells[t]:cells[t + 1].
        self.blocks = -(-n // BLOCK)
        self.heads = np.arange(0, n, BLOCK)
        #: Lists of so many postings at most have less than one a block and are read whole.
        self.short = n // BLOCK
        cut = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (row[1:] // BLOCK != row[:-1] // BLOCK))[:len(term)])
        self.start = np.append(cut, len(term)).astype(np.int32)
        self.block = (row[cut] // BLOCK).astype(np.int32)
        self.most = np.maximum.reduceat(self.weights, cut) if len(cut) else np.zeros(0)
        #: The greatest weight of each term.
        self.top = np.zeros(len(terms))
        np.maximum.at(self.top, term[cut], self.most)
        self.cells = np.searchsorted(term[cut], np.arange(len(terms) + 1)).astype(np.int32)
        self.prior = float(np.average(self.labels, weights=self.stands)) if n else 0.0
        self.slope, self.shift = 1.0, 0.0
        self.seen: dict = {}
        #: Blocks opened and postings read so far.
        self.opened = self.read = 0

    def unit(self, t: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1.0 + np.log(tf)) * self.idf[t]
        norm = math.sqrt(float(w @ w)) if len(w) else 0.0
        return (t, w / norm) if norm > 0 else (t[:0], w[:0])

    @staticmethod
    def kth(cos: np.ndarray, k: int) -> float:
        return float(np.partition(cos, len(cos) - k)[len(cos) - k]) if len(cos) >= k else 0.0

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(example rows, cosines) of the k nearest with a cosine above zero."""
        first, size = self.start[self.cells[t]], self.start[self.cells[t + 1]] - self.start[self.cells[t]]
        # Long lists that add least are bounded by block; all others are read whole.
        gain = w * self.top[t]
        by = np.argsort(gain, kind="stable")
        small = np.empty(len(t), bool)
        small[by] = np.cumsum(gain[by]) <= BOUNDED * gain.sum()
        short = ~small | (size <= self.short)
        place = _ranges(first[short], size[short])
        cos = np.bincount(self.rows[place], self.weights[place] * np.repeat(w[short], size[short]), len(self.ids)).astype(float)
        if skip >= 0:
            cos[skip] = 0.0
        self.read += len(place)
        least = self.kth(cos, k)
        t, w = t[~short], w[~short]
        size = self.cells[t + 1] - self.cells[t]
        cell, weight = _ranges(self.cells[t], size), np.repeat(w, size)
        block = self.block[cell]
        bound = np.bincount(block, self.most[cell] * weight, self.blocks).astype(float)
        if self.blocks:
            bound[bound > 0] += np.maximum.reduceat(cos, self.heads)[bound > 0]
        # The blocks of the highest bounds first; then all that could still hold a nearer one.
        todo, some = np.flatnonzero(bound), -(-k // BLOCK) + 1
        best = todo[np.argpartition(-bound[todo], some)[:some]] if len(todo) > some else todo
        for turn in range(2):
            now = best if turn == 0 else todo[bound[todo] >= least - 1e-11]
            chosen = np.zeros(self.blocks, bool)
            chosen[now] = True
            if turn:
                chosen[best] = False
            opens = np.flatnonzero(chosen[block])
            first = self.start[cell[opens]]
            size = self.start[cell[opens] + 1] - first
            place = _ranges(first, size)
            cos += np.bincount(self.rows[place], self.weights[place] * np.repeat(weight[opens], size), len(cos))
            if skip >= 0:
                cos[skip] = 0.0
            self.opened, self.read = self.opened + int(chosen.sum()), self.read + len(place)
            least = self.kth(cos, k)
        rows = np.flatnonzero((cos > 0) & (cos >= least - 1e-11))
        rows = rows[np.lexsort((rows, -np.round(cos[rows], 12)))[:k]]
        return rows, np.minimum(cos[rows], 1.0)

    def vote(self, t: np.ndarray, w: np.ndarray, skip: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        rows, cos = self.nearest(t, w, NEIGHBOURS, skip) if len(t) else (np.zeros(0, np.int64), np.zeros(0))
        # By Euclidean distance; what shares next to nothing with the text has next to no vote.
        weight = self.stands[rows] * cos ** 2 / (0.1 + np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cos)))
        return (float(weight @ self.labels[rows]) + PRIOR_WEIGHT * self.prior) / (float(weight.sum()) + PRIOR_WEIGHT), rows, cos

    def calibrate(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Platt scaling on leave-one-out votes of the examples (in index order)."""
        v = np.array([self.vote(*x, skip=i)[0] for i, x in enumerate(vectors)])
        if len(v) == 0 or self.labels.min() == self.labels.max():
            return
        x, y, w = _logit(v), self.labels, self.stands
        n1 = y.sum()
        goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))
        a, b = 1.0, 0.0
        for _ in range(60):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-(a * x + b)))
            g = np.array([(w * (p - goal) * x).sum() + 1e-3 * (a - 1), (w * (p - goal)).sum() + 1e-3 * b])
            r = w * p * (1 - p)
            h = np.array([[(r * x * x).sum() + 1e-3, (r * x).sum()], [(r * x).sum(), r.sum() + 1e-3]])
            step = np.linalg.solve(h, g)
            a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
            if np.abs(step).max() < 1e-9:
                break
        if a > 0:
            self.slope, self.shift = a, b

    def score(self, t: np.ndarray, tf: np.ndarray) -> tuple[float, list[int], list[float]]:
        key = (t.tobytes(), tf.tobytes())
        if key not in self.seen:
            if len(self.seen) >= 4_000:
                self.seen.clear()
            v, rows, cos = self.vote(*self.unit(t, tf))
            z = self.slope * float(_logit(np.array([v]))[0]) + self.shift
            self.seen[key] = (1 / (1 + math.exp(-max(-500.0, min(500.0, z)))), self.ids[rows].tolist(), cos.tolist())
        return self.seen[key]


def _logit(v: np.ndarray) -> np.ndarray:
    v = np.clip(v, 1e-4, 1 - 1e-4)
    return np.log(v / (1 - v))


def _counts(raw: np.ndarray, offsets: np.ndarray, terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(term numbers, counts) of each document over the sorted term hashes."""
    words = tk.split(raw, offsets, tk.ALNUM)
    at = np.searchsorted(terms, words.hash)
    at[at == len(terms)] = 0
    hit = np.flatnonzero(terms[at] == words.hash) if len(terms) else np.zeros(0, np.int64)
    bounds = np.searchsorted(hit, words.bounds)
    none = np.zeros(0, np.int64)
    for d in range(len(offsets) - 1):
        if bounds[d] == bounds[d + 1]:
            yield none, none
        else:
            yield np.unique(at[hit[bounds[d]:bounds[d + 1]]], return_counts=True)


def usable_labels(labels: DataFrame) -> DataFrame:
    return (labels.where("doc_id is not null and toxic in (0, 1)").where(fold("doc_id", 5) != 0)
            .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
            .where("toxic = other").select("doc_id", "toxic"))


def labelled_sample(labels: DataFrame, most: int = MAX_EXAMPLES) -> DataFrame:
    """(doc_id, toxic) of at most ``most`` rows per class, the same rows at any run:
    the least by a hash of the id. Rows in the held-out fold, without an id, or
    with contradicting labels are no examples."""
    rows = usable_labels(labels)
    parts = [rows.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in (0, 1)]
    return parts[0].unionByName(parts[1])


def fit(documents: DataFrame, labels: DataFrame) -> Index:
    """Features, document frequencies over all documents, and the example index."""
    spark = documents.sparkSession
    prepare(spark)
    docs = documents.select("doc_id", "text")
    sample = {r.doc_id: r.toxic for r in labelled_sample(labels).collect()}  # at most 2 x MAX_EXAMPLES rows
    found = spark.createDataFrame(list(sample.items()) or [(None, None)], "doc_id long, toxic int").where("doc_id is not null")
    # The side broadcast here is the bounded sample.
    examples = docs.join(F.broadcast(found), "doc_id")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in tk.chunks(batch, "text"):
                words = tk.split(raw, offsets, tk.ALNUM)
                for toxic in (0, 1):
                    own = [np.unique(words.hash[a:b]) for a, b, y in
                           zip(words.bounds, words.bounds[1:], part.column("toxic").to_pylist(), strict=False) if y == toxic]
                    if own:
                        term, n = np.unique(np.concatenate(own), return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(np.full(len(n), toxic)), pa.array(n)],
                                                         names=["term", "toxic", "n"])

    sizes = {r.toxic: r.n for r in examples.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    per = (examples.mapInArrow(distinct, "term long, toxic long, n long").groupBy("term")
           .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
                F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b")))
    a, b, n = F.col("a"), F.col("b"), float(n0 + n1)
    chi2 = n * F.pow(a * float(n0) - b * float(n1), 2.0) / ((a + b) * (n - a - b) * float(n0 * n1 or 1))
    known = F.when((a + b) < n, chi2).otherwise(0.0) if n0 and n1 else F.lit(0.0)
    # As many rows as the bounded sample has terms.
    chosen = per.select("term", known.cast("double").alias("chi2")).toArrow()
    terms = chosen.column("term").to_numpy().view(np.uint64)
    order = np.argsort(terms)
    terms, tie = terms[order], chosen.column("chi2").to_numpy()[order]

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(len(terms) + 1, np.int64), 0
        for batch in batches:
            for _, raw, offsets in tk.chunks(batch, "text"):
                for t, _ in _counts(raw, offsets, terms):
                    df[t] += 1
            df[-1] += batch.num_rows
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

    df = np.zeros(len(terms) + 1, np.int64)  # the sample's terms; the last counts the documents
    counted = docs.select("text").mapInArrow(frequency, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df[counted.column("term").to_numpy()] = counted.column("df").to_numpy()
    # Terms that tell the classes apart weigh most, but none is without weight.
    idf = (np.log((1.0 + df[-1]) / (1.0 + df[:-1])) + 1.0) * (LEAST_WEIGHT + (1 - LEAST_WEIGHT) * np.minimum(1.0, tie / FULL_CHI2))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in tk.chunks(batch, "text"):
                got = list(_counts(raw, offsets, terms))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("toxic"), pa.array([t.tolist() for t, _ in got], pa.list_(pa.int32())),
                     pa.array([c.tolist() for _, c in got], pa.list_(pa.int32()))], names=["doc_id", "toxic", "terms", "counts"])

    rows = (examples.mapInArrow(vectors, "doc_id long, toxic int, terms array<int>, counts array<int>")
            .groupBy("doc_id").agg(F.min(F.struct("terms", "counts", "toxic")).alias("v")).select("doc_id", "v.*")
            .orderBy("doc_id").collect())  # bounded as the sample is
    vec = [(np.array(r.terms, dtype=np.int64), np.array(r.counts, dtype=np.int64)) for r in rows]
    y = np.array([r.toxic for r in rows], dtype=float)
    whole = {r.toxic: r.n for r in usable_labels(labels).groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = Counter(sample.values())
    stands = np.array([whole[r.toxic] / taken[r.toxic] for r in rows])
    index = Index(terms, idf, vec, y, np.array([r.doc_id for r in rows], dtype=np.int64), stands)
    place = {int(d): i for i, d in enumerate(index.ids)}
    ordered: list = [None] * len(rows)
    for r, v in zip(rows, vec, strict=True):
        ordered[place[r.doc_id]] = index.unit(*v)
    index.calibrate(ordered)
    return index


def score(documents: DataFrame, index: Index) -> DataFrame:
    """doc_id, score, and the evidence: ids and cosines of the voting examples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in tk.chunks(batch, "text"):
                got = [index.score(t, c) for t, c in _counts(raw, offsets, index.terms)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([x[0] for x in got], pa.float64()),
                     pa.array([x[1] for x in got], pa.list_(pa.int64())), pa.array([x[2] for x in got], pa.list_(pa.float64()))],
                    names=["doc_id", "score", "neighbours", "cosines"])

    prepare(documents.sparkSession)
    return (documents.select("doc_id", "text")
            .mapInArrow(run, "doc_id long, score double, neighbours array<long>, cosines array<double>"))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours", "cosines")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half; clean ones stay. The score travels
    with the row, so repeated ids need no join back."""
    index = fit(docs, table(spark, sf_dir, "labels"))
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in tk.chunks(batch, "text"):
                keep = [index.score(t, c)[0] < 0.5 for t, c in _counts(raw, offsets, index.terms)]
                yield part.filter(pa.array(keep, pa.bool_())).select(columns)

    return docs.mapInArrow(run, docs.schema)
