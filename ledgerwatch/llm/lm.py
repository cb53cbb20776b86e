"""Language-model scores by deleted interpolation (operator 8).

A text's tokens are its words and one end. The model mixes maximum-likelihood
bigrams and unigrams of the training texts with a uniform rest; the three
weights depend on how often the context was seen (buckets of powers of two) and
are learned by expectation-maximisation on held-out counts: each training token
is scored by the counts that remain when it is deleted.

Texts are worked on in blocks of many documents. A block sends its distinct
word and bigram hashes, sorted and cut by hash range, with its training counts;
a task per range adds the counts of all blocks and answers each block, whose
answers line up with its own sorted hashes. So a key is sent once per block
however often it occurs, no vocabulary is ever in one place, and what a task
holds is bounded by the block and range sizes. Blocks are formed anew for each
pass from the same scan; sums of their hashes travel along, and a block that
came out different stops the job.

Defined results: a null or empty text is one end token; a null id folds as the
empty text; without training texts every count is zero; repeated rows count
and score as rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm import tokens as tk
from ledgerwatch.llm.common import fold, prepare, table, written

BLOCK_BYTES = 16 << 20
RANGE_BYTES = 16 << 20
#: Tokens of a block that are scored at a time, and keys in one batch that is sent, about.
SLICE_TOKENS, SENT_KEYS = 1 << 18, 1 << 19
#: Buckets of the context's count: unseen, 1, 2-3, 4-7, ...
BUCKETS = 40

_END = tk.mix(np.array([0xE0D], np.uint64))[0]
_BEGIN = tk.mix(np.array([0xB05], np.uint64))[0]
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Block(NamedTuple):
    tokens: np.ndarray   # word hashes, each document's followed by the end
    bigrams: np.ndarray  # hash of (previous token or begin, token)
    bounds: np.ndarray   # tokens of document d are bounds[d]:bounds[d + 1]


def block_of(texts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Block:
    """The token block of (bytes, offsets) chunks of whole documents."""
    tokens, bigrams, sizes = [], [], []
    for raw, offsets in texts:
        w = tk.split(raw, offsets)
        t = np.insert(w.hash, w.bounds[1:], _END)
        size = np.diff(w.bounds) + 1
        context = np.empty_like(t)
        context[1:] = t[:-1]
        context[np.cumsum(size) - size] = _BEGIN
        tokens.append(t)
        bigrams.append(tk.mix(tk.mix(context) + t * _ODD))
        sizes.append(size)
    bounds = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    return Block(np.concatenate(tokens), np.concatenate(bigrams), bounds)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the place of each key among them (numpy's unique with half the memory)."""
    order = np.argsort(keys)
    u = keys[order]
    head = np.ones(len(u), bool)
    np.not_equal(u[1:], u[:-1], out=head[1:])
    u = u[head]
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(head, dtype=np.int32) - np.int32(1)
    return u, place


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """(block number, batches of its documents). Cuts depend on the documents only, not on
    how they came in batches."""
    base, no, held, size = TaskContext.get().partitionId() << 32, 0, [], 0
    for batch in batches:
        _, offsets = tk.texts(batch.column("text"))
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES - size, "right"))
            stop = min(batch.num_rows, max(at + 1, stop))
            held.append(batch.slice(at, stop - at))
            size += int(offsets[stop] - offsets[at])
            at = stop
            if size >= BLOCK_BYTES:
                yield base + no, held
                no, held, size = no + 1, [], 0
    if held:
        yield base + no, held


def _pack(keys: np.ndarray) -> bytes:
    """Bytes of sorted keys by significance, so that their equal high bytes compress."""
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


_ASKED = "part long, kind int, block long, keys binary, counts binary"
_ANSWER = "block long, kind int, part long, counts binary, asked decimal(20,0), types long, total long"


def _ask(parts: int):
    """Each block's distinct keys and training counts, cut by hash range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([(i << 64) // parts for i in range(1, parts)], dtype=np.uint64)
        for no, held in _blocks(batches):
            block = block_of(x[1:] for b in held for x in tk.chunks(b, "text"))
            train = np.concatenate([b.column("train").to_numpy(zero_copy_only=False) for b in held]).astype(bool)
            trained = np.repeat(train, np.diff(block.bounds))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            todo = [block.bigrams, block.tokens]
            del block
            for kind in (0, 1):
                u, inverse = _distinct(todo.pop())
                n = np.bincount(inverse[trained], minlength=len(u)).astype(np.uint32)
                del inverse
                cuts = [0, *np.searchsorted(u, edges).tolist(), len(u)]
                some = [(p, a, b) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
                step = max(1, len(some) * SENT_KEYS // len(u))
                for i in range(0, len(some), step):
                    rows = [(p, kind, no, _pack(u[a:b]), n[a:b].tobytes()) for p, a, b in some[i:i + step]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                     names=["part", "kind", "block", "keys", "counts"])

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by part and kind: the whole corpus' counts of each block's keys, in its order."""
    def flush(key: tuple[int, int], rows: list[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        keys = [_unpack(r[1]) for r in rows]
        u, inverse = _distinct(np.concatenate(keys))
        counts = np.bincount(inverse, weights=np.concatenate([np.frombuffer(r[2], np.uint32) for r in rows]), minlength=len(u))
        ends = np.cumsum([len(k) for k in keys])
        out = []
        for i, r in enumerate(rows):
            own = counts[inverse[ends[i] - len(keys[i]):ends[i]]].astype(np.uint64)
            small = own.astype(np.uint32).tobytes() if own.max() < 1 << 32 else own.tobytes() + b"8"
            # The first answer of a group also says what the group adds to the whole.
            out.append((r[0], key[1], key[0], small, int(keys[i].sum(dtype=np.uint64)), int((counts > 0).sum()) if i == 0 else 0,
                        int(counts.sum()) if i == 0 else 0))
        for i in range(0, len(out), 64):
            cols = list(zip(*out[i:i + 64], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary()),
                 pa.array(cols[4], pa.decimal128(20, 0)), pa.array(cols[5], pa.int64()), pa.array(cols[6], pa.int64())],
                names=["block", "kind", "part", "counts", "asked", "types", "total"])

    now, held = None, []
    for batch in batches:
        for part, kind, block, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "block", "keys", "counts")), strict=True):
            if now is not None and now != (part, kind):
                yield from flush(now, held)
                held = []
            now = (part, kind)
            held.append((block, keys, counts))
    if held:
        yield from flush(now, held)


def _tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's documents, some at a time as compressed Arrow, in the answers' columns (kind 2)."""
    for no, held in _blocks(batches):
        packed = []
        for b in held:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(b)
            packed.append(sink.getvalue().to_pybytes())
        n = len(packed)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, no)), pa.array(np.full(n, 2, np.int32)), pa.array(np.arange(n)), pa.array(packed, pa.binary()),
             pa.nulls(n, pa.decimal128(20, 0))], names=["block", "kind", "part", "counts", "asked"])


class Counts(NamedTuple):
    """Training counts of a block's tokens."""
    ids: list
    train: np.ndarray
    bounds: np.ndarray
    token: np.ndarray
    context: np.ndarray
    bigram: np.ndarray

    def slices(self) -> Iterator[Counts]:
        """Some documents at a time, their counts as doubles."""
        at = 0
        while at < len(self.ids):
            stop = max(at + 1, int(np.searchsorted(self.bounds, self.bounds[at] + SLICE_TOKENS, "right")) - 1)
            a, b = self.bounds[at], self.bounds[stop]
            yield Counts(self.ids[at:stop], self.train[at:stop], self.bounds[at:stop + 1] - a,
                         *(x[a:b].astype(np.float64) for x in (self.token, self.context, self.bigram)))
            at = stop


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[Counts]:
    """Blocks whose answers came first, then their documents."""
    now, answers, held = None, ([], []), []

    def flush() -> Counts:
        block = block_of(x[1:] for b in held for x in tk.chunks(b, "text"))
        bounds, todo, found = block.bounds, [block.bigrams, block.tokens], []
        del block
        for got in answers:
            u, inverse = _distinct(todo.pop())
            counts = np.concatenate([np.frombuffer(c[:-1], np.uint64) if len(c) % 4 else np.frombuffer(c, np.uint32) for c, _ in got])
            if len(counts) != len(u) or sum(a for _, a in got) % (1 << 64) != int(u.sum(dtype=np.uint64)):
                raise RuntimeError("the documents were scanned in another order than before; the input has changed")
            del u
            found.append(counts[inverse])
            del inverse
            got.clear()
        token, bigram = found
        context = np.empty_like(token)
        context[1:] = token[:-1]
        # As many documents begin as end.
        context[bounds[:-1]] = token[bounds[1:] - 1]
        ids = [x for b in held for x in b.column("doc_id").to_pylist()]
        train = np.concatenate([b.column("train").to_numpy(zero_copy_only=False) for b in held]).astype(bool)
        held.clear()
        return Counts(ids, train, bounds, token, context, bigram)

    for batch in batches:
        if not batch.num_rows:
            continue
        blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
        change = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        edges = [0, *change.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if now != blocks[a]:
                if held:
                    yield flush()
                now, answers, held = blocks[a], ([], []), []
            part = batch.slice(a, b - a)
            if kinds[a] == 2:
                held.extend(x for data in part.column("counts").to_pylist() for x in pa.ipc.open_stream(data))
            else:
                answers[kinds[a]].extend(zip(part.column("counts").to_pylist(), map(int, part.column("asked").to_pylist()), strict=True))
    if held:
        yield flush()


def bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context)[1], BUCKETS - 1)


def _cells(total: float):
    """Held-out statistics: training tokens by bucket and by the size of their deleted
    estimates (quarter octaves), with the sums of the estimates. The cells are a bounded set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = lambda p: np.where(p > 0, 1 + np.minimum(-4 * np.log2(np.where(p > 0, p, 1)), 250).astype(np.int64), 0)
        for block in _resolved(batches):
            n = np.zeros(BUCKETS << 16, np.int64)
            s2, s1 = np.zeros(len(n)), np.zeros(len(n))
            for c in block.slices():
                own = np.repeat(c.train, np.diff(c.bounds))
                context, two, one = c.context[own] - 1, c.bigram[own] - 1, c.token[own] - 1
                p2 = np.where(context > 0, two / np.maximum(context, 1), 0.0)
                p1 = one / max(total - 1, 1.0)
                cell = (bucket(context) * 256 + size(p2)) * 256 + size(p1)
                np.add.at(n, cell, 1)
                np.add.at(s2, cell, p2)
                np.add.at(s1, cell, p1)
            cell = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n[cell]), pa.array(s2[cell]), pa.array(s1[cell])], names=["cell", "n", "p2", "p1"])

    return run


def weights(cells: list[tuple[int, int, float, float]], types: int, steps: int = 100) -> np.ndarray:
    """(bigram, unigram, uniform) weights per bucket by expectation-maximisation. A bucket
    without held-out tokens takes those of the bucket below."""
    out = np.zeros((BUCKETS, 3))
    p0 = 1.0 / (types + 1)
    last = np.array([0.0, 0.5, 0.5])
    for b in range(BUCKETS):
        own = [(n, s2 / n, s1 / n) for cell, n, s2, s1 in sorted(cells) if cell >> 16 == b]
        if own:
            n = np.array([x[0] for x in own], dtype=float)
            p = np.array([[x[1], x[2], p0] for x in own])
            w = np.array([0.4, 0.4, 0.2]) if b else np.array([0.0, 0.6, 0.4])
            for _ in range(steps):
                share = p * w
                share /= share.sum(axis=1, keepdims=True)
                w = n @ share + np.array([0.0, 0.0, 1.0])  # one more uniform token keeps the rest above zero
                w /= w.sum()
            last = w
        out[b] = last
    return out


def _scores(total: float, types: int, mix: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in (x for block in _resolved(batches) for x in block.slices()):
            at = c.bounds[:-1]
            w = mix[bucket(c.context)]
            p2 = np.where(c.context > 0, c.bigram / np.maximum(c.context, 1), 0.0)
            p = w[:, 0] * p2 + w[:, 1] * c.token / max(total, 1.0) + w[:, 2] / (types + 1)
            base = np.log10((c.token + 1) / (total + types + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.ids, pa.int64()), pa.array(~c.train), pa.array(np.diff(c.bounds)), pa.array(np.add.reduceat((c.token > 0).astype(np.int64), at)),
                 pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(np.log10(p), at))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def score(documents: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. ``held_out`` is a
    boolean column of documents; the other rows are the training texts."""
    spark = documents.sparkSession
    prepare(spark)
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (~held_out).alias("train"))
    size = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    # Keys take about as many bytes as the texts they come from.
    parts = max(1, math.ceil(size / RANGE_BYTES))
    answers = (docs.mapInArrow(_ask(parts), _ASKED).repartition("part").sortWithinPartitions("part", "kind", "block")
               .mapInArrow(_answer, _ANSWER))
    answers = written(answers, "lm-answers")
    known = answers.where("kind = 0").agg(F.coalesce(F.sum("types"), F.lit(0)).alias("types"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")).first()
    types, total = int(known.types), float(known.total)
    tagged = docs.mapInArrow(_tagged, "block long, kind int, part long, counts binary, asked decimal(20,0)")
    # The documents come first in the union: their partitions keep the numbers they had when asking.
    both = tagged.unionByName(answers.select("block", "kind", "part", "counts", "asked"))
    met = both.repartition("block").sortWithinPartitions("block", "kind", "part")
    cells = (met.mapInArrow(_cells(total), "cell long, n long, p2 double, p1 double")
             .groupBy("cell").agg(F.sum("n").alias("n"), F.sum("p2").alias("p2"), F.sum("p1").alias("p1")).collect())
    mix = weights([(r.cell, r.n, r.p2, r.p1) for r in cells], types)
    out = met.mapInArrow(_scores(total, types, mix), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")


def op8_deleted_interpolation(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fold("doc_id", 7) == 2)
