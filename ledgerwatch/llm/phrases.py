"""Phrase collocations (op12), counted in quotient filters.

Texts are cut into blocks of whole documents. A block's tokens are codes of its own word list; the
words' counts are added up over all blocks, frequent words get dense ids per (language, word), and
each block learns the ids of its own words: while the dictionary has FEW_WORDS words at most it is
sent to all tasks, a larger one is joined with the blocks' words by a shuffle. Tokens are stored as
planes of bytes, compressed; tables of steps that are done are removed.

A phrase of n words is its n word ids packed into n x b bits, permuted by an invertible mixer. The
top bits of the result are the quotient: they name a slot, and a run within it; the rest, the
remainder, is stored in full beside its count. So a filter is a sorted, lossless, compact table of
counters. Each block sends its filter slot by slot; a slot's filters are merged (sorted runs
added up), phrases seen often enough are unpacked to their ids, and each block is told which of
its phrases those are (a bit each). Only stretches of a block in which every n-gram is frequent can hold
a frequent (n+1)-gram, so the next round reads those alone. Slots are sized by the number of
occurrences; a phrase, however frequent, is one counter per block.

Scores: l and r are the counts of a phrase's two parts at the cut that scores lowest, found by joins of
the frequent phrases with themselves; all arithmetic is exact (longs and 38-digit decimals).
A candidate goes if a longer candidate holds it and is (nearly) as frequent; it suffices to look at those
one word longer, since anything that holds the phrase is held by one of these or is one, and is no more frequent.

Defined results: a null text has no words; a null language counts as `und`; repeated rows and ids
count each; empty tables give no rows; other columns are not read. A document is one row in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.common import dropped, prepare, ranked, table, written
from ledgerwatch.llm.tokens import _separators, chunks, mix
from ledgerwatch.llm.words import coded, spans

#: Bytes of text in a block, occurrences in a slot, least number of slots (a power of two).
BLOCK, SLOT, LEAST_SLOTS = 8 << 20, 1 << 19, 64
#: Up to so many frequent words (about 10 MB) are sent to the tasks; more are joined by a shuffle.
FEW_WORDS = 1 << 18
#: Runs in a slot, as a power of two.
RUNS = 3
#: Least bits of a word id, so that slots and runs always fit into a quotient.
LEAST_BITS = 16

CUTS = ".,;:!?\n\v\f\r"
_WORD = _separators(" \t" + CUTS)
_CUT = ~_separators(CUTS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
U64 = np.uint64


class Packing:
    """n ids of b bits each as equally wide limbs of at most 64 bits, and their permutation."""

    def __init__(self, words: int, bits: int) -> None:
        self.words, self.bits = words, bits
        self.limbs = -(-words * bits // 64)
        self.width = -(-words * bits // self.limbs)
        self.mask = U64((1 << self.width) - 1)
        self.half = U64((self.width + 1) // 2)
        self.odd = [int(x) | 1 for x in mix(np.arange(21, 23, dtype=U64))]

    def pack(self, ids: np.ndarray) -> list[np.ndarray]:
        """ids: (rows, words) to one array per limb, the top one first."""
        out = [np.zeros(len(ids), U64) for _ in range(self.limbs)]
        b, keep = U64(self.bits), U64(self.width - self.bits)
        for k in range(self.words):
            for j in range(self.limbs):
                low = out[j + 1] >> keep if j + 1 < self.limbs else ids[:, k].astype(U64)
                out[j] = (out[j] << b | low) & self.mask if self.bits < 64 else low
        return out

    def unpack(self, limbs: list[np.ndarray]) -> np.ndarray:
        limbs, out = [x.copy() for x in limbs], np.zeros((len(limbs[0]), self.words), np.int64)
        b, keep, low = U64(self.bits), U64(self.width - self.bits), U64((1 << self.bits) - 1)
        for k in range(self.words - 1, -1, -1):
            out[:, k] = (limbs[-1] & low).astype(np.int64)
            for j in range(self.limbs - 1, -1, -1):
                limbs[j] = limbs[j] >> b | (limbs[j - 1] & low) << keep if j else limbs[j] >> b
        return out

    def _mixed(self, x: np.ndarray) -> np.ndarray:
        for odd in self.odd:
            x = x * U64(odd) & self.mask
            x = x ^ x >> self.half
        return x

    def _unmixed(self, x: np.ndarray) -> np.ndarray:
        for odd in reversed(self.odd):
            x = x ^ x >> self.half
            x = x * U64(pow(odd, -1, 1 << 64)) & self.mask
        return x

    def _others(self, limbs: list[np.ndarray], j: int) -> np.ndarray:
        rest = reduce(np.add, [x * U64(2 * i + 3) for i, x in enumerate(limbs) if i != j], np.zeros_like(limbs[0]))
        return mix(rest) & self.mask if self.limbs > 1 else rest

    def permute(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        limbs = list(limbs)
        for _ in range(2):
            for j in range(self.limbs):
                limbs[j] = self._mixed(limbs[j] ^ self._others(limbs, j))
        return limbs

    def restore(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        limbs = list(limbs)
        for _ in range(2):
            for j in range(self.limbs - 1, -1, -1):
                limbs[j] = self._unmixed(limbs[j]) ^ self._others(limbs, j)
        return limbs


def distinct(limbs: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sorted distinct keys, the place of each given key among them, and the order that sorted them.
    The stable sort merges runs that are sorted already."""
    order = np.lexsort(limbs[::-1]) if len(limbs) > 1 else np.argsort(limbs[0], kind="stable")
    there = [x[order] for x in limbs]
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = reduce(np.logical_or, [x[1:] != x[:-1] for x in there])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return [x[new] for x in there], place, order


class Filter:
    """The layout of the filters of one round: 2^slots slots of 2^RUNS runs."""

    columns = ["slot", "block", "runs", "rest", "counts", "large"]
    schema = "slot long, block long, runs binary, rest binary, counts binary, large binary"

    def __init__(self, packing: Packing, slots: int) -> None:
        self.packing, self.slots = packing, slots
        self.rest = packing.width - slots - RUNS  # bits of the top limb that are stored
        assert self.rest >= 0, "a quotient has more bits than its limb"
        self.sizes = [-(-self.rest // 8), *[-(-packing.width // 8)] * (packing.limbs - 1)]

    def slot_of(self, limbs: list[np.ndarray]) -> np.ndarray:
        return (limbs[0] >> U64(self.packing.width - self.slots)).astype(np.int64)

    def rows(self, limbs: list[np.ndarray], counts: np.ndarray, block: int) -> pa.RecordBatch:
        """Sorted keys and their counts as one row per slot. Counts of 255 and more are kept apart."""
        slot = self.slot_of(limbs)
        there, first = np.unique(slot, return_index=True)
        ends = np.append(first, len(slot))
        run = (limbs[0] >> U64(self.rest)).astype(np.int64) & ((1 << RUNS) - 1)
        runs = np.bincount(np.repeat(np.arange(len(there)), np.diff(ends)) << RUNS | run, minlength=len(there) << RUNS).astype(np.uint32)
        top = limbs[0] & U64((1 << self.rest) - 1)
        rest = np.concatenate([x.view(np.uint8).reshape(-1, 8)[:, :n] for x, n in zip([top, *limbs[1:]], self.sizes)], axis=1)
        big = counts >= 255
        large = np.concatenate(([0], np.cumsum(big)))[ends]
        sliced = lambda data, at: pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [
            None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8).ravel())]).cast(pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.array(there), pa.array(np.full(len(there), block)), sliced(runs, np.arange(len(there) + 1) * (4 << RUNS)),
            sliced(rest, ends * rest.shape[1]), sliced(np.minimum(counts, 255).astype(np.uint8), ends),
            sliced(counts[big].astype(np.int64), large * 8)], self.columns)

    def read(self, slot: int, rows: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Keys and counts of one slot's rows, and the number of keys of each row."""
        flat = {c: np.frombuffer(b"".join(rows.column(c).to_pylist()), np.uint8) for c in ("runs", "rest", "counts", "large")}
        runs = flat["runs"].view(np.uint32)
        run = np.repeat(np.tile(np.arange(1 << RUNS, dtype=U64), rows.num_rows), runs)
        rest, at, limbs = flat["rest"].reshape(len(run), -1), 0, []
        for n in self.sizes:
            wide = np.zeros((len(run), 8), np.uint8)
            wide[:, :n] = rest[:, at:at + n]
            limbs.append(wide.view(U64).ravel())
            at += n
        limbs[0] = limbs[0] | run << U64(self.rest) | U64(slot) << U64(self.packing.width - self.slots)
        counts = flat["counts"].astype(np.int64)
        counts[counts == 255] = flat["large"].view(np.int64)
        return limbs, counts, runs.reshape(rows.num_rows, -1).sum(axis=1, dtype=np.int64)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """Runs of rows with one key, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and keys[a] != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)


def packed(tokens: np.ndarray) -> bytes:
    """Tokens as compressed planes of bytes, behind their number and size."""
    size = 4 if int(tokens.max(initial=0)) < 1 << 31 else 8
    planes = np.ascontiguousarray(tokens.astype(f"<i{size}").view(np.uint8).reshape(-1, size).T)
    return np.array([len(tokens), size], np.int64).tobytes() + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n, size = np.frombuffer(data, np.int64, 2).tolist()
    planes = pa.decompress(memoryview(data)[16:], n * size, codec="zstd")
    return np.frombuffer(planes, np.uint8).reshape(size, n).T.copy().view(f"<i{size}").ravel().astype(np.int64)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(language, bytes, offsets) of whole documents, BLOCK bytes or more together."""
    held, size = [], 0
    for batch in batches:
        for part, raw, offsets in chunks(batch, "text", BLOCK):
            held.append((part.column("lang"), raw, offsets))
            size += len(raw)
            if size >= BLOCK:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    langs, raws, offsets = zip(*held)
    at = np.concatenate(([0], np.cumsum([len(r) for r in raws])))
    return pa.concat_arrays(langs), np.concatenate(raws), np.concatenate([[0], *(o[1:] + k for o, k in zip(offsets, at))])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its words (language, word, count) and its tokens as places in that list; -1 parts pieces."""
    block = TaskContext.get().partitionId() << 32
    for langs, raw, offsets in _texts(batches):
        raw = _LOWER[raw]
        words = spans(raw, offsets, _WORD)
        if not len(words.start):
            continue
        doc = words.doc
        code, spelling = coded(raw, words)
        langs = langs.dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[doc]
        pair, at, n = np.unique(lang * len(spelling) + code, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")  # small numbers for frequent words pack better
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        cuts = np.concatenate(([0], np.cumsum(_CUT[raw])))
        piece = np.flatnonzero((doc[1:] != doc[:-1]) | (cuts[words.start[1:]] > cuts[words.start[:-1]])) + 1
        tokens = np.insert(place[at], piece, -1)
        word = spelling.take(pa.array(pair[order] % len(spelling))).cast(pa.large_string()).cast(pa.string())
        own = pa.StructArray.from_arrays([langs.dictionary.take(pa.array(pair[order] // len(spelling))), word, pa.array(n[order])], ["lang", "word", "n"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), pa.array([packed(tokens)], pa.binary())],
            ["block", "words", "tokens"])
        block += 1


def _renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens as ids of frequent words (others: -1), in stretches of two or more."""
    for block, rows in groups(batches, "block"):
        tokens = unpacked(next(x for x in rows.column("tokens").to_pylist() if x is not None))
        places, ids = (rows.column(c).combine_chunks().flatten().to_numpy() for c in ("places", "ids"))
        yield from _known(block, tokens, places, ids)


def _known(block: int, tokens: np.ndarray, places: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    name = np.full(max(int(tokens.max(initial=0)), int(places.max(initial=0))) + 2, -1, np.int64)  # the last one is for -1
    name[places] = ids
    if len(kept := stretches(name[tokens], 1, name[tokens] >= 0)):
        yield _tokens(block, kept)


def _spelt(lang: pa.Array, word: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(word, lang, " ")  # no word holds a space


def _looked_up(known: pa.Table):
    """As _renamed, with the whole (small) dictionary at hand; the row of a word is its id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelt = _spelt(known.column("lang").combine_chunks(), known.column("word").combine_chunks())
        for batch in batches:
            for k, block in enumerate(batch.column("block").to_pylist()):
                own = batch.column("words").slice(k, 1).flatten()
                ids = pc.index_in(_spelt(own.field("lang"), own.field("word")), value_set=spelt)
                places = np.flatnonzero(pc.is_valid(ids).to_numpy(zero_copy_only=False))
                yield from _known(block, unpacked(batch.column("tokens")[k].as_py()), places, ids.drop_null().to_numpy().astype(np.int64))
    return run


def _tokens(block: int, tokens: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([packed(tokens)], pa.binary())], ["block", "tokens"])


def stretches(tokens: np.ndarray, n: int, alive: np.ndarray) -> np.ndarray:
    """Maximal runs of places at which an alive n-gram starts, two places or more, as their tokens followed by -1."""
    edge = np.diff(np.concatenate(([0], alive.astype(np.int8), [0])))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    keep = stop - start > 1
    start, size = start[keep], stop[keep] - start[keep] + n  # n - 1 more tokens, then the mark
    at = np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    out = tokens[np.minimum(at, len(tokens) - 1)] if len(at) else np.zeros(0, np.int64)
    out[np.cumsum(size) - 1] = -1
    return out


def grams(tokens: np.ndarray, n: int) -> np.ndarray:
    """Places at which n tokens without a mark start."""
    marks = np.concatenate(([0], np.cumsum(tokens < 0)))
    m = max(0, len(tokens) - n + 1)
    return np.flatnonzero(marks[n:n + m] == marks[:m])


def _keys(packing: Packing, tokens: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    at = grams(tokens, packing.words)
    limbs = packing.permute(packing.pack(np.stack([tokens[at + k] for k in range(packing.words)], axis=1)))
    keys, place, _ = distinct(limbs)
    return at, keys, place


def _counting(layout: Filter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, tokens in zip(batch.column("block").to_pylist(), batch.column("tokens").to_pylist()):
                _, keys, place = _keys(layout.packing, unpacked(tokens))
                if len(place):
                    yield layout.rows(keys, np.bincount(place), block)
    return run


def _merging(layout: Filter, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, rows in groups(batches, "slot"):
            limbs, counts, sizes = layout.read(int(slot), rows)
            keys, place, order = distinct(limbs)
            total = np.zeros(len(keys[0]), np.int64)
            np.add.at(total, place, counts)
            often = total >= least
            if not often.any():
                continue
            hit, ends = often[place], np.concatenate(([0], np.cumsum(sizes)))
            blocks = rows.column("block").to_pylist()
            told = [(b, np.packbits(hit[i:j]).tobytes()) for b, i, j in zip(blocks, ends[:-1], ends[1:]) if hit[i:j].any()]
            ids = layout.packing.unpack(layout.packing.restore([x[often] for x in keys]))
            found = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * ids.shape[1], pa.int32()), pa.array(ids.ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in told], pa.int64()), pa.array([slot] * len(told), pa.int64()), pa.array([m for _, m in told], pa.binary()),
                 pa.nulls(len(told), found.type), pa.nulls(len(told), pa.int64())], ["block", "slot", "hits", "gram", "a"])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.binary()), found, pa.array(total[often])],
                ["block", "slot", "hits", "gram", "a"])
    return run


def _pruning(layout: Filter):
    """A block's tokens and the answers of its slots: the stretches of frequent n-grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in groups(batches, "block"):
            answers = rows.filter(pc.is_valid(rows.column("hits")))
            if not answers.num_rows:
                continue
            tokens = unpacked(next(x for x in rows.column("tokens").to_pylist() if x is not None))
            at, keys, place = _keys(layout.packing, tokens)
            slot, often = layout.slot_of(keys), np.zeros(len(keys[0]), dtype=bool)
            for s, hits in zip(answers.column("slot").to_pylist(), answers.column("hits").to_pylist()):
                i, j = np.searchsorted(slot, [s, s + 1])
                often[i:j] = np.unpackbits(np.frombuffer(hits, np.uint8), count=j - i)
            alive = np.zeros(len(tokens), dtype=bool)
            alive[at] = often[place]
            if len(kept := stretches(tokens, layout.packing.words, alive)):
                yield _tokens(block, kept)
    return run


_TOKENS = "block long, tokens binary"


def _dealt(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(F.col(key)).sortWithinPartitions(key)


def frequent(docs: DataFrame, least: int, most_words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(gram, a): all phrases of 1 to most_words word ids that occur ``least`` times; (id, lang, word) of
    the frequent words; (lang, n): occurrences of all words."""
    prepare(docs.sparkSession)
    text = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    blocks = written(text.mapInArrow(_blocks, "block long, words array<struct<lang:string,word:string,n:long>>, tokens binary"), "phrase-blocks", "zstd")
    own = blocks.select("block", F.posexplode("words").alias("place", "w")).select("block", "place", "w.*")
    sizes = written(own.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-sizes")
    counted = own.groupBy("lang", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    words, many = ranked(counted, ["lang", "word"], "phrase-words")
    words = written(words.select((F.col("rank") - 1).alias("id"), "lang", "word", "a"), "phrase-ids")
    found = [words.select(F.array("id").alias("gram"), "a")]
    bits = max(int(many).bit_length(), LEAST_BITS)
    if many <= FEW_WORDS:
        named = blocks.mapInArrow(_looked_up(words.orderBy("id").select("lang", "word").toArrow()), _TOKENS)
    else:
        names = own.join(words.select("lang", "word", "id"), ["lang", "word"])
        # a block's distinct words at most; both lists follow the order of the rows
        names = names.groupBy("block").agg(F.collect_list("place").alias("places"), F.collect_list("id").alias("ids"))
        texts = blocks.select("block", F.lit(None).cast("array<int>").alias("places"), F.lit(None).cast("array<long>").alias("ids"), "tokens")
        named = _dealt(texts.unionByName(names.withColumn("tokens", F.lit(None).cast("binary"))), "block").mapInArrow(_renamed, _TOKENS)
    tokens = written(named, "phrase-tokens")
    dropped(blocks)
    for n in range(2, most_words + 1):
        bound = found[-1].agg(F.sum("a")).first()[0] or 0  # no more occurrences of n words than of n - 1
        layout = Filter(Packing(n, bits), max(LEAST_SLOTS.bit_length() - 1, int(bound // SLOT).bit_length()))
        merged = _dealt(tokens.mapInArrow(_counting(layout), Filter.schema), "slot").mapInArrow(
            _merging(layout, least), "block long, slot long, hits binary, gram array<long>, a long")
        merged = written(merged, f"phrase-{n}")
        found.append(merged.where("gram is not null").select("gram", "a"))
        if n < most_words:
            told = merged.where("hits is not null").select("block", "slot", "hits", F.lit(None).cast("binary").alias("tokens"))
            held = tokens.select("block", F.lit(None).cast("long").alias("slot"), F.lit(None).cast("binary").alias("hits"), "tokens")
            before, tokens = tokens, written(_dealt(held.unionByName(told), "block").mapInArrow(_pruning(layout), _TOKENS), f"phrase-tokens-{n}")
            dropped(before)
    dropped(tokens)
    return reduce(DataFrame.unionByName, found), words, sizes


def mine(docs: DataFrame, least: int = 100, most_words: int = 5, top: int = 2000, percent: int = 100) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    grams_, words, sizes = frequent(docs, least, most_words)
    every = written(grams_, "phrase-frequent")
    # a candidate goes if one with a further word before or behind is as frequent
    longer = every.where("size(gram) > 2").select(F.explode(F.array(
        F.expr("slice(gram, 1, size(gram) - 1)"), F.expr("slice(gram, 2, size(gram) - 1)"))).alias("gram"), "a")
    longer = longer.groupBy("gram").agg(F.max("a").alias("most"))
    kept = (every.where("size(gram) > 1").join(longer, "gram", "left")
            .where(f"most is null or 100 * most < {percent} * a").select("gram", "a"))
    cuts = kept.select("gram", "a", F.explode(F.expr("sequence(1, size(gram) - 1)")).alias("k")).withColumns(
        {"first": F.expr("slice(gram, 1, k)"), "rest": F.expr("slice(gram, k + 1, size(gram) - k)")})
    cuts = (cuts.join(every.select(F.col("gram").alias("first"), F.col("a").alias("l")), "first")
            .join(every.select(F.col("gram").alias("rest"), F.col("a").alias("r")), "rest")
            .groupBy("gram", "a").agg(F.collect_list(F.struct("k", "l", "r")).alias("cuts")))  # most_words - 1 at most
    named = (cuts.select("gram", F.posexplode("gram").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
             .groupBy("gram").agg(F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    scored = cuts.join(named, "gram").join(sizes, "lang").withColumn("best", F.expr("""
        array_min(transform(cuts, c -> named_struct(
            'score', (1000 * cast(a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(c.l as decimal(19, 0)) * cast(c.r as decimal(19, 0))),
            'k', c.k, 'l', c.l, 'r', c.r)))"""))
    rows = scored.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of each part first, so the last window sees a bounded number of rows per language
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_quotient_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "documents"))


ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
  FROM words, range(1, 6) AS t(k) WHERE len(w) >= k),
counted AS (SELECT lang, g, count(*) AS a FROM grams GROUP BY lang, g HAVING count(*) >= 100),
held AS (
  SELECT DISTINCT lang, g[i:j] AS g, a AS most
  FROM counted, range(1, 6) AS s(i), range(1, 6) AS e(j) WHERE j > i AND j <= len(g) AND j - i + 1 < len(g)),
kept AS (
  SELECT * FROM counted c WHERE len(g) > 1
    AND NOT EXISTS (SELECT 1 FROM held h WHERE h.lang = c.lang AND h.g = c.g AND 100 * h.most >= 100 * c.a)),
cuts AS (
  SELECT c.lang, c.g, c.a, k, l.a AS l, r.a AS r, n,
    ((1000 * c.a::HUGEINT * n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM kept c JOIN range(1, 5) AS t(k) ON k < len(c.g)
  JOIN counted l ON l.lang = c.lang AND l.g = c.g[1:k]
  JOIN counted r ON r.lang = c.lang AND r.g = c.g[k + 1:len(c.g)]
  JOIN sizes s ON s.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
  array_to_string(g, ' ') AS phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""
