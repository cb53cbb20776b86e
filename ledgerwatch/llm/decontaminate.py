"""Benchmark decontamination by pigeonhole edit matching (operator 3).

Texts and items are normalised to lower-case (A-Z) words of letters, digits and
non-ASCII characters, one space before each; a character of a script written
without spaces is a word of its own. An item may differ from a passage
by up to ERROR_RATE of its bytes. An item with a budget of d edits is cut
into d + 1 pieces, at word starts where the words allow it and at any byte
elsewhere; whatever the edits, one piece stays whole, so
each exact hit of a piece is a candidate and no match is missed. Candidates are
verified with Myers' bit-parallel edit distance over the passage around the hit.

Items are taken in blocks of bounded size, and each block is matched against
all documents where they lie; documents are never shuffled.

Defined results: null, empty and wordless texts or items match nothing; an item
starts where a word does, or spends an edit on the missing space;
repeated rows match alike; further columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm import tokens as tk
from ledgerwatch.llm.common import prepare, table, written

ERROR_RATE = 0.05
#: Bytes by which a piece is looked up before it is compared in full.
PROBE = 12
#: Items and bytes of items in one block.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 8 << 20
#: Blocks whose items the driver holds at a time; what they leave is written before the next ones.
HELD_BLOCKS = 8

_FOLD = np.where(tk.ALNUM, np.arange(256), 32).astype(np.uint8)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def _unspaced(raw: np.ndarray) -> np.ndarray:
    """Where the characters of scripts written without spaces begin and end: U+3000 to U+9FFF and
    from U+10000 on by their first byte, Thai, Lao, Myanmar and Khmer by their first two."""
    lead = np.flatnonzero(raw >= 0xE0)
    first, second = raw[lead], raw[np.minimum(lead + 1, len(raw) - 1)]
    own = ((first >= 0xE3) & (first <= 0xE9)) | (first >= 0xF0)
    own |= (first == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    own |= (first == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F))
    lead = lead[own]
    return np.union1d(lead, lead + np.where(raw[lead] >= 0xF0, 4, 3))


def normalise(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) with one space before each word; other separators go. A
    document's last byte may be a space, which then also opens the next one."""
    apart = _unspaced(raw)
    wide = np.insert(_FOLD[raw], np.sort(np.concatenate([offsets[:-1], apart])), 32)
    keep = wide != 32
    keep[1:] |= wide[:-1] != 32
    if len(keep):
        keep[0] = True
    heads = offsets + np.arange(len(offsets)) + np.searchsorted(apart, offsets)
    kept = np.append(np.cumsum(keep), int(keep.sum()) + 1)  # behind the last document lies no byte
    return wide[keep], kept[heads] - 1


def normalise_one(text: str | None) -> bytes:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    out = normalise(raw, np.array([0, len(raw)]))[0].tobytes().rstrip(b" ")
    return out


def pieces(item: bytes, rate: float = ERROR_RATE) -> list[int]:
    """Starts of budget-plus-one pieces (plus the end), about equally long and of PROBE bytes at
    least where the item has as many: cuts at word starts, or at any byte where none is in reach."""
    n = len(item)
    budget = int(rate * n)
    least = min(PROBE, n // (budget + 1))
    starts = [i for i in range(1, n) if item[i] == 32]
    cuts = [0]
    for j in range(1, budget + 1):
        low, high, goal = cuts[-1] + least, n - least * (budget + 1 - j), n * j / (budget + 1)
        room = [s for s in starts if low <= s <= high]
        cuts.append(min(room, key=lambda s: abs(s - goal)) if room else min(max(low, round(goal)), high))
    return [*cuts, n]


def myers(pattern: bytes, text: bytes) -> tuple[int, int]:
    """(least edit distance of the pattern to any substring of text, where it first ends)."""
    masks: dict[int, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, where = m, 0
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        d0 = (((eq & up) + up) ^ up) | eq | down
        h_up = down | (~(d0 | up) & full)
        h_down = up & d0
        if h_up & top:
            score += 1
        elif h_down & top:
            score -= 1
        h_up = (h_up << 1) & full
        h_down = (h_down << 1) & full
        up = h_down | (~(d0 | h_up) & full)
        down = h_up & d0
        if score < best:
            best, where = score, at + 1
    return best, where


def _probe(window: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the first ``size`` (at most PROBE) bytes of each row."""
    w = np.zeros((len(window), 16), np.uint8)
    w[:, :size] = window[:, :size]
    v = w.view(np.uint64)
    return tk.mix(tk.mix(v[:, 0] + np.uint64(size)) ^ v[:, 1])


class Matcher:
    """Pieces of one block of items."""

    def __init__(self, items: list[tuple[int | None, bytes]], rate: float = ERROR_RATE):
        self.items = [(i, t) for i, t in items if t]
        self.budget: list[int] = []
        # (probe size, whether it starts a word) -> item, start and end in it, bytes
        found: dict[tuple[int, bool], list[tuple[int, int, int, bytes]]] = defaultdict(list)
        for no, (_, t) in enumerate(self.items):
            cuts = pieces(t, rate)
            self.budget.append(len(cuts) - 2)
            for a, b in zip(cuts, cuts[1:], strict=False):
                found[min(PROBE, b - a), t[a] == 32].append((no, a, b, t[a:b]))
        self.sizes = {}
        for (size, at_word), own in found.items():
            first = np.array([np.frombuffer(p[3][:size].ljust(PROBE, b"\0"), np.uint8) for p in own])
            keys = _probe(first, size)
            order = np.argsort(keys, kind="stable")
            coarse = np.zeros(1 << 18, bool)
            coarse[(keys >> np.uint64(46)).astype(np.int64)] = True
            self.sizes[size, at_word] = (keys[order], coarse, [own[i] for i in order])

    def hits(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, item number, edits) of each item found in each document."""
        buf, bounds = normalise(raw, offsets)
        starts = np.flatnonzero(buf == 32)
        padded = np.concatenate([buf, np.zeros(PROBE, np.uint8)])
        view = np.lib.stride_tricks.sliding_window_view(padded, PROBE)
        near: dict[tuple[int, int], list[int]] = defaultdict(list)
        for (size, at_word), (keys, coarse, own) in self.sizes.items():
            places = starts if at_word else np.arange(len(buf))
            for lo in range(0, len(places), 1 << 17):
                part = places[lo:lo + (1 << 17)]
                h = _probe(view[part], size)
                some = np.flatnonzero(coarse[(h >> np.uint64(46)).astype(np.int64)])
                first = np.searchsorted(keys, h[some])
                first[first == len(keys)] = 0
                for i in np.flatnonzero(keys[first] == h[some]):
                    x = int(part[some[i]])
                    doc = int(np.searchsorted(bounds, x, "right")) - 1
                    at = int(first[i])
                    while at < len(keys) and keys[at] == h[some[i]]:
                        no, a, b, piece = own[at]
                        at += 1
                        if x + b - a <= bounds[doc + 1] and buf[x:x + b - a].tobytes() == piece:
                            near[doc, no].append(x - a)
        for (doc, no), diagonals in near.items():
            item, budget = self.items[no][1], self.budget[no]
            best, end = budget + 1, -1
            for d in sorted(set(diagonals)):
                lo, hi = max(int(bounds[doc]), d - budget), min(int(bounds[doc + 1]), d + len(item) + budget)
                if best == 0 or hi <= end:
                    continue
                end = hi
                best = min(best, myers(item, buf[lo:hi].tobytes())[0])
            if best <= budget:
                yield doc, no, best


def blocks(benchmark: DataFrame) -> Iterator[Matcher]:
    """Matchers over bounded blocks of the items, collected one at a time."""
    items = benchmark.select("item_id", "text").where("text is not null")
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    keyed = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    for i in range(parts):
        yield Matcher([(r.item_id, normalise_one(r.text)) for r in
                       keyed.where(F.col("block") == i).orderBy("item_id", "text").collect()])


def matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, edits (least), budget: each benchmark item in each document."""
    prepare(documents.sparkSession)
    schema = "doc_id long, item_id long, edits long, budget long"
    out = None
    for i, matcher in enumerate(blocks(benchmark), 1):
        def run(batches: Iterator[pa.RecordBatch], matcher: Matcher = matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, raw, offsets in tk.chunks(batch, "text"):
                    ids = part.column("doc_id").to_pylist()
                    rows = [(ids[d], matcher.items[no][0], e, matcher.budget[no]) for d, no, e in matcher.hits(raw, offsets)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                                         names=["doc_id", "item_id", "edits", "budget"])

        got = documents.select("doc_id", "text").mapInArrow(run, schema)
        out = got if out is None else out.unionByName(got)
        if i % HELD_BLOCKS == 0:
            out = written(out, "matches")
    return out


def op3_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its budget."""
    prepare(spark)
    for i, matcher in enumerate(blocks(table(spark, sf_dir, "benchmark")), 1):
        def run(batches: Iterator[pa.RecordBatch], matcher: Matcher = matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, raw, offsets in tk.chunks(batch, "text"):
                    bad = {d for d, _, _ in matcher.hits(raw, offsets)}
                    yield part.filter(pa.array([i not in bad for i in range(part.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if i % HELD_BLOCKS == 0:
            docs = written(docs, "decontaminated")
    return docs
