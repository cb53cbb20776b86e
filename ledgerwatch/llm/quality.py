"""Quality rules (op11): a linear-chain conditional random field labels a text's lines as content or
boilerplate, and the words in content decide whether the document stays.

Each line has a bin per feature (length, symbols, capitals, digits, repetition, ending, ...). A
line's score for boilerplate is the sum of its bins' weights; neighbouring lines are tied by
transition weights; the most likely labelling of a whole text is found by Viterbi decoding, over
all of its lines. A document is kept if it passes the base rules and at least half of its words
are in content lines.

Labels exist for documents only (`quality`), so the lines' labels are learned from them: weights are
fitted with every line labelled as its document and taken by itself, then the lines are decoded under the
fit and the whole field is fitted to them, twice. A document whose decoded majority contradicts its label keeps the
label on all lines. The fit uses a bounded sample: at most PER_CLASS documents of each label, of
those whose crc32(doc_id as text) mod 5 is not 0, chosen by a hash of the id, and their first
LINES lines. Everything else covers all rows and whole texts; a document is one row in one task.

Defined results: a null or empty text has one empty line, no words, fails the base rules and is not
kept; a null id is a row like others and never trains; a repeated id makes a row each; a label given
twice counts as the lower one; without labels every line is content. Ties go to content. No
other columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm.common import fold, prepare, table, uniform, written
from ledgerwatch.llm.tokens import SPACED, chunks
from ledgerwatch.llm.words import coded, paired, spans

#: Documents of each label that train, and lines of each.
PER_CLASS, LINES = 1000, 64
#: Steps of the fit, its rate and the weight of its penalty.
STEPS, RATE, PENALTY = 80, 0.3, 1.0
#: Least words, largest share of repeated words (percent) and least share of words in content.
LEAST_WORDS, MOST_REPEATED, LEAST_CONTENT = 50, 50, 0.5

SYMBOLS = b"#*$%&|<>"
_SHARES = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75])
_COUNTS = np.array([0, 1, 3, 7, 15, 31, 63, 127])
#: The features of a line and their numbers of bins.
FEATURES = ("words", "symbols", "capitals", "digits", "exclamations", "stops", "word length", "repeated words", "repeated line", "ending")
BINS = 9


def _marks(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOL, _UPPER, _LOWER = _marks(SYMBOLS), _marks(bytes(range(65, 91))), _marks(bytes(range(97, 123)))
_DIGIT, _BANG, _STOP = _marks(b"0123456789"), _marks(b"!"), _marks(b".,;:?")
#: Bytes that begin a code point.
_POINT = np.ones(256, dtype=bool)
_POINT[0x80:0xC0] = False
#: How a line ends: nothing, sentence mark, clause mark, letter or other.
_ENDING = np.full(256, 4)
_ENDING[list(b".!?")] = 1
_ENDING[list(b",;:")] = 2
_ENDING[_UPPER | _LOWER | ~_POINT] = 3


class Lines(NamedTuple):
    """Lines of a chunk of documents: base figures per document, words and bins per line."""
    bounds: np.ndarray     # lines of document d are bounds[d]:bounds[d + 1]
    start: np.ndarray
    end: np.ndarray
    words: np.ndarray      # per line
    bins: np.ndarray       # (line, feature)
    n_words: np.ndarray    # per document, as are the rest
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


def repeated(code: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per word: does it stand in a window of three words that its document has twice or more?"""
    out = np.zeros(len(code), dtype=bool)
    m = len(code) - 2
    if m < 1:
        return out
    at = np.flatnonzero(doc[2:] == doc[:-2])
    window = paired(paired(paired(code[at], code[at + 1]), code[at + 2]), doc[at])
    many = at[np.bincount(window, minlength=1)[window] > 1] if len(at) else at
    for k in range(3):
        out[many + k] = True
    return out


def lines_of(raw: np.ndarray, offsets: np.ndarray) -> Lines:
    n = len(offsets) - 1
    breaks = np.flatnonzero(raw == 10)
    bounds = np.arange(n + 1) + np.searchsorted(breaks, offsets, "left")
    start = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    end = np.sort(np.concatenate((breaks, offsets[1:])), kind="stable")
    words = spans(raw, offsets, SPACED)
    doc, size = words.doc, len(start)
    line = np.searchsorted(start, words.start, "right") - 1
    per_line = np.bincount(line, minlength=size)
    again = repeated(coded(raw, words)[0], doc)

    def within(marks: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(marks)))
        return total[hi] - total[lo]

    symbols, points = within(_SYMBOL[raw], start, end), within(_POINT[raw] & words.inside, start, end)
    upper, lower = within(_UPPER[raw], start, end), within(_LOWER[raw], start, end)
    whole, twice, dups = raw.tobytes(), np.zeros(size, dtype=bool), np.zeros(n, np.int64)
    for d in np.flatnonzero(np.diff(bounds) > 1):
        seen: dict[bytes, int] = {}
        for i in range(bounds[d], bounds[d + 1]):
            if per_line[i]:
                first = seen.setdefault(whole[start[i]:end[i]], i)
                if first != i:
                    twice[i] = twice[first] = True
                    dups[d] += 1

    of_words = np.maximum(per_line, 1)
    share = lambda x, total: np.searchsorted(_SHARES, x / np.maximum(total, 1), "left")
    last = np.where(end > start, raw[np.maximum(end - 1, 0)], 0) if len(raw) else np.zeros(size, np.uint8)
    bins = np.stack((
        np.searchsorted(_COUNTS, per_line, "left"), share(symbols, of_words), share(upper, upper + lower),
        share(within(_DIGIT[raw], start, end), points), share(within(_BANG[raw], start, end), of_words),
        share(within(_STOP[raw], start, end), of_words), np.minimum(points // of_words, BINS - 1),
        share(np.bincount(line, weights=again, minlength=size), of_words), twice.astype(np.int64),
        np.where(end > start, _ENDING[last], 0)), axis=1).astype(np.uint8)
    per_doc = lambda x: np.add.reduceat(np.append(x, 0), bounds[:-1]) if n else x[:0]  # noqa: E731  every document has a line
    return Lines(bounds, start, end, per_line, bins, np.diff(words.bounds), per_doc(points), per_doc(symbols), dups,
                 np.bincount(doc[again], minlength=n).astype(np.int64))


class Field(NamedTuple):
    """Weights of the field. State 0 is content, 1 boilerplate; a line's score for 1 is the sum of its bins' weights."""
    weight: np.ndarray  # (feature, bin)
    begin: np.ndarray   # state of the first line
    follow: np.ndarray  # (state, next state)


EMPTY = Field(np.zeros((len(FEATURES), BINS)), np.zeros(2), np.zeros((2, 2)))


def emissions(field: Field, bins: np.ndarray) -> np.ndarray:
    return field.weight[np.arange(len(FEATURES)), bins].sum(axis=1)


def viterbi(field: Field, score: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per line: is it boilerplate in the most likely labelling of its text? Ties go to content."""
    (cc, cb), (bc, bb) = field.follow.tolist()
    first_c, first_b = field.begin.tolist()
    scores, out = score.tolist(), np.zeros(len(score), dtype=bool)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if lo == hi:
            continue
        c, b = first_c, first_b + scores[lo]
        back = bytearray(hi - lo)  # bit 0: content came from boilerplate, bit 1: boilerplate did
        for i in range(lo + 1, hi):
            from_c, from_b = b + bc > c + cc, b + bb > c + cb
            back[i - lo] = from_c | from_b << 1
            c, b = (b + bc if from_c else c + cc), (b + bb if from_b else c + cb) + scores[i]
        state = int(b > c)
        for i in range(hi - 1, lo - 1, -1):
            out[i] = state
            state = back[i - lo] >> state & 1
    return out


def _expected(field: Field, score: np.ndarray, at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected states per line, of first lines, and of neighbours, by the forward-backward sums.
    at[t]: the t-th lines of the documents that have one, documents by falling length."""
    log = np.logaddexp
    ahead, behind = [], [None] * len(at)
    for t, i in enumerate(at):
        if t:
            before = ahead[-1][:len(i)]
            a = np.stack([log(before[:, 0] + field.follow[0, s], before[:, 1] + field.follow[1, s]) for s in (0, 1)], axis=1)
        else:
            a = np.tile(field.begin, (len(i), 1))
        a[:, 1] += score[i]
        ahead.append(a)
    behind[-1] = np.zeros((len(at[-1]), 2))
    for t in range(len(at) - 2, -1, -1):
        out = np.zeros((len(at[t]), 2))
        n = len(at[t + 1])
        after = behind[t + 1] + np.stack((np.zeros(n), score[at[t + 1]]), axis=1)
        out[:n] = np.stack([log(field.follow[s, 0] + after[:, 0], field.follow[s, 1] + after[:, 1]) for s in (0, 1)], axis=1)
        behind[t] = out
    total = log(*(ahead[0] + behind[0]).T)
    one, pairs = np.zeros(len(score)), np.zeros((2, 2))
    for t, i in enumerate(at):
        one[i] = np.exp(ahead[t][:, 1] + behind[t][:, 1] - total[:len(i)])
        if t:
            n = len(i)
            after = behind[t] + np.stack((np.zeros(n), score[i]), axis=1)
            for s in (0, 1):
                for u in (0, 1):
                    pairs[s, u] += np.exp(ahead[t - 1][:n, s] + field.follow[s, u] + after[:, u] - total[:n]).sum()
    first = np.array([(1 - one[at[0]]).sum(), one[at[0]].sum()])
    return one, first, pairs


def fitted(bins: np.ndarray, label: np.ndarray, bounds: np.ndarray, field: Field = EMPTY, chain: bool = True) -> Field:
    """The field of most penalised likelihood for labelled lines, by Adam's steps; without ``chain``
    lines are taken apart (no transition weights)."""
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    at = [bounds[:-1][order][size[order] > t] + t for t in range(int(size.max(initial=0)))]
    if not at:
        return EMPTY
    flat = (np.arange(len(FEATURES)) * BINS + bins).ravel()
    count = lambda x: np.bincount(flat, weights=np.repeat(x, len(FEATURES)), minlength=len(FEATURES) * BINS).reshape(-1, BINS)
    label = label.astype(float)
    inner = np.ones(len(label), dtype=bool)
    inner[bounds[:-1][size > 0]] = False
    now = label[inner].astype(int)
    before = label[np.flatnonzero(inner) - 1].astype(int)
    pairs = np.bincount(before * 2 + now, minlength=4).reshape(2, 2)
    first = np.bincount(label[bounds[:-1][size > 0]].astype(int), minlength=2)
    seen = (count(label), first, pairs)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in field]
    for step in range(1, STEPS + 1):
        one, starts, follows = _expected(field, emissions(field, bins), at)
        new = []
        for k, (p, want, got, m) in enumerate(zip(field, seen, (count(one), starts, follows), moments)):
            if k and not chain:
                new.append(p)
                continue
            slope = (want - got - PENALTY * p) / len(label)
            m[0] = 0.9 * m[0] + 0.1 * slope
            m[1] = 0.99 * m[1] + 0.01 * slope ** 2
            new.append(p + RATE * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-8))
        field = Field(*new)
    return field


def learned(bins: np.ndarray, words: np.ndarray, bounds: np.ndarray, junk: np.ndarray, rounds: int = 2) -> Field:
    """The field for lines whose documents are labelled (junk: per document)."""
    size = np.diff(bounds)
    label = np.repeat(junk, size)
    field = fitted(bins, label, bounds, chain=False)
    doc = np.repeat(np.arange(len(size)), size)
    for _ in range(rounds):
        found = viterbi(field, emissions(field, bins), bounds)
        in_junk = np.bincount(doc, weights=words * found, minlength=len(size))
        against = (2 * in_junk > np.bincount(doc, weights=words, minlength=len(size))) != junk
        label = np.where(against[doc], junk[doc], found)
        field = fitted(bins, label, bounds, field)
    return field


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, raw, offsets in chunks(batch, "text"):
            x = lines_of(raw, offsets)
            stop = np.minimum(x.bounds[1:], x.bounds[:-1] + LINES)
            yield pa.RecordBatch.from_arrays(
                [part.column("place"), part.column("quality"), pa.array([x.bins[a:b].tobytes() for a, b in zip(x.bounds, stop)], pa.binary()),
                 pa.array([x.words[a:b].tolist() for a, b in zip(x.bounds, stop)], pa.list_(pa.int64()))], ["place", "quality", "bins", "words"])


def fit(docs: DataFrame, labels: DataFrame) -> Field:
    """The field learned from a bounded sample of labelled documents."""
    prepare(docs.sparkSession)
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    known = known.where(fold("doc_id", 5) != 0).withColumn("place", uniform(F.col("doc_id"), seed="quality"))
    there, classes = docs.select("doc_id"), []
    for quality in (0, 1):
        own = known.where(F.col("quality") == quality).join(there, "doc_id", "left_semi")
        classes.append(own.orderBy("place", "doc_id").limit(PER_CLASS))
    sample = written(classes[0].unionByName(classes[1]), "quality-sample")  # at most 2 PER_CLASS rows
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("place", "quality", "text")
    lines = written(texts.mapInArrow(_training, "place double, quality int, bins binary, words array<long>"), "quality-lines")
    rows = [r for quality in (0, 1) for r in lines.where(F.col("quality") == quality).orderBy("place", "bins").limit(PER_CLASS).collect()]
    if not rows:
        return EMPTY
    bounds = np.concatenate(([0], np.cumsum([len(r.words) for r in rows])))
    bins = np.frombuffer(b"".join(bytes(r.bins) for r in rows), np.uint8).reshape(-1, len(FEATURES))
    return learned(bins, np.array([w for r in rows for w in r.words]), bounds, np.array([r.quality == 0 for r in rows]))


def _judging(field: Field, with_content: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in chunks(batch, "text"):
                x = lines_of(raw, offsets)
                junk = viterbi(field, emissions(field, x.bins), x.bounds)
                in_content = np.add.reduceat(np.append(np.where(junk, 0, x.words), 0), x.bounds[:-1])
                share = in_content / np.maximum(x.n_words, 1)
                failed = (x.n_words < LEAST_WORDS) | (100 * x.n_repeat_words > MOST_REPEATED * x.n_words)
                out = {"doc_id": part.column("doc_id"), "n_words": x.n_words, "word_chars": x.word_chars, "n_symbols": x.n_symbols,
                       "n_dup_lines": x.n_dup_lines, "n_repeat_words": x.n_repeat_words, "base_failed": failed,
                       "kept": ~failed & (share >= LEAST_CONTENT), "content_share": share, "n_lines": np.diff(x.bounds),
                       "n_boilerplate": np.add.reduceat(np.append(junk.astype(np.int64), 0), x.bounds[:-1])}
                if with_content:
                    whole = raw.tobytes()
                    out["content"] = pa.array([b"\n".join(whole[x.start[i]:x.end[i]] for i in range(a, b) if not junk[i]).decode()
                                               for a, b in zip(x.bounds[:-1], x.bounds[1:])], pa.string())
                yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in out.values()], list(out))
    return run


def judge(docs: DataFrame, field: Field, with_content: bool = False) -> DataFrame:
    """One row per document: its base figures, kept, content_share (of words), n_lines and
    n_boilerplate; with_content adds the text without its boilerplate lines."""
    prepare(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    schema = (f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
              "kept boolean, content_share double, n_lines long, n_boilerplate long" + ", content string" * with_content)
    return docs.select("doc_id", "text").mapInArrow(_judging(field, with_content), schema)


def op11_line_labelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels")))
