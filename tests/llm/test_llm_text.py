"""Tokens, toxicity, MinHash, decontamination, language model and passages against plain Python."""

import math
import random
import re
import tracemalloc
import types
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from pyspark.sql import functions as F

from ledgerwatch.llm import decontaminate, lm, minhash, passages, toxicity
from ledgerwatch.llm import tokens as tk

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gam", "delta", "eps", "zeta", "ÉTA", "theta"]) + str(rng.randrange(60)) for _ in range(n))


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)


ODD_ROWS = [(None, None), (None, "one two"), (1, None), (2, ""), (3, " \n\t "), (4, "A b"), (5, "a B"), (5, "a B"), (6, "x " * 30_000), (7, "é ü 漢字 😀")]


def test_words_and_shingles():
    rows = ["A b\tC", None, "", "  ", "é x\x0bY", "w" * 3000 + " end", "a b c d e f"]
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])
    (part, raw, offsets), = tk.chunks(batch, "text")
    got = tk.split(raw, offsets)
    text = raw.tobytes()
    for d, row in enumerate(rows):
        own = [lower(text[a:b].decode()) for a, b in zip(got.start[got.bounds[d]:got.bounds[d + 1]], got.end[got.bounds[d]:got.bounds[d + 1]])]
        assert own == words(row)
    assert got.hash[0] == tk.split(np.frombuffer(b"a", np.uint8), np.array([0, 1])).hash[0]
    h, bounds = tk.shingles(got, 5)
    assert np.diff(bounds).tolist() == [1, 0, 0, 0, 1, 1, 2]
    assert len(set(h.tolist())) == 5


def test_chunks_cut_between_documents():
    rows = ["x" * n for n in (5, 0, 9, 1, 30)]
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])
    got = [(p.num_rows, len(raw)) for p, raw, _ in tk.chunks(batch, "text", 10)]
    assert sum(n for n, _ in got) == 5 and sum(b for _, b in got) == 45 and all(b <= 10 or n == 1 for n, b in got)


# MinHash

def brute_components(rows):
    """doc id -> (set size, component) by comparing all pairs."""
    sets = []
    for i, t in rows:
        w = words(t)
        sets.append((i, {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    comp = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                old, new = comp[a], comp[b]
                comp = [new if c == old else c for c in comp]
    out = []
    for a, (i, s) in enumerate(sets):
        ids = [sets[b][0] for b in range(len(sets)) if comp[b] == comp[a] and sets[b][0] is not None]
        out.append((i, len(s), min(ids) if ids else None))
    return sorted(out, key=repr)


def test_minhash_against_all_pairs(spark):
    rng = random.Random(3)
    rows = list(ODD_ROWS)
    for base in range(6):  # chains of edits: many pairs around the threshold
        w = prose(rng, 150).split()
        for k in range(14):
            v = list(w)
            for _ in range(rng.randrange(6)):
                v[rng.randrange(len(v))] = "edit" + str(rng.randrange(9))
            rows.append((100 * base + k + 10, " ".join(v)))
            if k % 5 == 4:
                w = v
    got = minhash.near_duplicates(docs_of(spark, rows)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr) == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_open_buckets_of_a_star(spark):
    """Copies of one text that mostly don't link with each other, and whose hub is a copy."""
    rng = random.Random(5)
    w = prose(rng, 140).split()
    rows = [(1000, " ".join(w))]
    for k in range(60):
        v = list(w)
        for j in rng.sample(range(len(v)), 2):
            v[j] = f"new{k}x{j}"
        rows.append((k, " ".join(v)))
    got = minhash.near_duplicates(docs_of(spark, rows)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr) == brute_components(rows)


def test_minhash_empty_and_clashing_columns(spark):
    empty = docs_of(spark, [])
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.stage(spark, empty, SF).count() == 0
    odd = docs_of(spark, [(1, "a b c"), (2, "a b c"), (3, "z")]).withColumn("k", F.lit(1)).withColumn("bands", F.lit(1)).withColumn("kept", F.lit(1))
    out = minhash.stage(spark, odd, SF)
    assert out.columns == odd.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_minhash_stage_keeps_one_of_each_group(spark):
    rows = [(9, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (None, "q"), (None, None)]
    out = minhash.stage(spark, docs_of(spark, rows), SF).collect()
    assert sorted([(r.doc_id, r.text) for r in out], key=repr) == sorted([(2, "a b c d e f"), (3, None), (4, ""), (None, "q"), (None, None)], key=repr)


# Decontamination

def edit_distance_in(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        prev, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (c != d))
    return min(row)


def test_myers_and_pieces():
    rng = random.Random(1)
    for _ in range(60):
        item = bytes(rng.choice(b"abc ") for _ in range(rng.randrange(1, 90)))
        text = bytes(rng.choice(b"abc ") for _ in range(rng.randrange(0, 120)))
        assert decontaminate.myers(item, text)[0] == edit_distance_in(item, text)
    item = decontaminate.normalise_one(prose(rng, 40))
    cuts = decontaminate.pieces(item)
    assert cuts[0] == 0 and cuts[-1] == len(item) and len(cuts) == int(0.05 * len(item)) + 2
    assert all(b - a >= decontaminate.PROBE for a, b in zip(cuts, cuts[1:])) and all(item[c] == 32 for c in cuts[:-1])
    assert decontaminate.normalise_one(None) == decontaminate.normalise_one(" .!") == b""


def test_decontamination_against_brute_force(spark):
    rng = random.Random(2)
    items = [(k, prose(rng, rng.randrange(8, 40))) for k in range(8)] + [(8, None), (9, ""), (10, "??"), (11, "tiny one"), (None, prose(rng, 20))]
    rows = list(ODD_ROWS) + [(20, "It is a TINY,  one!")]
    for k in range(60):
        text = prose(rng, 60).split()
        if k % 2:
            it = list(items[k % 8][1])
            for _ in range(rng.randrange(0, max(2, len(it) // 14))):
                it[rng.randrange(len(it))] = rng.choice("qz ")
            text.insert(rng.randrange(60), "".join(it))
        rows.append((100 + k, " ".join(text)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.matches(docs_of(spark, rows), bench).collect()}
    want = {}
    for i, t in rows:
        n = decontaminate.normalise_one(t)
        for j, s in items:
            p = decontaminate.normalise_one(s)
            if p and len(n) < 5000:
                d = edit_distance_in(p, n)
                if d <= len(decontaminate.pieces(p)) - 2:
                    want[i, j] = d
    assert got == want and len(want) > 20
    again = decontaminate.matches(docs_of(spark, []), bench)
    assert again.count() == 0 and decontaminate.matches(docs_of(spark, rows), bench.limit(0)).count() == 0


def test_decontamination_of_text_without_spaces(spark):
    """Items in scripts without spaces, in one long word, and of 20 to 23 bytes keep their whole budget."""
    rng = random.Random(5)
    han = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(60))
    thai = "".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(60))
    code = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(120))
    short = "abcdefghij klmnopqrs"
    items = [han, thai, code, short]
    rows, planted = [], set()
    for no, t in enumerate(items):
        at = len(t) // 2
        for form in (t, t[:at] + ("好" if no == 0 else "ฮ" if no == 1 else "X") + t[at + 1:]):
            before, after = (("前文", "後文") if no == 0 else ("กขค", "งจฉ") if no == 1 else ("some words ", " and others"))
            planted.add((len(rows), no))
            rows.append((len(rows), before + form + after))
    rows.append((99, "前文" + "".join(rng.sample(han, 60)) + "後文 " + code[::-1]))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.matches(docs_of(spark, rows), bench).collect()}
    assert set(got) == planted
    for (d, i), edits in got.items():
        assert edits == edit_distance_in(decontaminate.normalise_one(items[i]), decontaminate.normalise_one(rows[d][1]))


@pytest.mark.parametrize("texts", [["中a文", "", "b", "文中"], ["𠀀x", "ก", " ข ", "中"], ["", "中", ""]])
def test_normalised_bounds(texts):
    """Each document's slice of a batch is its own normal form."""
    raw = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    buf, bounds = decontaminate.normalise(np.frombuffer(raw, np.uint8), offsets)
    for i, t in enumerate(texts):
        assert buf[bounds[i]:bounds[i + 1]].tobytes().strip() == decontaminate.normalise_one(t).strip()


def test_decontamination_in_blocks(spark, monkeypatch):
    rng = random.Random(4)
    items = [(k, prose(rng, 15)) for k in range(6)]
    docs = docs_of(spark, [(k, "before " + t + " after") for k, t in items])
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    got = decontaminate.matches(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(k, k) for k in range(6)]


# Language model

def brute_lm(rows, held):
    def toks(t):
        return [*words(t), "\0"]

    one, two = Counter(), Counter()
    for (i, t), h in zip(rows, held):
        if not h:
            w = toks(t)
            one.update(w)
            two.update(zip(["\1", *w], w))
    n, v = sum(one.values()), len(one)
    one["\1"] = one["\0"]
    return toks, one, two, n, v


def test_language_model_against_plain_counts(spark):
    rng = random.Random(8)
    rows = [*ODD_ROWS, *((k, " ".join(rng.choice("a bb A c dd e".split()) for _ in range(rng.randrange(40)))) for k in range(10, 60))]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in rows]
    docs = docs_of(spark, rows).repartition(3)
    got = lm.score(docs, lm.fold("doc_id", 7) == 2).collect()
    toks, one, two, n, v = brute_lm(rows, held)
    # Deleted statistics of all training tokens, as they are: few enough to need no cells.
    cells = []
    for (i, t), h in zip(rows, held):
        if not h:
            w = toks(t)
            for c, x in zip(["\1", *w], w):
                ctx = one[c] - 1
                cells.append((ctx, (two[c, x] - 1) / ctx if ctx else 0.0, (one[x] - 1) / (n - 1)))
    mix = lm.weights([(int(lm.bucket(np.array([float(c)]))[0]) << 16, 1, p2, p1) for c, p2, p1 in cells], v)
    want = Counter()
    for (i, t), h in zip(rows, held):
        w = toks(t)
        base = sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w)
        s = 0.0
        for c, x in zip(["\1", *w], w):
            m = mix[int(lm.bucket(np.array([float(one[c])]))[0])]
            s += math.log10(m[0] * (two[c, x] / one[c] if one[c] else 0) + m[1] * one[x] / n + m[2] / (v + 1))
        want[i, h, len(w), sum(one[x] > 0 for x in w), n, round(base, 6), round(s, 1)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 1)) for r in got) == want
    # A better model of held-out texts than the base.
    some = [r for r in got if r.held_out and r.n_tokens > 3]
    assert sum(r.score for r in some) > sum(r.base_score for r in some)


def test_language_model_probabilities_sum_to_one(spark):
    """Over all continuations of a context, the model's probabilities and one unseen type make one."""
    toks, one, two, n, v = brute_lm([(1, "a b a c"), (2, "b b")], [False, False])
    mix = lm.weights([(1 << 16, 5, 2.0, 1.0), (2 << 16, 5, 1.0, 2.0)], v)
    types = [t for t in one if t != "\1"]
    for c in ("a", "b", "\1"):
        m = mix[int(lm.bucket(np.array([float(one[c])]))[0])]
        assert math.isclose(sum(m[0] * two[c, x] / one[c] + m[1] * one[x] / n + m[2] / (v + 1) for x in types) + m[2] / (v + 1), 1.0)


def test_language_model_memory_of_a_block(monkeypatch):
    """A block's tasks hold a bounded number of bytes a token."""
    monkeypatch.setattr(lm, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    rng = np.random.default_rng(1)
    known = np.array([f"w{i}" for i in range(30000)])
    words = [" ".join(known[(rng.random(250) ** 3 * 30000).astype(int)]) for _ in range(6000)]
    n = sum(len(x.split()) + 1 for x in words)

    def documents():
        for i in range(0, len(words), 500):
            yield pa.RecordBatch.from_arrays([pa.array(range(i, i + 500)), pa.array(words[i:i + 500]), pa.array([j % 7 != 2 for j in range(i, i + 500)])],
                                             names=["doc_id", "text", "train"])

    def peak(batches):
        tracemalloc.start()
        out = [b for b in batches]
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most / n

    asked, first = peak(lm._ask(4)(documents()))
    asked = pa.Table.from_batches(asked).sort_by([("part", "ascending"), ("kind", "ascending"), ("block", "ascending")]).combine_chunks().to_batches()
    answers = pa.Table.from_batches(list(lm._answer(iter(asked))))
    total, kinds = answers.filter(pa.compute.equal(answers["kind"], 0)), ["block", "kind", "part", "counts", "asked"]
    met = pa.concat_tables([answers.select(kinds), pa.Table.from_batches(list(lm._tagged(documents()))).cast(answers.select(kinds).schema)])
    met = met.sort_by([("block", "ascending"), ("kind", "ascending"), ("part", "ascending")]).combine_chunks().to_batches()
    tokens, known = float(pa.compute.sum(total["total"]).as_py()), pa.compute.sum(total["types"]).as_py()
    cells, second = peak(lm._cells(tokens)(iter(met)))
    scores, third = peak(lm._scores(tokens, known, np.full((lm.BUCKETS, 3), 1 / 3))(iter(met)))
    assert sum(pa.compute.sum(b["n"]).as_py() for b in cells) == tokens and sum(b.num_rows for b in scores) == len(words)
    assert first < 85 and second < 85 and third < 65


def test_language_model_blocks_and_empty(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {r.doc_id: r for r in lm.score(docs, lm.fold("doc_id", 7) == 2).collect()}
    monkeypatch.setattr(lm, "RANGE_BYTES", 50_000)  # more ranges, the same result
    for r in lm.score(docs, lm.fold("doc_id", 7) == 2).collect():
        assert (r.n_known, r.train_tokens) == (whole[r.doc_id].n_known, whole[r.doc_id].train_tokens)
        assert math.isclose(r.score, whole[r.doc_id].score, rel_tol=1e-9)
    assert lm.score(docs_of(spark, []), lm.fold("doc_id", 7) == 2).count() == 0
    none = lm.score(docs_of(spark, [(1, "a b")]), F.lit(True)).first()
    assert (none.train_tokens, none.n_known, none.base_score) == (0, 0, 0.0)


# Passages

def test_chains_and_alignment():
    got = passages.chains(np.array([0, 6, 12, 40, 300]), np.array([100, 106, 112, 141, 5]))
    assert got == [(0, 45, 100, 146)]
    rng = random.Random(6)
    for _ in range(40):
        a = np.array([rng.randrange(6) for _ in range(rng.randrange(0, 30))], np.uint32)
        b = np.array([rng.randrange(6) for _ in range(rng.randrange(0, 30))], np.uint32)
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, d in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (c != d))
        assert passages.distance(a, b) == row[-1]
    x = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9])
    assert [passages.extension(x, np.array(y)) for y in ([1, 2, 0, 4, 5, 6, 7], [1, 2, 0, 4, 5, 0], [0, 2, 3, 4], [0, 2, 3], [], [1, 2])] == [7, 2, 4, 0, 0, 2]


def test_passages_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(7)
    own = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    passage, rows, want = own(70).split(), list(ODD_ROWS), {}
    for k in range(40):
        p = list(passage)
        for _ in range(k % 4):
            p[rng.randrange(4, 66)] = own(1)
        before = rng.randrange(80)
        rows.append((100 + k, f"{own(before)} {' '.join(p)} {own(30)}"))
        want[100 + k] = (before, before + 70)
    rows += [(300 + k, own(200)) for k in range(20)]
    copy = own(120)
    rows += [(400, copy), (401, copy), (402, own(40) + " " + " ".join(passage[:30]))]
    got = {}
    for r in passages.shared_passages(docs_of(spark, rows).repartition(4)).collect():
        assert r.doc_id not in got and r.n_words == r.end_word - r.start_word and r.other_id != r.doc_id
        got[r.doc_id] = (r.start_word, r.end_word)
    assert set(got) == set(want) | {400, 401} and got[400] == got[401] == (0, 120)
    for d, (a, b) in want.items():  # edits close to an end may cost a few words there
        assert a <= got[d][0] <= a + 16 and b - 16 <= got[d][1] <= b, (d, got[d], a, b)
    assert sum(got[d] == want[d] for d in want) > 30
    assert passages.shared_passages(docs_of(spark, [])).count() == 0


def test_passages_over_parts(spark, monkeypatch):
    """However the corpus is cut, all copies of a passage are found."""
    rng = random.Random(9)
    own = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    passage = own(60)
    rows = [(k, f"{own(50)} {passage} {own(20)}" if k % 3 else own(150)) for k in range(60)]
    for parts in (1, 7, 30):
        got = passages.shared_passages(docs_of(spark, rows).repartition(parts)).collect()
        assert {r.doc_id for r in got} == {k for k in range(60) if k % 3}
        assert all(r.start_word == 50 and r.n_words == 60 for r in got)


def test_passages_on_both_sides_of_a_gap(spark):
    """Two passages of one pair, and a passage into which one document inserts words."""
    rng = random.Random(10)
    own = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    rows, want = [], {}
    for k, gap in enumerate((3, 20, 40, 90, 200, 400)):
        p, q = own(60 if gap < 400 else 300), own(60 if gap < 400 else 300)
        n = len(p.split())
        whole = [(10, 10 + 2 * n + gap)]
        for d in (0, 1):
            rows.append((10 * k + d, f"{own(10)} {p} {own(gap)} {q} {own(10)}"))
            want[10 * k + d] = whole if gap <= 20 else [(10, 10 + n), (10 + n + gap, 10 + 2 * n + gap)]
    p, q = own(60), own(60)
    rows += [(100, f"{own(5)} {p} {q} {own(5)}"), (101, f"{own(5)} {p} {own(80)} {q}")]
    want |= {100: [(5, 125)], 101: [(5, 65), (145, 205)]}
    got = {}
    for r in passages.shared_passages(docs_of(spark, rows).repartition(3)).collect():
        got.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    assert {d: sorted(v) for d, v in got.items()} == want


def test_passages_with_many_changed_words(spark):
    """60-word passages with one word in 10, 8 or 6 changed (90, 87.5 and 83 % equal)."""
    rng = random.Random(11)
    own = lambda n: [str(rng.randrange(10**6)) for _ in range(n)]
    rows = []
    for k in range(60):
        p = own(60)
        q = list(p)
        every = (10, 8, 6)[k % 3]
        for i in range(every - 1, 60 - every + 1, every):
            q[i] = own(1)[0]
        rows += [(2 * k, " ".join(own(20) + p + own(20))), (2 * k + 1, " ".join(own(20) + q + own(20)))]
    got = {r.doc_id: r.start_word for r in passages.shared_passages(docs_of(spark, rows).repartition(3)).collect()}
    assert set(got) == set(range(120)) and all(20 <= a <= 26 for a in got.values())


def test_passages_of_words_that_stand_elsewhere(spark):
    """Each short run of a shared passage stands first in a smaller document of its own."""
    rng = random.Random(12)
    own = lambda n: [str(rng.randrange(10**6)) for _ in range(n)]
    rows = []
    for k in range(6):
        p = own(55)
        for i in range(0, 50):
            for j in range(k % 3 * 2 + 1):  # in one, three or five documents
                rows.append((1000 * k + 10 * i + j, " ".join(own(8) + p[i:i + 5] + own(8))))
        rows += [(10_000 + 2 * k + c, " ".join(own(15) + p + own(15))) for c in (0, 1)]
    got = {r.doc_id: (r.start_word, r.end_word) for r in passages.shared_passages(docs_of(spark, rows).repartition(3)).collect()}
    assert got == {10_000 + d: (15, 70) for d in range(12)}


def test_pieces_of_several_documents_are_no_passage(spark):
    """Three 20-word pieces of three documents side by side share 20 words with each, no passage;
    two passages of two documents that touch are one."""
    rng = random.Random(13)
    own = lambda n: [str(rng.randrange(10**6)) for _ in range(n)]
    p = [own(20) for _ in range(3)]
    rows = [(i, " ".join(own(30) + p[i] + own(30))) for i in range(3)] + [(3, " ".join(own(30) + sum(p, []) + own(30)))]
    q, r = own(60), own(70)
    rows += [(10, " ".join(own(30) + q + own(30))), (11, " ".join(own(30) + r + own(30))), (12, " ".join(own(30) + q + r + own(30)))]
    for parts in (1, 3):
        got = {x.doc_id: (x.start_word, x.end_word) for x in passages.shared_passages(docs_of(spark, rows).repartition(parts)).collect()}
        assert got == {10: (30, 90), 11: (30, 100), 12: (30, 160)}


def test_passages_whose_seeds_are_all_frequent(spark):
    """Every run of 20 words of a shared passage stands in documents before both of its two and between them."""
    rng = random.Random(14)
    own = lambda n: [str(rng.randrange(10**6)) for _ in range(n)]
    p, rows = own(55), []
    for i in range(36):
        for j in (0, 100, 2000, 2100, 2200):
            rows.append((j + i, " ".join(own(8) + p[i:i + 20] + own(8))))
    rows += [(1000, " ".join(own(15) + p + own(15))), (3000, " ".join(own(5) + p + own(15)))]
    for parts in (1, 5):
        got = {r.doc_id: (r.start_word, r.end_word, r.other_id) for r in passages.shared_passages(docs_of(spark, rows).repartition(parts)).collect()}
        assert got == {1000: (15, 70, 3000), 3000: (5, 60, 1000)}


def test_all_equal_runs_of_a_passage_length_are_found(spark):
    """Against brute force, on texts cut from a few sources so that most seeds are in many documents; ids repeat."""
    rng = random.Random(15)
    sources = [[f"w{rng.randrange(300)}" for _ in range(130)] for _ in range(3)] + [["a", "b"] * 65]
    rows = []
    for d in range(150):
        text = []
        for _ in range(rng.randrange(1, 4)):
            s, n = rng.choice(sources), rng.choice((12, 25, 49, 50, 51, 70))
            i = rng.randrange(len(s) - n)
            text += s[i:i + n] + [f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(12))]
        rows.append((d - d % 40 // 39, " ".join(text)))
    rows += [(-1, None), (-2, ""), (None, rows[0][1]), (-3, " ".join(rows[5][1].split()[:49]))]
    n, runs = passages.MIN_WORDS, {}
    for d, text in rows:
        words = (text or "").split()
        for i in range(len(words) - n + 1):
            runs.setdefault(tuple(words[i:i + n]), []).append((d, i))
    want = {x for at in runs.values() if len({d for d, _ in at} - {None}) > 1 for x in at if x[0] is not None}
    assert len(want) > 1000
    for parts in (1, 6):
        got: dict[int, list] = {}
        for r in passages.shared_passages(docs_of(spark, rows).repartition(parts)).collect():
            got.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
        assert [x for x in want if not any(a <= x[1] and x[1] + n <= b for a, b in got.get(x[0], []))] == []


def test_equal_windows_are_grouped_part_by_part():
    """Of equal windows those of two documents leave a part, the others are passages at once; none is lost or made up."""
    rng = np.random.default_rng(16)
    key, doc, start = rng.integers(0, 40, 400).astype(np.uint64), rng.integers(-5, 30, 400), rng.integers(0, 10**4, 400)
    docs_at = {k: sorted(set(doc[key == k].tolist())) for k in key.tolist()}
    want = [min(set(docs_at[k]) - {d}, default=d) for k, d in zip(key.tolist(), doc.tolist(), strict=True)]
    order = passages.order_of(key, doc, start)
    assert passages._shared(key[order], doc[order]).tolist() == np.array(want)[order].tolist()
    key = tk.mix(key)
    text = " ".join(rng.choice(["a", "b", "c"], 400))
    whole = tk.split(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    for long in ([], [0], [7, 9, 200], [380], [-0, 350, 399]):
        got = passages.windows_of(whole, np.array(long, np.int32))
        n = passages.MIN_WORDS
        assert got[2].tolist() == [i for i in range(400 - n + 1) if any(i <= q <= i + n - passages.LONG for q in long)]
        for i, k, by in zip(got[2].tolist(), got[0], got[1], strict=True):  # wherever it stands
            own = tk.Words(whole.hash[i:i + n], whole.start, whole.end, np.array([0, n]))
            assert [c.tolist() for c in passages.windows_of(own, np.array([3], np.int32))] == [[int(k)], [int(by)], [0]]
    rows = []
    for part in range(3):
        at = np.arange(part, 400, 3)
        rows += [r for b in passages._windows([(key[at], key[at] + np.uint64(1), start[at], doc[at])], 64) for r in b.to_pylist()]
    rows.sort(key=lambda r: (r["pair"], r["no"], r["side"]))
    batch = pa.RecordBatch.from_pylist(rows, schema=pa.schema([(c, {"words": pa.binary(), "runs": pa.binary()}.get(c, pa.int64())) for c in passages._CUT]))
    got = [r for b in passages._align(iter([batch])) for r in b.to_pylist()]
    assert any(r["side"] for r in rows) and all(r["other_id"] != r["doc_id"] for r in got)
    for d, i, o in zip(doc.tolist(), start.tolist(), want, strict=True):
        inside = any(r["doc_id"] == d and r["start_word"] <= i and i + passages.MIN_WORDS <= r["end_word"] for r in got)
        assert inside or o == d


def test_only_chains_that_may_be_in_a_passage_are_aligned():
    """A line of 15 words and 34 words beside it are too short; a chain of 16 words, or two that touch, may do."""
    assert passages.hopeful([]) == set()
    assert passages.hopeful([[(100, 7, 15)]]) == set()
    assert passages.hopeful([[(100, 7, 16)]]) == {0}
    assert passages.hopeful([[(100, 7, 15)], [(400, 400, 15)], [(150, 900, 15)]]) == {0, 2}
    assert passages.hopeful([[(100, 7, 15)], [(155, 900, 15)]]) == set()
    assert passages.hopeful([[(100, 7, 6), (104, 30, 6)]]) == {0}  # long in the other document only
    rows = []
    for other, words in ((2, 15), (3, 16), (4, 6)):
        pos = np.arange(words - 4)
        rows.append([np.full(len(pos), 1), pos + 90, np.full(len(pos), other), pos + 40])
    links = [np.concatenate(c).astype(np.int64) for c in zip(*rows, strict=True)]
    batches = list(passages._dealt(np.zeros(len(links[0]), np.int64), 1, links))
    got = [r for b in passages._chain(iter(batches)) for r in b.to_pylist()]
    assert [(r["doc"], r["other"], r["start"], r["end"]) for r in got] == [(1, 3, 90, 106)]


def test_orders_windows_and_bounds_of_passages():
    """Faster forms against plain ones: sorts, window minima, extensions, least edits."""
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 50, 2000):
        key, doc, pos = rng.integers(0, n + 1, n).astype(np.uint64), rng.integers(0, 5, n), rng.integers(0, 9, n)
        order = passages.order_of(key, doc, pos)
        want = np.lexsort((pos, doc, key))
        assert sorted(order.tolist()) == list(range(n))
        assert all(np.array_equal(c[order], c[want]) for c in (key, doc, pos))
        assert np.array_equal(passages.order_of(key, np.arange(n)), np.argsort(key, kind="stable"))
    for w in (1, 2, 3, 16, 31):
        for high in (3, 10**6):
            v = rng.integers(0, high, 200).astype(np.uint64)
            assert passages.least_of(v, w).tolist() == [i + int(v[i:i + w].argmin()) for i in range(200 - w + 1)]
    for _ in range(300):
        x, y = (rng.integers(0, 2, rng.integers(0, 20)).astype(np.uint32) for _ in range(2))
        n, at = min(len(x), len(y)), 0
        while True:
            while at < n and x[at] == y[at]:
                at += 1
            if at + 4 > n or (x[at + 1:at + 4] != y[at + 1:at + 4]).any():
                break
            at += 4
        assert passages.extension(x, y) == at
        x, y = (rng.integers(0, 12, rng.integers(0, 20)).astype(np.uint32) for _ in range(2))
        assert passages.edits_at_least(x, y) <= passages.distance(x, y)


def test_orders_and_extensions_of_many():
    """Packed sorts against lexicographic ones, also beyond 62 bits; many extensions and differences at once against single ones."""
    rng = np.random.default_rng(8)
    for n in (0, 1, 2, 500):
        for high in (3, 10**6, 1 << 40, 1 << 61, (1 << 63) - 1):
            cols = [rng.integers(-high, high, n) for _ in range(2)] + [rng.integers(0, 4, n), rng.integers(0, high, n)]
            order, want = passages.packed_order(*cols), np.lexsort(cols[::-1])
            assert all(np.array_equal(c[order], c[want]) for c in cols)
    words = rng.integers(0, 2, 2000).astype(np.uint32)
    words[500:900] = words[1100:1500]
    a, b = np.append(rng.integers(300, 900, 200), [500, 510]), np.append(rng.integers(1000, 1400, 200), [1100, 1110])
    n = np.append(rng.integers(0, 200, 200), [400, 390])
    plain = [(words[i:i + k], words[j:j + k]) for i, j, k in zip(a.tolist(), b.tolist(), n.tolist(), strict=True)]
    assert passages.extensions(words, a, b, n, 1).tolist() == [passages.extension(x, y) for x, y in plain]
    assert passages._differing(words, a, b, n).tolist() == [int((x != y).sum()) for x, y in plain]
    plain = [(words[i - k + 1:i + 1][::-1], words[j - k + 1:j + 1][::-1]) for i, j, k in zip(a.tolist(), b.tolist(), n.tolist(), strict=True)]
    assert passages.extensions(words, a, b, n, -1).tolist() == [passages.extension(x, y) for x, y in plain]


def test_chains_are_judged_together_as_one_by_one():
    """Segments of chains with edits of all kinds, against pieces that are extended and aligned one by one."""
    rng = np.random.default_rng(17)
    ints = {"pair": pa.int64(), "no": pa.int32(), "side": pa.int32(), "doc": pa.int64(), "start": pa.int32(), "end": pa.int32(), "low": pa.int32()}
    rows, want = [], []
    for pair in range(400):
        x = rng.integers(0, 1 << 31, int(rng.integers(30, 160)))
        y, i = [], 0
        rate = (0.02, 0.1, 0.2, 0.3)[pair % 4]
        while i < len(x):
            kind = rng.random() / rate
            y += [x[i]] if kind > 1 else rng.integers(0, 1 << 31, int(rng.integers(1, 4 if pair % 3 else 30))).tolist() if kind > 0.3 else []
            i += 1 if kind > 0.6 or kind < 0.3 else 0
        if pair % 5 == 0:  # a second place of the same words
            y += rng.integers(0, 1 << 31, int(rng.integers(0, 60))).tolist() + x[:40].tolist()
        x, y = x.astype(np.uint32), np.array(y, np.uint32)
        at: dict[tuple, list[int]] = {}
        for j in range(len(y) - passages.K + 1):
            at.setdefault(tuple(y[j:j + passages.K].tolist()), []).append(j)
        links = [(i, j) for i in range(len(x) - passages.K + 1) for j in at.get(tuple(x[i:i + passages.K].tolist()), [])]
        if not links:
            continue
        own = []
        runs = passages.runs_of(np.zeros(len(links), np.int64), *np.array(links).T)[1:]
        for no, c in enumerate(passages.chained(*(v.tolist() for v in runs))):
            (i, j, _), (i2, j2, n) = c[0], c[-1]
            low, low2 = max(0, i - passages.MARGIN), max(0, j - passages.MARGIN)
            u, v = x[low:i2 + n + passages.MARGIN], y[low2:j2 + n + passages.MARGIN]
            for side, d, lo, w, r in ((0, 900, low, u, np.array(c, np.int32).tobytes()), (1, pair, low2, v, None)):
                rows.append({"pair": pair, "no": no, "side": side, "doc": d, "start": 0, "end": 0, "low": lo, "words": w.tobytes(), "runs": r})
            near = [(p - low, q - low2, k) for p, q, k in c]
            back = [passages.extension(u[:p][::-1], v[:q][::-1]) for p, q, _ in near]
            on = [passages.extension(u[p + k:], v[q + k:]) for p, q, k in near]
            for s, e, s2, e2 in passages.pieces(u, v, near, back, on, [False] * len(near), False):
                own += [(900, low + s, low + e, pair), (pair, low2 + s2, low2 + e2, 900)]
        want += [r for r in passages._merge(own) if r[2] - r[1] >= passages.MIN_WORDS]
    schema = pa.schema([(c, ints.get(c, pa.binary())) for c in passages._CUT])
    assert 200 < len(want) < 800
    for size in (len(rows), 7):  # pairs that lie in several batches, too
        batches = pa.Table.from_pylist(rows, schema=schema).to_batches(max_chunksize=size)
        got = [tuple(r.values()) for b in passages._align(iter(batches)) for r in b.to_pylist()]
        assert passages._merge(got) == passages._merge(want)


def test_a_text_moves_once_however_many_segments_it_has(spark):
    """Texts meet their segments without a copy for each; of rows that repeat an id, the longest text has the segments."""
    rng = random.Random(18)
    own = lambda n: [str(rng.randrange(10**6)) for _ in range(n)]
    parts = [own(60) for _ in range(12)]
    rows = [(1, " ".join(w for p in parts for w in p + own(100)))] + [(10 + i, " ".join(own(20) + p)) for i, p in enumerate(parts)]
    rows += [(1, " ".join(own(30))), (1, None)]
    found = passages.shared_passages(docs_of(spark, rows).repartition(3))
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.doc_id, r.start_word, r.end_word) for r in found.collect())
    assert got == [(1, 160 * i, 160 * i + 60) for i in range(12)] + [(10 + i, 20, 80) for i in range(12)]
    taken = []
    h = tk.split(np.frombuffer(rows[0][1].encode(), np.uint8), np.array([0, len(rows[0][1])])).hash.astype(np.uint32)
    cells = [{"doc": 1, "rank": 1, "size": -len(rows[0][1]), "text": rows[0][1]}] + [
        {"doc": 1, "rank": 2, "size": 0, "pair": i, "no": 0, "side": 0, "start": 160 * i, "end": 160 * i + 60, "runs": b"x"} for i in range(12)]
    schema = pa.schema([("doc", pa.int64()), ("rank", pa.int32()), ("size", pa.int32()), ("text", pa.string()), ("pair", pa.int64()), ("no", pa.int32()), ("side", pa.int32()),
                        ("start", pa.int32()), ("end", pa.int32()), ("runs", pa.binary())])
    for b in passages._slices(iter(pa.Table.from_pylist(cells, schema=schema).to_batches(max_chunksize=5)), 64):
        taken += b.to_pylist()
    assert [(r["pair"], r["low"], r["runs"]) for r in taken] == [(i, max(0, 160 * i - passages.MARGIN), b"x") for i in range(12)]
    assert all(r["words"] == h[r["low"]:r["end"] + passages.MARGIN].tobytes() for r in taken)


# Toxicity

def test_index_finds_the_nearest_by_exact_cosine():
    rng = np.random.default_rng(1)
    terms, idf = np.arange(40, dtype=np.uint64), rng.uniform(1, 5, 40)
    vec = []
    for _ in range(500):
        t = np.sort(rng.choice(40, rng.integers(0, 6), replace=False))
        vec.append((t, rng.integers(1, 5, len(t))))
    index = toxicity.Index(terms, idf, vec, rng.integers(0, 2, 500).astype(float), np.arange(500))
    dense = np.zeros((500, 40))
    for i, (t, c) in enumerate(vec):
        u, w = index.unit(t, c)
        dense[np.flatnonzero(index.ids == i)[0], u] = w
    for t, c in vec[:80]:
        u, w = index.unit(t, c)
        q = np.zeros(40)
        q[u] = w
        cos = dense @ q
        rows, got = index.nearest(u, w, 7)
        best = sorted(((-round(s, 12), r) for r, s in enumerate(cos) if s > 1e-15))[:7]
        assert [r for _, r in best] == rows.tolist() and np.allclose([-s for s, _ in best], got)


def test_index_leaves_blocks_shut():
    """Long lists of little weight are bounded by block: few blocks open, and the nearest are the same."""
    rng = np.random.default_rng(2)
    topics, common = 60, 30
    terms = np.arange(common + 8 * topics, dtype=np.uint64)
    idf = np.where(terms < common, 0.2, 6.0)
    vec = []
    for i in range(1200):
        own = common + 8 * (i % topics) + rng.choice(8, 6, replace=False)
        t = np.sort(np.concatenate([rng.choice(common, 20, replace=False), own]))
        vec.append((t, rng.integers(1, 4, len(t))))
    index = toxicity.Index(terms, idf, vec, rng.integers(0, 2, 1200).astype(float), np.arange(1200))
    dense = np.zeros((1200, len(terms)))
    for i, (t, c) in enumerate(vec):
        u, w = index.unit(t, c)
        dense[np.flatnonzero(index.ids == i)[0], u] = w
    postings = sum((dense[:, t] > 0).sum() for t, _ in vec[:100])
    for i, (t, c) in enumerate(vec[:100]):
        u, w = index.unit(t, c)
        own = int(np.flatnonzero(index.ids == i)[0])
        cos = dense[:, u] @ w
        cos[own] = 0.0
        best = sorted(((-round(s, 12), r) for r, s in enumerate(cos) if s > 1e-15))[:9]
        assert [r for _, r in best] == index.nearest(u, w, 9, skip=own)[0].tolist()
    assert index.opened < 0.2 * 100 * index.blocks and index.read < 0.3 * postings


def test_toxicity_of_a_repeated_labelled_id(spark):
    """Of two texts of a labelled id one example is made, the same in any order of the rows."""
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"w{i} foul" if i % 2 else f"w{i} fair") for i in ids] + [(ids[0], "quite another text")]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    got = []
    for some in (rows, rows[::-1]):
        index = toxicity.fit(docs_of(spark, some).repartition(3), labels)
        got.append((index.ids.tolist(), index.weights.tolist()))
    assert got[0] == got[1] and sorted(got[0][0]) == ids


def test_toxicity_finds_copies_of_examples_with_rare_words(spark):
    """A copy of a toxic example none of whose words tells the classes apart has that neighbour."""
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"rare{i}a rare{i}b rare{i}c " + ("foul" if i % 2 and i > 9 else "fair")) for i in ids]
    rows = [(i, t.rsplit(" ", 1)[0]) if i <= 9 else (i, t) for i, t in rows]
    odd = [i for i in ids if i <= 9]
    docs = docs_of(spark, rows + [(1000 + i, dict(rows)[i]) for i in odd])
    index = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, index).collect()}
    assert all(got[1000 + i].neighbours[0] == i and got[1000 + i].cosines[0] > 0.999 for i in odd)
    assert all((got[1000 + i].score >= 0.5) == (i % 2 == 1) for i in odd)


def test_toxicity_held_out_accuracy_and_edges(spark):
    sf = "/root/testdata/sf0.01"
    rows = toxicity.op2_toxicity(spark, sf).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.93
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet").unionByName(docs_of(spark, ODD_ROWS))
    index = toxicity.fit(docs.withColumn("score", F.lit(1)), spark.read.parquet(f"{sf}/labels.parquet").withColumn("text", F.lit("x")))
    odd = toxicity.score(docs_of(spark, ODD_ROWS).withColumn("toxic", F.lit(1)), index).collect()
    assert len(odd) == len(ODD_ROWS) and all(0 <= r.score < 0.5 for r in odd)
    assert toxicity.score(docs_of(spark, []), index).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 1), (1, 1, 0)], [(None, 1, 1), (2, 1, None)]])
def test_toxicity_without_usable_labels(spark, labels):
    docs = docs_of(spark, ODD_ROWS)
    index = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert all(r.score < 0.5 for r in toxicity.score(docs, index).collect())
