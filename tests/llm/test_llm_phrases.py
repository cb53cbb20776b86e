"""Phrase collocations: filters round trip, counts and scores against plain Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerwatch.llm import phrases as ph

DOCS = "doc_id long, text string, lang string, rank string, word int, block long, n int, gram string"


def brute(docs, least, most_words, top, percent=100):
    n, f = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most_words + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    often = {k: a for k, a in f.items() if a >= least}
    found = {}
    for (lang, g), a in often.items():
        if len(g) < 2:
            continue
        holders = [b for (o, h), b in often.items() if o == lang and len(h) > len(g) and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))]
        if any(100 * b >= percent * a for b in holders):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
        found.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, rows in found.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]))


def frame(spark, docs):
    return spark.createDataFrame([(i, t, lang, "r", 1, 2, 3, "g") for i, t, lang in docs], DOCS)


ODD = [(None, None, None), (1, None, "en"), (2, "", "en"), (3, " .,\n;", None), (4, "One one ONE one one", "en"), (4, "One one ONE one one", "en"),
       (5, "a b\tc. a b c! a b\x01c a b c", None), (6, "é 漢字 é 漢字 é", "fr"), (7, "one one", "fr"), (8, "x y " * 20_000, "en"), (9, "z" * 300_000 + " z z", "en")]


@pytest.mark.parametrize("least, top, percent", [(2, 2000, 100), (3, 4, 100), (2, 50, 60)])
def test_against_plain_python(spark, least, top, percent):
    rng = np.random.default_rng(least)
    docs = ODD + [(50 + i, " ".join(rng.choice(["the", "a", "cat", "sat", "on", "mat,", "dog."], 25)), ["en", "de", None][i % 3]) for i in range(90)]
    got = ph.mine(frame(spark, docs), least, 5, top, percent)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(docs, least, 5, top, percent)


def test_empty_table_and_none_frequent(spark):
    assert ph.mine(frame(spark, [])).count() == 0
    assert ph.mine(frame(spark, [(1, "a b c", "en")])).count() == 0


@pytest.mark.parametrize("words, bits", [(2, 16), (2, 25), (3, 20), (3, 32), (4, 33), (5, 16), (5, 25), (5, 40)])
def test_packing_is_invertible(words, bits):
    rng = np.random.default_rng(words * bits)
    ids = rng.integers(0, 1 << bits, (2000, words))
    ids[:4] = [[0] * words, [(1 << bits) - 1] * words, [0] * (words - 1) + [1], [1] + [0] * (words - 1)]
    p = ph.Packing(words, bits)
    limbs = p.pack(ids)
    whole = [sum(int(x) << p.bits * (words - 1 - k) for k, x in enumerate(row)) for row in ids]
    assert [sum(int(x) << p.width * (p.limbs - 1 - j) for j, x in enumerate(row)) for row in zip(*limbs)] == whole
    mixed = p.permute(limbs)
    assert all((x <= p.mask).all() for x in mixed)
    assert (p.unpack(p.restore(mixed)) == ids).all()
    slots = np.bincount((mixed[0][4:] >> np.uint64(p.width - 4)).astype(int), minlength=16)
    assert slots.min() > 60  # spread evenly


def test_filters_round_trip_and_merge():
    rng = np.random.default_rng(1)
    for words, bits, slots in ((2, 16, 6), (3, 24, 7), (5, 25, 6)):
        layout = ph.Filter(ph.Packing(words, bits), slots)
        want, batches = Counter(), []
        for block in range(4):
            ids = rng.integers(0, 40, (3000, words))
            keys, place, _ = ph.distinct(layout.packing.permute(layout.packing.pack(ids)))
            counts = np.bincount(place) * rng.choice([1, 300], len(keys[0]))
            for row, c in zip(layout.packing.unpack(layout.packing.restore(keys)).tolist(), counts.tolist()):
                want[tuple(row)] += c
            batches.append(layout.rows(keys, counts, block))
        rows = pa.Table.from_batches(batches).sort_by("slot")
        got = Counter()
        for slot, part in ph.groups(iter(rows.to_batches(max_chunksize=7)), "slot"):
            limbs, counts, sizes = layout.read(int(slot), part)
            assert sizes.sum() == len(counts) and (layout.slot_of(limbs) == slot).all()
            for row, c in zip(layout.packing.unpack(layout.packing.restore(limbs)).tolist(), counts.tolist()):
                got[tuple(row)] += c
        assert got == want


def test_stretches_hold_exactly_the_alive_grams():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3):
        tokens = rng.integers(0, 6, 400)
        alive = rng.random(400) < 0.6
        alive[400 - n + 1:] = False
        kept = ph.stretches(tokens, n, alive)
        got = Counter(tuple(kept[i:i + n + 1]) for i in ph.grams(kept, n + 1))
        assert got == Counter(tuple(tokens[i:i + n + 1]) for i in range(400 - n) if alive[i] and alive[i + 1])


def test_tokens_pack():
    for tokens in ([], [-1], [3, -1, 0, 2 ** 31 - 1], [2 ** 40, -1, 5]):
        assert ph.unpacked(ph.packed(np.array(tokens, np.int64))).tolist() == tokens


def test_dictionary_join_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(ph, "FEW_WORDS", 0)
    monkeypatch.setattr(ph, "BLOCK", 64)
    docs = ODD[:8] + [(50 + i, "a b c d. b c d a b", "en") for i in range(20)]
    assert sorted(map(tuple, ph.mine(frame(spark, docs), 2).collect())) == brute(docs, 2, 5, 2000)
