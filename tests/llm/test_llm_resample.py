"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerwatch.llm import resample as rs

DOCS = "doc_id long, text string, rank string, bucket string, __part int, weight int, able int"


def features_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]], len(w)


def brute(docs, target, percent=25, seed=7):
    s, t = (Counter(b for text in texts for b in features_of(text)[0]) for texts in ([d[1] for d in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (t_all * 0 + s_all + 10_000) / ((s[b] + 1.0) * (t_all + 10_000)))) for b in range(10_000)]
    out = []
    for i, text in docs:
        f, n = features_of(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), n >= rs.MIN_WORDS))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = percent * len(able) // 100
    return Counter((*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)) + Counter((*r[:4], None) for r in out if not r[4])


def run(spark, docs, target, **kw):
    df = spark.createDataFrame([(i, x, "r", "b", 1, 2, 3) for i, x in docs], DOCS)
    got = rs.resample(df, spark.createDataFrame([(x,) for x in target], "text string"), **kw)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return Counter(map(tuple, got.collect()))


ODD = [(None, None), (None, "a " * 25), (1, None), (2, ""), (3, " \n--"), (4, "One, two: ONE two 3"), (5, "w" * 70 + " " + "v" * 200 + " ok " * 30),
       (6, "é ü 漢字 😀 " * 30), (7, "same text here " * 10), (8, "same text here " * 10), (8, "same text here " * 10), (9, "x y " * 60_000), (10, "q" * 1_000_000)]


@pytest.mark.parametrize("percent", [25, 100, 0])
def test_against_plain_python(spark, percent):
    docs = ODD + [(100 + i, " ".join(f"w{(i * k) % 37}" for k in range(1, 30 + i % 7))) for i in range(60)]
    target = ["W1 w2 w3", None, "", "漢字 here text same", "w5 w10 w15 w20"]
    assert run(spark, docs, target, percent=percent) == brute(docs, target, percent)


def test_empty_tables(spark):
    assert not run(spark, [], ["a"])
    assert run(spark, ODD, []) == brute(ODD, [])


def test_planes_give_exact_sums():
    rng = np.random.default_rng(5)
    gain = rng.integers(-30_000, 30_000, rs.BUCKETS)
    doc, bucket = rng.integers(0, 300, 40_000), rng.integers(0, rs.BUCKETS, 40_000) ** 2 % rs.BUCKETS
    doc[:9000], bucket[:9000] = 7, 3  # one count of many bits
    want = np.bincount(doc, weights=gain[bucket], minlength=301).astype(np.int64)
    assert (rs.summed(doc, bucket, 301, *rs.sliced(gain)) == want).all()
    assert (rs.summed(doc[:0], bucket[:0], 2, *rs.sliced(gain * 0)) == 0).all()


def test_registers_match_zlib():
    raw = np.frombuffer(b"".join(bytes([65 + i % 50]) * i for i in range(150)), np.uint8)
    end = np.cumsum(np.arange(150))
    got = rs._crc(np.full(150, 0xFFFFFFFF, np.uint32), raw, end - np.arange(150), end) ^ np.uint32(0xFFFFFFFF)
    assert got.tolist() == [zlib.crc32(raw[e - i:e].tobytes()) for i, e in enumerate(end)]
