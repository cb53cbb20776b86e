"""Comparison by content against a plain one in Python."""

import collections
import random

from ledgerwatch.operators.reconcile import differing_keys, differing_ranges

COLS = "k string, x string, y string"


def _expected(src, hist):
    s, h = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for side, rows in ((s, src), (h, hist)):
        for k, *rest in rows:
            if k is not None:
                side[k][tuple(rest)] += 1
    return {k: "missing" if k not in h else "extra" if k not in s else "differs"
            for k in s.keys() | h.keys() if s.get(k) != h.get(k)}


def _found(spark, src, hist, ranges=64):
    got = differing_keys(spark.createDataFrame(src, COLS), spark.createDataFrame(hist, COLS), "k", ["x", "y"], ranges).collect()
    assert len({r.key for r in got}) == len(got)
    return {r.key: r.kind for r in got}


def test_planted_differences_are_found(spark):
    rng = random.Random(5)
    src = [(f"k{i}", rng.choice(["a", "b", "", None]), rng.choice(["a", "b", "", None])) for i in range(2000)]
    hist = list(src)
    rng.shuffle(hist)
    assert _found(spark, src, hist) == {}
    at = {k: n for n, (k, _, _) in enumerate(hist)}
    hist[at["k7"]] = ("k7", "other", None)
    hist[at["k8"]] = ("k8", src[8][1], "other")
    hist = [r for r in hist if r[0] not in ("k100", "k101")] + [("new", "a", "a")]
    exp = _expected(src, hist)
    assert exp == {"k7": "differs", "k8": "differs", "k100": "missing", "k101": "missing", "new": "extra"}
    for ranges in (1, 64, 4096):
        assert _found(spark, src, hist, ranges) == exp


def test_nulls_moves_and_repeated_rows(spark):
    src = [("n", None, "a"), ("m", "a", "b"), ("r", "a", "a"), ("r", "a", "a"), ("q", "b", "b"), (None, "a", "a"), ("e", "", None),
           ("t", "1", "1"), ("t", "1", "1"), ("t", "2", "2"), ("u", "ab", "c")]
    hist = [("n", "a", None), ("m", "b", "a"), ("r", "a", "a"), ("q", "b", "b"), ("q", "b", "b"), (None, "b", "b"), ("e", None, ""),
            ("t", "3", "3"), ("t", "3", "3"), ("t", "2", "2"), ("u", "a", "bc")]
    exp = _expected(src, hist)
    assert set(exp) == {"n", "m", "r", "q", "e", "t", "u"}
    assert _found(spark, src, hist) == exp
    assert _found(spark, src, []) == dict.fromkeys("nmrqetu", "missing")
    assert _found(spark, [], hist) == dict.fromkeys("nmrqetu", "extra") and _found(spark, [], []) == {}


def test_one_vanished_key_reads_one_range(spark):
    src, hist = spark.range(5000).selectExpr("concat('k', id) as k").where("k <> 'k77'"), spark.range(5000).selectExpr("concat('k', id) as k")
    assert differing_ranges(src, hist, "k", [], 512).count() == 1
    assert [tuple(r) for r in differing_keys(src, hist, "k", [], 512).collect()] == [("k77", "extra")]
    plan = differing_keys(src, hist, "k", [], 512)._jdf.queryExecution().executedPlan().toString()
    # Only what lies in the ranges found is dealt by key, and counted before that.
    lines = plan.split("\n")
    at = next(n for n, line in enumerate(lines) if "hashpartitioning(key#" in line)
    assert "HashAggregate" in lines[at + 1] and any("LeftSemi" in line for line in lines[at + 1:at + 5])
