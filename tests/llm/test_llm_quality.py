"""Line labelling: base figures against plain Python, the field against enumeration, verdicts held out."""

import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import quality as q
from ledgerwatch.llm import tokens as tk
from ledgerwatch.llm.common import fold

DOCS = "doc_id long, text string, kept string, place int, n_words string, content int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    twice = {i + k for i, t in enumerate(zip(w, w[1:], w[2:])) if windows[t] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(twice) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice), failed


ODD = [(None, None), (None, "a b"), (1, None), (2, ""), (3, "\n\n \r\n"), (4, "A a A a A a"), (5, "x y z\nx y z\n\nx y z "), (5, "x y z\nx y z\n\nx y z "),
       (6, "é ü 漢字 😀 " * 30 + "\n# $ %"), (7, "w" * 1_000_000), (8, "one two three four " * 50_000), (9, "\n" * 5000 + "end"), (10, "a b c\x0bd\x0ce a b c"),
       (11, " ".join(f"w{i}" for i in range(60)) + "\n" + "|".join("ab" * 20)), (12, "X\ny\nX\ny\nX")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, "n", 2) for i, t in rows], DOCS)


def test_base_figures_and_empty_field(spark):
    got = q.judge(frame(spark, ODD), q.EMPTY, with_content=True).collect()
    assert Counter((r.doc_id, *r[1:7]) for r in got) == Counter((i, *base(t)) for i, t in ODD)
    assert all(r.kept is not r.base_failed and r.n_boilerplate == 0 for r in got)
    texts = {r.doc_id: r.content for r in got if r.doc_id in range(6, 13)}
    assert all(texts[i] == t for i, t in ODD if i in texts)
    assert Counter(r.n_lines for r in got) == Counter((t or "").count("\n") + 1 for _, t in ODD)
    assert q.judge(frame(spark, []), q.EMPTY).count() == 0


def test_lines_do_not_depend_on_neighbours(spark):
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in ODD])], names=["text"])
    raw, offsets = tk.texts(batch.column(0))
    together = q.lines_of(raw, offsets)
    for d, (_, text) in enumerate(ODD):
        alone = q.lines_of(*tk.texts(pa.array([text], pa.string())))
        a, b = together.bounds[d:d + 2]
        assert (alone.bins == together.bins[a:b]).all() and (alone.words == together.words[a:b]).all()


def all_scores(field, score):
    for states in itertools.product((0, 1), repeat=len(score)):
        s = field.begin[states[0]] + sum(x * e for x, e in zip(states, score))
        yield states, s + sum(field.follow[a, b] for a, b in zip(states, states[1:]))


def test_decoding_and_expectations_against_enumeration():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 8):
        field = q.Field(np.zeros((len(q.FEATURES), q.BINS)), rng.normal(size=2), rng.normal(size=(2, 2)) * 2)
        score = rng.normal(size=n) * 2
        table = dict(all_scores(field, score))
        assert tuple(q.viterbi(field, score, np.array([0, n])).astype(int)) == max(table, key=table.get)
        total = np.exp(list(table.values())).sum()
        one, first, pairs = q._expected(field, score, [np.array([t]) for t in range(n)])
        assert np.allclose(one, [sum(np.exp(v) for s, v in table.items() if s[t]) / total for t in range(n)])
        assert np.allclose(first[1], one[0])
        assert np.allclose(pairs, [[sum(np.exp(v) * sum(x == (a, b) for x in zip(s, s[1:])) for s, v in table.items()) / total for b in (0, 1)] for a in (0, 1)])
    assert not q.viterbi(q.EMPTY, np.zeros(3), np.array([0, 3])).any()  # ties are content
    assert q.viterbi(q.EMPTY, np.array([1.0, -1.0, 1.0]), np.array([0, 2, 2, 3])).tolist() == [True, False, True]


def test_fit_learns_lines_from_document_labels(spark):
    rng = np.random.default_rng(8)
    prose = lambda: " ".join("".join(rng.choice(list("aeioulmnrst"), 5)) for _ in range(30)) + "."
    menu = lambda: " | ".join("".join(rng.choice(list("aeioulmnrst"), 4)) for _ in range(30))
    rows = [(i, "\n".join([prose()] + [menu() if i % 3 == 0 else prose() for _ in range(3)])) for i in range(120)]
    labels = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1) for i in range(120)] + [(0, 1), (None, 0), (5, None)], "doc_id long, quality int")
    docs = frame(spark, rows + ODD[:3])
    field = q.fit(docs, labels)
    mixed = frame(spark, [(1, "\n".join([prose(), prose(), menu(), prose()])), (2, "\n".join([prose(), menu(), menu(), menu()]))])
    got = {r.doc_id: r for r in q.judge(mixed, field, with_content=True).collect()}
    assert got[1].kept and got[1].n_boilerplate == 1 and "|" not in got[1].content
    assert not got[2].kept and got[2].n_boilerplate == 3 and not got[2].base_failed
    assert q.fit(docs, labels.where("false")) is q.EMPTY and q.fit(docs.where("false"), labels) is q.EMPTY


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_held_out_documents(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = q.judge(docs, q.fit(docs, labels)).join(labels, "doc_id").where(fold("doc_id", 5) == 0).where("not base_failed")
    n = {(r.quality, r.kept): r["n"] for r in got.groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert n[0, False] >= 0.95 * (n[0, False] + n.get((0, True), 0))
    assert n[1, True] >= 0.99 * (n[1, True] + n.get((1, False), 0))
