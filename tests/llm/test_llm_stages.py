"""Stages and operators with repeated ids, missing ids and clashing column names."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import minhash, mixing, pii, urls
from ledgerwatch.llm.common import told_apart

T = " ".join(f"word{i}" for i in range(40))
U = " ".join(f"other{i}" for i in range(40))
CLASH = "doc_id long, text string, lang string, source string, n_chars long, __id string, __email string, __n int, __source string, doc string, row string, own string, copy int, k1 string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "id", "mail", 5, "src", "d", "r", "o", 9, "k") for i, t in rows], CLASH)


@pytest.mark.parametrize("rows, kept", [
    ([(1, T), (None, T), (None, U)], [(1, T), (None, U)]),
    ([(1, T), (2, T), (2, U)], [(1, T), (2, U)]),
    ([(3, T), (3, T), (3, U), (4, None), (4, None), (5, "")], [(3, T), (3, U), (4, None), (4, None), (5, "")]),
    ([(7, T), (7, T + " more")], None),
])
def test_minhash_stage_drops_rows_by_their_own_text(spark, rows, kept):
    docs = frame(spark, rows)
    out = minhash.stage(spark, docs, "")
    assert out.columns == docs.columns
    got = out.collect()
    if kept is None:  # near copies under one id: one of them stays
        assert len(got) == 1 and (got[0].doc_id, got[0].text) in rows
    else:
        assert Counter((r.doc_id, r.text) for r in got) == Counter(kept)
    assert all(tuple(r)[5:] == ("id", "mail", 5, "src", "d", "r", "o", 9, "k") for r in got)


def test_pii_and_mixing_keep_clashing_columns(spark):
    docs = frame(spark, [(1, "write to a.b@example.org now"), (2, None), (None, "x")])
    out = pii.stage(spark, docs, "")
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == docs.columns and got[1].text == "write to [EMAIL] now" and got[1]["__email"] == "mail" and got[1].n_chars == 20
    assert got[2].text == "" and got[2]["doc"] == "d"
    mixed = mixing.mix(docs, {"s": 1.0}, 3.0)
    assert mixed.columns == [c for c in docs.columns if c != "copy"] + ["copy", "rate", "shuffle_key"]
    assert all((r["__n"], r["__source"], r["doc"]) == (5, "src", "d") for r in mixed.collect())


def test_distrust_reaches_far_hosts(spark):
    """A chain of hosts to a blocked one: no fixed number of steps ends it (0.85 ** 30 is above the tolerance)."""
    n = 30
    link = lambda k: f'<a href="http://h{k}.org/">' if k <= n else ""
    pages = spark.createDataFrame([(k, f"http://h{k}.org/", link(k + 1)) for k in range(n)] + [(n, f"http://h{n}.org/bad", "")], "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.judge(pages, [("block", f"h{n}.org", "/")], 5e-3).collect()}
    assert set(got.values()) == {"block"} and len(got) == n + 1


def test_rows_are_told_apart_where_they_are_read(spark, tmp_path):
    """All rows of the keys and few others pass; the rest need not be shuffled."""
    df = spark.range(20000).selectExpr("if(id % 1000 = 999, null, named_struct('a', id, 'b', string(id))) AS key", "repeat('x', 50) AS text", "id")
    df.write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    keys = df.where("id % 20 = 3 or id = 999").select(F.col("key").alias("k")).distinct()
    some, others = told_apart(df, F.col("key"), keys, F.col("k"), "bits")
    assert "hashpartitioning" not in others._jdf.queryExecution().executedPlan().toString()
    got, rest = {r.id for r in some.collect()}, {r.id for r in others.collect()}
    wanted = {i for i in range(20000) if i % 20 == 3 and i % 1000 != 999} | {i for i in range(20000) if i % 1000 == 999}
    assert got >= wanted and not got & rest and len(got | rest) == 20000 and some.columns == df.columns
    assert len(got - wanted) < 3000
    none = told_apart(df, F.col("key"), keys.limit(0), F.col("k"), "bits")
    assert none[0].count() == 0 and none[1].count() == 20000


def test_texts_of_kept_documents_are_not_shuffled(spark):
    """The stage's last step moves only rows that may be dropped."""
    rows = [(i, f"{'same words here for every second one' if i % 2 else f'other words of number {i} stand here'}", "en", "s", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = minhash.stage(spark, docs, "")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Union" in plan and "getbit" in plan.lower() or "bit_get" in plan.lower()
        assert sorted(r.doc_id for r in out.collect()) == [i for i in range(40) if i % 2 == 0 or i == 1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
