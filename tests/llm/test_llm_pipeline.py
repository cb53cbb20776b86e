"""The pipeline's stages against their operators, and the registered queries."""

import re

import __spark_entry__
import corpus_pipeline
from ledgerwatch.llm import decontaminate, mixing, pii, registry, toxicity
from ledgerwatch.llm.common import written

from test_llm_tables import brute_spans
from test_llm_text import brute_components, edit_distance_in

SF = "/root/testdata/sf0.01"


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert set(registry.ORACLE) <= set(__spark_entry__.oracle_sql())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, at = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = written(stage(spark, docs, SF), f"test-{name}")
        at[name] = (before, docs.collect())
        assert name == "mixing" or docs.columns == columns
    before, after = at["toxicity"]
    index = toxicity.fit(spark.createDataFrame(before), spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in toxicity.score(spark.createDataFrame(before), index).where("score < 0.5").collect()}
    assert {r.doc_id for r in after} == good and len(after) < len(before)
    before, after = at["minhash"]
    assert sorted(r.doc_id for r in after) == [i for i, _, c in sorted(brute_components([(r.doc_id, r.text) for r in before])) if i == c]
    before, after = at["decontamination"]
    items = [decontaminate.normalise_one(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in after}
    exact = {r.doc_id for r in before if any(i in decontaminate.normalise_one(r.text) for i in items)}
    assert not kept & exact and kept | exact <= {r.doc_id for r in before}
    for r in before:
        if r.doc_id not in kept | exact:  # dropped for a fuzzy match
            n = decontaminate.normalise_one(r.text)
            assert any(edit_distance_in(i, n) <= len(decontaminate.pieces(i)) - 2 for i in items)
    before, after = at["pii"]
    texts = {r.doc_id: r.text for r in before}
    assert len(after) == len(before)
    for r in after:
        assert not brute_spans(r.text) and bool(brute_spans(texts[r.doc_id])) <= bool(re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", r.text))
    before, after = at["mixing"]
    again = mixing.mix(spark.createDataFrame(before, docs.drop("copy", "rate", "shuffle_key").schema))
    assert sorted((r.doc_id, r.copy) for r in after) == sorted((r.doc_id, r.copy) for r in again.collect())


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*spark.read.parquet(f"{SF}/documents.parquet").columns, "copy", "rate", "shuffle_key"] and out.count() > 0
    assert pii.KINDS == ("email", "ip", "card", "phone")
