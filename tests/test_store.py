"""Publishing: numbered manifests, stale writers, reset, and the scratch folder rule."""

import datetime as dt
import os
import types

import pytest

from ledgerwatch import session
from ledgerwatch.plans import store
from ledgerwatch.plans.store import StaleWriter, Warehouse


def _root(tmp_path):
    return "file:" + str(tmp_path / "wh")


def test_failed_publish_leaves_the_old_state(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, _root(tmp_path))
    wh.stage("t", spark.range(5))
    wh.set_watermark("t", "2024-01-01 00:00:00")
    wh.publish()
    again = Warehouse(spark, _root(tmp_path))
    again.stage("t", spark.range(1))
    monkeypatch.setattr(store, "write_text_new", lambda *a: (_ for _ in ()).throw(OSError("no rename")))
    with pytest.raises(OSError):
        again.publish()
    now = Warehouse(spark, _root(tmp_path))
    assert now.read("t").count() == 5 and now.watermark("t") == "2024-01-01 00:00:00"


def test_a_missing_manifest_beside_tables_is_an_error(spark, tmp_path):
    wh = Warehouse(spark, _root(tmp_path))
    wh.stage("t", spark.range(5))
    wh.publish()
    for name in os.listdir(tmp_path / "wh"):
        if name.startswith(("_manifest", "._manifest")):
            os.remove(tmp_path / "wh" / name)
    with pytest.raises(RuntimeError, match="no manifest"):
        Warehouse(spark, _root(tmp_path))


def test_a_first_run_that_broke_off_can_be_repeated(spark, tmp_path):
    Warehouse(spark, _root(tmp_path)).stage("t", spark.range(5))  # never published
    wh = Warehouse(spark, _root(tmp_path))
    assert wh.read("t") is None
    wh.stage("t", spark.range(2))
    wh.publish()
    assert Warehouse(spark, _root(tmp_path)).read("t").count() == 2


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    Warehouse(spark, _root(tmp_path)).publish()
    one, two = Warehouse(spark, _root(tmp_path)), Warehouse(spark, _root(tmp_path))
    schema = spark.range(1).schema
    one.append("f", spark.range(3))
    two.append("f", spark.range(4))
    one.stage("t", spark.range(3))
    two.stage("t", spark.range(4))
    one.publish()
    with pytest.raises(StaleWriter):
        two.publish()
    now = Warehouse(spark, _root(tmp_path))
    assert now.read_append("f", schema).count() == 3 and now.read("t").count() == 3
    with pytest.raises(StaleWriter):
        two.publish()


def test_versions_rise_after_a_reset(spark, tmp_path):
    wh = Warehouse(spark, _root(tmp_path))
    wh.stage("t", spark.range(5))
    wh.publish()
    held = Warehouse(spark, _root(tmp_path)).read("t")
    wh.reset()
    assert Warehouse(spark, _root(tmp_path)).read("t") is None
    wh.stage("t", spark.range(1))
    wh.publish()
    assert int(wh.version("t").split("-")[0]) == 2 and held.count() == 5


def test_old_manifests_go_and_the_unnumbered_one_is_read(spark, tmp_path):
    os.makedirs(tmp_path / "wh")
    (tmp_path / "wh" / "_manifest.json").write_text('{"tables": {}, "watermarks": {"t": "2024-01-01 00:00:00"}, "run": 7}')
    wh = Warehouse(spark, _root(tmp_path))
    assert wh.watermark("t") == "2024-01-01 00:00:00"
    for _ in range(store.KEPT + 5):
        wh.publish()
    assert sum(n.startswith("_manifest-") for n in os.listdir(tmp_path / "wh")) == store.KEPT + 1
    assert Warehouse(spark, _root(tmp_path)).manifest["run"] == 7 + store.KEPT + 5


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,512]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    fake = types.SimpleNamespace(sparkContext=sc, conf=types.SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(fake)


def test_a_run_leaves_no_scratch(spark, tmp_path):
    from ledgerwatch.plans.pipeline import PipelineConfig, run_pipeline
    drop = tmp_path / "drops"
    drop.mkdir()
    (drop / "transactions_01012024.txt").write_text("a;b;c;d;e;f;g\nt1;2024-01-01 10:00:00;1;C1;p;SUCCESS;T1\n")
    acc = spark.createDataFrame([("A1", None, "P1", dt.datetime(2023, 1, 1), None)],
                                "account string, valid_to timestamp_ntz, client string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    base = session.ensure_checkpoint_dir(spark).removeprefix("file:") + "/ledgerwatch"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    run_pipeline(spark, PipelineConfig(warehouse=_root(tmp_path), drop_dir=str(drop), sources={"accounts": acc}), "2024-01-02 01:17:00")
    assert set(os.listdir(base)) == before
