"""SCD2: literal edge cases plus a random-sequence property test against a
plain-Python model of the original statement sequence (close, insert, delete)."""

import collections
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerwatch.operators import scd2
from ledgerwatch.schemas import DimSpec

END = dt.datetime(9999, 1, 1)
SPEC = DimSpec("t", "k", ("v",), {"k": "string", "v": "string"})
RUNS = [dt.datetime(2024, 1, d, 1, 17) for d in range(1, 10)]


def model_step(hist, snapshot, run_ts, revive=False):
    """The original load, statement by statement, on Python rows
    (k, v, flag, eff_from, eff_to)."""
    cut = run_ts - dt.timedelta(seconds=1)
    hist = [list(h) for h in hist]
    staged = list(snapshot)

    def diff(a, b):
        return a != b

    open_rows = {h[0]: h for h in hist if h[4] == END and h[2] == "n" and h[0] is not None}
    chg = {k for k, v in staged if k is None or k not in open_rows or diff(v, open_rows[k][1])}
    for h in hist:
        if h[0] is not None and h[0] in chg and h[4] == END:
            h[4] = cut
    ins = []
    for k, v in staged:
        matches = [h for h in hist if k is not None and h[0] == k]
        if not matches:
            ins.append([k, v, "n", run_ts, END])
            continue
        mx = max(h[4] for h in matches)
        for h in matches:
            d = diff(v, h[1]) or (revive and h[2] == "y")
            if d and h[4] != END and h[4] == mx:
                ins.append([k, v, "n", run_ts, END])
    hist += ins
    keys = {k for k, _ in snapshot if k is not None}
    gone = {h[0] for h in hist if h[0] is not None and h[0] not in keys}
    for h in hist:
        if h[0] in gone and h[2] == "n" and h[4] == END:
            h[2], h[4] = "y", cut
    return [tuple(h) for h in hist]


def run_model(snapshots, revive=False):
    hist = []
    for i, snap in enumerate(snapshots):
        hist = model_step(hist, snap, RUNS[i], revive)
    return collections.Counter(hist)


def _frames(spark, snap):
    staged = spark.createDataFrame(snap, "k string, v string")
    return staged, staged.select("k")


def run_spark(spark, snapshots, form="single", revive=False):
    hist = scd2.empty_history(spark, SPEC)
    latest, archive = hist, []
    for i, snap in enumerate(snapshots):
        staged, keys = _frames(spark, snap)
        ts = RUNS[i].strftime("%Y-%m-%d %H:%M:%S")
        if form == "single":
            hist = scd2.merge_history(SPEC, hist, staged, keys, ts, revive)
        elif form == "step":
            hist = scd2.step_history(SPEC, hist, staged, keys, ts, revive)
        else:
            latest, retired = scd2.merge_latest(SPEC, latest, staged, keys, ts, revive)
            latest = spark.createDataFrame(latest.collect(), SPEC.history_schema())
            archive += retired.collect()
        if form != "latest":
            hist = spark.createDataFrame(hist.collect(), SPEC.history_schema())
    rows = (latest.collect() + archive) if form == "latest" else hist.collect()
    return collections.Counter(tuple(r) for r in rows)


CASES = {
    "new_changed_unchanged": [[("a", "x"), ("b", "y")], [("a", "x"), ("b", "z"), ("c", "w")]],
    "deleted_then_back_unchanged_stays_closed": [[("a", "x"), ("b", "y")], [("a", "x")], [("a", "x"), ("b", "y")]],
    "deleted_then_back_changed_reopens": [[("a", "x"), ("b", "y")], [("a", "x")], [("a", "x"), ("b", "q")]],
    "a_b_a": [[("a", "x")], [("a", "y")], [("a", "x")]],
    "null_to_value_and_back": [[("a", None)], [("a", "x")], [("a", None)], [("a", None)]],
    "null_key_inserted_every_run": [[(None, "x"), ("a", "y")], [(None, "x"), ("a", "y")]],
    "empty_snapshot_deletes_all": [[("a", "x"), ("b", "y")], []],
    "rerun_same_snapshot_is_idempotent": [[("a", "x"), ("b", "y")], [("a", "x"), ("b", "y")]],
}


@pytest.mark.parametrize("name", sorted(CASES))
@pytest.mark.parametrize("form", ["single", "step", "latest"])
def test_literal_cases(spark, name, form):
    snaps = CASES[name]
    assert run_spark(spark, snaps, form) == run_model(snaps)


def test_revive_unchanged_option(spark):
    snaps = CASES["deleted_then_back_unchanged_stays_closed"]
    got = run_spark(spark, snaps, "single", revive=True)
    assert got == run_model(snaps, revive=True)
    assert any(r[0] == "b" and r[2] == "n" and r[4] == END for r in got)


def test_unchanged_return_stays_closed(spark):
    got = run_spark(spark, CASES["deleted_then_back_unchanged_stays_closed"], "single")
    b = [r for r in got if r[0] == "b"]
    assert len(b) == 1 and b[0][2] == "y"


def test_duplicate_staged_key_raises(spark):
    hist = scd2.empty_history(spark, SPEC)
    staged, keys = _frames(spark, [("a", "x"), ("a", "y")])
    with pytest.raises(Exception, match="duplicate staged"):
        scd2.merge_history(SPEC, hist, staged, keys, "2024-01-01 01:17:00").collect()


def test_history_invariants_and_watermark(spark):
    snaps = [[("a", "x"), ("b", "y"), ("c", "z")], [("a", "x2"), ("c", "z")], [("a", "x2"), ("b", "y2")]]
    hist = scd2.empty_history(spark, SPEC)
    for i, snap in enumerate(snaps):
        staged, keys = _frames(spark, snap)
        hist = scd2.merge_history(SPEC, hist, staged, keys, RUNS[i].strftime("%Y-%m-%d %H:%M:%S"))
    rows = hist.collect()
    open_per_key = collections.Counter(r.k for r in rows if r.effective_to == END and r.deleted_flg == "n")
    assert max(open_per_key.values()) == 1
    by_key = collections.defaultdict(list)
    for r in rows:
        by_key[r.k].append((r.effective_from, r.effective_to))
    for spans in by_key.values():
        spans.sort()
        for (f1, t1), (f2, _) in zip(spans, spans[1:]):
            assert t1 < f2  # no overlap
    wm = hist.select(scd2.history_watermark(hist).alias("w")).first().w
    assert wm == RUNS[2]


snapshot_st = st.lists(
    st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.sampled_from(["x", "y", None])),
             max_size=4, unique_by=lambda t: t[0]),
    min_size=1, max_size=3)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(snapshot_st)
def test_single_pass_equals_statement_sequence(spark, snapshots):
    expected = run_model(snapshots)
    assert run_spark(spark, snapshots, "single") == expected
    assert run_spark(spark, snapshots, "latest") == expected


def test_untrimmed_delete_keys_compat(spark):
    """Quirk 2: with the original untrimmed key list, a padded source key is
    inserted (trimmed) and deleted in the same run; trimming both sides
    (default) keeps it open."""
    from ledgerwatch.operators import capture
    from ledgerwatch.schemas import CARDS
    src = spark.createDataFrame([(" C1 ", "A1", None, None)],
                                "card_num string, account string, create_dt timestamp_ntz, "
                                "update_dt timestamp_ntz")
    staged = capture.stage_dimension(CARDS, src, "1900-01-01 00:00:00", "2024-01-01 01:17:00")
    hist = scd2.empty_history(spark, CARDS)
    fixed = scd2.merge_history(CARDS, hist, staged, capture.source_keys(CARDS, src),
                               "2024-01-01 01:17:00").collect()
    assert [(r.card_num, r.deleted_flg, r.effective_to) for r in fixed] == [("C1", "n", END)]
    compat = scd2.merge_history(CARDS, hist, staged, capture.source_keys(CARDS, src, trim=False),
                                "2024-01-01 01:17:00").collect()
    (r,) = compat
    assert r.card_num == "C1" and r.deleted_flg == "y" and r.effective_to < r.effective_from


def test_batch_clock_strictly_increases():
    from ledgerwatch.plans.pipeline import Clock
    c = Clock("2024-01-01 23:59:59")
    assert [c.next() for _ in range(3)] == ["2024-01-01 23:59:59", "2024-01-02 00:00:00",
                                            "2024-01-02 00:00:01"]
