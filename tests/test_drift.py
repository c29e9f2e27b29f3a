"""Histograms kept by period, and the distance of each period from the one before it."""

import math

from reviewloom.operators import monitoring

LIMITS = {"text": 0.3, "verified_purchase": 0.1, "helpful_vote": 0.2}
SCHEMA = "month string, text string, verified_purchase int, helpful_vote bigint, other int"


def histograms(df):
    return monitoring.period_histograms(df, "month", LIMITS)


def test_buckets(rows):
    df = rows(SCHEMA, ("m", "a", 1, 0, 9), ("m", "a", None, 3, 9), ("m", None, 0, None, 9), ("m", "a", 0, -5, 9), (None, "a", 0, 0, 9))
    got = {(r.feature, r.bucket): r.n for r in histograms(df).collect()}
    three = sum(e <= 3 for e in monitoring.EDGES)
    assert got == {
        ("text", "0c"): 3, ("text", "missing"): 1, ("verified_purchase", "1"): 1, ("verified_purchase", "missing"): 1,
        ("verified_purchase", "0"): 2, ("helpful_vote", "1"): 1, ("helpful_vote", str(three)): 1, ("helpful_vote", "0"): 1, ("helpful_vote", "missing"): 1,
    }
    assert histograms(df.limit(0)).count() == 0 and monitoring.feature_drift(histograms(df.limit(0))).count() == 0


def test_distances_skip_gaps_and_the_first_period(rows):
    df = rows(
        SCHEMA, *[("2020-01", "a", 1, 0, 0)] * 3, ("2020-01", "b", 1, 8, 0), *[("2020-05", "a", 1, 0, 0)] * 2, *[("2020-05", "b", 0, 0, 0)] * 2,
        ("2020-06", "a", 1, 0, 0), ("2020-06", "b", 0, 0, 0),
    )
    got = {(r.period, r.previous, r.feature): r for r in monitoring.feature_drift(histograms(df), LIMITS).collect()}
    assert {k[:2] for k in got} == {("2020-05", "2020-01"), ("2020-06", "2020-05")} and len(got) == 6
    assert got["2020-05", "2020-01", "text"].distance == 0.25 and not got["2020-05", "2020-01", "text"].alert
    assert got["2020-05", "2020-01", "verified_purchase"].distance == 0.5 and got["2020-05", "2020-01", "verified_purchase"].alert
    js = (math.log2(1 / 0.875) + 0.75 * math.log2(0.75 / 0.875) + 0.25 * math.log2(0.25 / 0.125)) / 2
    assert math.isclose(got["2020-05", "2020-01", "helpful_vote"].distance, js)
    assert all(r.distance == 0 and not r.alert for (p, _, _), r in got.items() if p == "2020-06")


def test_parts_add_up(rows):
    df = rows(SCHEMA, *[(f"2020-0{1 + i % 3}", f"t{i % 7}", i % 2, i, 0) for i in range(60)])
    parts = histograms(df.filter("other = 0 and helpful_vote < 20")).unionByName(histograms(df.filter("helpful_vote >= 20")))
    whole = monitoring.feature_drift(histograms(df), LIMITS)
    assert sorted(monitoring.feature_drift(parts, LIMITS).collect()) == sorted(whole.collect())


def test_a_period_filed_again_is_replaced(spark, rows, tmp_path):
    path = str(tmp_path / "histograms")
    first = rows(SCHEMA, ("2020-01", "a", 1, 0, 0), ("2020-02", "a", 1, 0, 0))
    again = rows(SCHEMA, ("2020-02", "b", 0, 5, 0), ("2020-02", "b", 0, 5, 0), ("2020-03", "b", 0, 5, 0))
    monitoring.store_periods(histograms(first), path)
    kept = {f.name for f in (tmp_path / "histograms" / "period=2020-01").iterdir()}
    for _ in range(2):
        monitoring.store_periods(histograms(again), path)
    assert {f.name for f in (tmp_path / "histograms" / "period=2020-01").iterdir()} == kept
    stored = monitoring.stored_periods(spark, path)
    expected = histograms(first.filter("month = '2020-01'")).unionByName(histograms(again))
    assert sorted(stored.select("period", "feature", "bucket", "n").collect()) == sorted(expected.select("period", "feature", "bucket", "n").collect())
