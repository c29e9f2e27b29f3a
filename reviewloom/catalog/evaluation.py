"""E13, E14 and M7 to M12: metrics, gates, monitoring, classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.catalog import query
from reviewloom.catalog import sql as S
from reviewloom.functions.columns import price_text
from reviewloom.functions.constants import CLASS_NAMES, DRIFT_LIMITS, SKEW_LIMITS
from reviewloom.functions.labels import rating_class
from reviewloom.operators import classifier, features, metrics, monitoring
from reviewloom.session import scratch_path

# counts per (slice, class), then the metrics of each slice
METRICS = f"""{S.PREDICTIONS}, placed AS (
  SELECT 'year' AS slice_column, CAST(year AS VARCHAR) AS slice_value, label, prediction FROM predictions WHERE year IS NOT NULL
  UNION ALL SELECT 'main_category', main_category, label, prediction FROM predictions WHERE main_category IS NOT NULL
  UNION ALL SELECT 'Full Dataset', 'All', label, prediction FROM predictions),
classes AS (
  SELECT slice_column, slice_value, c AS class, count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS predicted,
         count(*) FILTER (label = c AND prediction = c) AS hits
  FROM placed, (VALUES ('POSITIVE'), ('NEUTRAL'), ('NEGATIVE')) v(c) GROUP BY ALL),
rates AS (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision, CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall FROM classes),
scored AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM rates),
metrics AS (SELECT slice_column, slice_value, sum(hits) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision,
  sum(recall * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1, CAST(sum(support) AS BIGINT) AS samples FROM scored GROUP BY ALL)"""
RATES = ("accuracy", "precision", "recall", "f1")
ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in RATES)


def _rounded(df, names=RATES):
    return df.withColumns({c: F.round(c, 6) for c in names})


@query("E13_overall_metrics", f"WITH {METRICS} SELECT {ROUNDED}, samples FROM metrics WHERE slice_value = 'All'")
def overall_metrics(t):
    return _rounded(metrics.overall_metrics(t.predictions()))


@query(
    "E13_class_report",
    f"WITH {METRICS} SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM scored WHERE slice_value = 'All'",
)
def class_report(t):
    return _rounded(metrics.class_report(t.predictions()), RATES[1:])


@query("E14_slice_metrics", f"WITH {METRICS} SELECT slice_column, slice_value, {ROUNDED}, samples FROM metrics")
def slice_metrics(t):
    return _rounded(metrics.slice_metrics(t.predictions()))


@query(
    "M07_biased_slices",
    f"""WITH {METRICS} SELECT m.slice_column, m.slice_value, m.samples, round(m.f1, 6) AS f1, round(a.f1 * 0.995, 6) AS f1_threshold
    FROM metrics m, (SELECT f1, samples FROM metrics WHERE slice_value = 'All') a WHERE m.samples >= 0.02 * a.samples AND m.f1 < 0.995 * a.f1""",
)
def biased_slices(t):
    found = metrics.biased_slices(metrics.slice_metrics(t.predictions()), min_share=0.02, ratio=0.995)
    return _rounded(found, ["f1", "f1_threshold"]).select("slice_column", "slice_value", "samples", "f1", "f1_threshold")


@query("M08_quality_gate", f"WITH {METRICS} SELECT round(f1, 6) AS f1, f1 >= 0.6 AS passed FROM metrics WHERE slice_value = 'All'")
def quality_gate(t):
    return _rounded(metrics.quality_gate(metrics.overall_metrics(t.predictions())), ["f1"]).select("f1", "passed")


@query(
    "M09_challenger_gate",
    f"""WITH {METRICS}, biased AS (SELECT count(*) AS n FROM metrics m, (SELECT f1, samples FROM metrics WHERE slice_value = 'All') a
      WHERE m.samples >= 0.1 * a.samples AND m.f1 < 0.9 * a.f1),
    old AS (SELECT max(f1) AS f1 FROM metrics WHERE slice_column = 'year')
    SELECT round(m.f1, 6) AS f1, m.f1 >= old.f1 AS not_worse, n > 0 AS bias, m.f1 >= old.f1 AND n = 0 AS deploy
    FROM metrics m, biased, old WHERE m.slice_value = 'All'""",
)
def challenger_gate(t):
    table = metrics.slice_metrics(t.predictions())
    new = table.filter("slice_value = 'All'")
    old = table.filter("slice_column = 'year'")
    return _rounded(metrics.challenger_gate(new, old, metrics.biased_slices(table)), ["f1"])


def _limits(limits):
    return f"(VALUES {', '.join(f'({S.quoted([f])}, CAST({v} AS DOUBLE))' for f, v in limits.items())}) limits(feature, threshold)"


SKEW_SQL = f"""WITH {S.JOINED}, f AS (
  SELECT CASE WHEN year < 1999 THEN 1 ELSE 0 END AS side, md5(coalesce(text, '')) AS text, coalesce(price, 0) AS price,
    CAST(CAST(price IS NULL AS INTEGER) AS VARCHAR) AS price_missing, CAST(coalesce(helpful_vote, 0) AS DOUBLE) AS helpful_vote,
    CAST(CAST(verified_purchase AS INTEGER) AS VARCHAR) AS verified_purchase FROM joined),
b AS (SELECT min(price) AS lp, max(price) AS hp, min(helpful_vote) AS lv, max(helpful_vote) AS hv FROM f),
pairs AS (
  SELECT side, 'text' AS feature, text AS bucket FROM f
  UNION ALL SELECT side, 'price_missing', price_missing FROM f
  UNION ALL SELECT side, 'verified_purchase', verified_purchase FROM f
  UNION ALL SELECT side, 'price', CAST(least(floor((price - lp) / (hp - lp) * 20), 19) AS VARCHAR) FROM f, b
  UNION ALL SELECT side, 'helpful_vote', CAST(least(floor((helpful_vote - lv) / (hv - lv) * 20), 19) AS VARCHAR) FROM f, b),
shares AS (SELECT feature, bucket, sum(side) / (SELECT sum(side) FROM f) AS p, sum(1 - side) / (SELECT sum(1 - side) FROM f) AS q FROM pairs GROUP BY ALL),
terms AS (SELECT feature, abs(p - q) AS d, (CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2 AS js FROM shares),
distances AS (SELECT feature, CASE WHEN feature IN ('price', 'helpful_vote') THEN sum(js) ELSE max(d) END AS distance FROM terms GROUP BY feature)
SELECT feature, round(distance, 6) AS distance, threshold, distance > threshold AS alert FROM distances JOIN {_limits(SKEW_LIMITS)} USING (feature)"""


@query("M10_feature_skew", SKEW_SQL)
def feature_skew(t):
    rows = features.prepare_features(t.joined().withColumn("price", price_text("price")))
    found = monitoring.feature_skew(rows.filter("year < 1999"), rows.filter("year >= 1999"))
    return found.select("feature", F.round("distance", 6).alias("distance"), "threshold", "alert")


DRIFT_SQL = f"""WITH {S.JOINED}, f AS (
  SELECT printf('%04d-%02d', year, review_month) AS period, substr(md5(coalesce(text, '')), 1, 2) AS text,
    CAST(CAST(price IS NULL AS INTEGER) AS VARCHAR) AS price_missing, CAST(CAST(verified_purchase AS INTEGER) AS VARCHAR) AS verified_purchase,
    CAST(len(list_filter([{', '.join(map(str, monitoring.EDGES))}], lambda e: e <= coalesce(helpful_vote, 0))) AS VARCHAR) AS helpful_vote
  FROM joined WHERE review_time IS NOT NULL),
counts AS (SELECT period, feature, bucket, count(*) AS n FROM (
  UNPIVOT f ON text, price_missing, verified_purchase, helpful_vote INTO NAME feature VALUE bucket) GROUP BY ALL),
totals AS (SELECT period, feature, sum(n) AS total, lag(period) OVER (PARTITION BY feature ORDER BY period) AS previous FROM counts GROUP BY period, feature),
sides AS (
  SELECT period, previous, feature, bucket, n / total AS p, 0.0 AS q FROM counts JOIN totals USING (period, feature)
  UNION ALL SELECT t.period, t.previous, c.feature, c.bucket, 0.0, c.n / u.total FROM counts c
    JOIN totals t ON t.previous = c.period AND t.feature = c.feature JOIN totals u ON u.period = c.period AND u.feature = c.feature),
shares AS (SELECT period, previous, feature, bucket, sum(p) AS p, sum(q) AS q FROM sides WHERE previous IS NOT NULL GROUP BY ALL),
terms AS (SELECT *, abs(p - q) AS d, (CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2 AS js FROM shares),
distances AS (SELECT period, previous, feature, CASE WHEN feature = 'helpful_vote' THEN sum(js) ELSE max(d) END AS distance FROM terms GROUP BY period, previous, feature)
SELECT period, previous, feature, round(distance, 6) AS distance, threshold, distance > threshold AS alert FROM distances JOIN {_limits(DRIFT_LIMITS)} USING (feature)"""


@query("M10_feature_drift", DRIFT_SQL)
def feature_drift(t):
    """Monthly runs into one stored table: the months of 1996 are filed twice and must count once."""
    period = F.when(F.col("year").isNotNull(), F.format_string("%04d-%02d", "year", "review_month"))
    rows = features.prepare_features(t.joined().withColumn("price", price_text("price"))).withColumn("period", period)
    path = scratch_path(t.spark, "histograms")
    for run in (F.col("year") <= 1996, F.col("year") >= 1996):
        monitoring.store_periods(monitoring.period_histograms(rows.filter(run), "period"), path)
    return monitoring.feature_drift(monitoring.stored_periods(t.spark, path)).withColumn("distance", F.round("distance", 6))


def _classifier_rows(t):
    rows = t.joined().withColumn("price", price_text("price")).withColumn("sentiment_label", rating_class("rating"))
    return features.encode_labels(features.prepare_features(rows))


@query("M11_fit_classifier")
def fit_classifier(t):
    """Weighted F1 per penalty of the grid: training is iterative, so rows only."""
    _, scores = classifier.tune_classifier(_classifier_rows(t))
    return t.spark.createDataFrame([(float(k), float(v)) for k, v in scores.items()], "penalty double, f1 double")


@query("M12_batch_scoring")
def batch_scoring(t):
    from reviewloom.functions.json_text import flatten_predictions

    rows = _classifier_rows(t)
    model = classifier.fit_classifier(rows.filter("year < 2000"))
    return flatten_predictions(classifier.score(model, rows.select("row_id", "title", "text", *classifier.NUMERIC), CLASS_NAMES).drop("text"))
