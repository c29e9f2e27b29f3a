"""Features, metrics, gates, skew, classifier."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.functions.constants import CLASS_NAMES
from reviewloom.functions.json_text import flatten_predictions
from reviewloom.operators import classifier, features, metrics, monitoring


def test_features(rows):
    df = rows(
        "text string, title string, price string, helpful_vote bigint, verified_purchase boolean, sentiment_label string",
        (None, None, "unknown", None, None, "POSITIVE"), ("t", "h", "6.5", 3, True, "NEGATIVE"), ("t", "h", "x", 3, False, None),
    )
    got = features.features_first(features.encode_labels(features.prepare_features(df))).collect()
    assert [r.price for r in got] == [0.0, 6.5, 0.0] and [r.price_missing for r in got] == [1, 0, 1]
    assert [r.verified_purchase for r in got] == [0, 1, 0] and [r.label for r in got] == [1, 0, None]
    assert list(got[0].asDict())[:5] == ["text", "price", "price_missing", "helpful_vote", "verified_purchase"]
    assert features.model_input(df.fillna("")).first().combined_text == " "


@pytest.mark.parametrize("n", [1, 20, 2000])
def test_encoding_of_any_number_of_classes(spark, n):
    df = spark.range(2 * n + 1).select("id", F.when(F.col("id") < 2 * n, F.concat(F.lit("c"), (F.col("id") % n).cast("string"))).alias("c"))
    out = features.encode_labels(df, "c")
    assert out.dtypes == [("id", "bigint"), ("c", "string"), ("label", "int")]
    place = {c: i for i, c in enumerate(sorted({f"c{i}" for i in range(n)}))}
    assert all(r.label == place.get(r.c) for r in out.collect()) and out.count() == 2 * n + 1


@pytest.fixture
def predictions(rows):
    pairs = [("a", "a")] * 6 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("b", "a")] + [("c", "a")] * 2
    return rows("label string, prediction string, year int, main_category string", *[(l, p, 2020 + i % 2, "x" if i < 13 else None) for i, (l, p) in enumerate(pairs)])


def test_metrics_with_a_class_never_predicted(predictions):
    report = {r["class"]: r for r in metrics.class_report(predictions).collect()}
    assert (report["c"].precision, report["c"].recall, report["c"].f1, report["c"].support) == (0.0, 0.0, 0.0, 2)
    assert report["a"].precision == pytest.approx(6 / 9) and report["a"].recall == pytest.approx(6 / 8)
    overall = metrics.overall_metrics(predictions).first()
    assert overall.accuracy == pytest.approx(9 / 14) and overall.samples == 14
    assert overall.f1 == pytest.approx(sum(r.f1 * r.support for r in report.values()) / 14)


def test_slices_drop_null_values(predictions):
    got = {(r.slice_column, r.slice_value): r.samples for r in metrics.slice_metrics(predictions).collect()}
    assert got == {("year", "2020"): 7, ("year", "2021"): 7, ("main_category", "x"): 13, ("Full Dataset", "All"): 14}


def test_bias_limits(rows):
    table = rows(
        "slice_column string, slice_value string, f1 double, samples bigint",
        ("Full Dataset", "All", 0.5, 100), ("y", "at both limits", 0.45, 10), ("y", "low", 0.44, 10), ("y", "too small", 0.1, 9),
    )
    assert [r.slice_value for r in metrics.biased_slices(table).collect()] == ["low"]


@pytest.mark.parametrize("new,old,biased,deploy", [(0.8, 0.7, 0, True), (0.7, 0.7, 0, True), (0.6, 0.7, 0, False), (0.8, 0.7, 1, False)])
def test_gates(rows, new, old, biased, deploy):
    ddl = "f1 double"
    found = rows(ddl, *[(0.1,)] * biased)
    assert metrics.challenger_gate(rows(ddl, (new,)), rows(ddl, (old,)), found).first().deploy is deploy
    assert metrics.quality_gate(rows(ddl, (new,))).first().passed == (new >= 0.6)


def test_skew(rows):
    ddl = "text string, price double, price_missing int, helpful_vote int, verified_purchase int"
    train = rows(ddl, *[("t", float(i % 10), 0, i % 3, 1) for i in range(50)])
    same = {r.feature: (r.distance, r.alert) for r in monitoring.feature_skew(train, train).collect()}
    assert len(same) == 5 and all(d == pytest.approx(0) and not a for d, a in same.values())
    moved = rows(ddl, *[("other", 100.0, 1, i % 3, 1) for i in range(50)])
    got = {r.feature: (round(r.distance, 6), r.alert) for r in monitoring.feature_skew(train, moved).collect()}
    assert got["text"] == (1.0, True) and got["price"] == (1.0, True) and got["price_missing"] == (1.0, True)
    assert got["verified_purchase"] == (0.0, False)


def test_classifier_learns_and_scores(spark):
    words = {"NEGATIVE": "awful broken", "NEUTRAL": "okay fine", "POSITIVE": "great love"}
    data = [(i, words[c], c, "t", "1.0", i % 4, True, c) for i, c in enumerate(list(words) * 20)]
    df = spark.createDataFrame(data, "row_id int, text string, c string, title string, price string, helpful_vote int, verified_purchase boolean, sentiment_label string")
    ready = features.encode_labels(features.prepare_features(df))
    model = classifier.fit_classifier(ready, n_features=64)
    scored = classifier.score(model, ready, CLASS_NAMES)
    label, shares = json.loads(scored.first().prediction)
    assert set(shares) == {"NEG", "NEU", "POS"}
    flat = flatten_predictions(scored.select("row_id", "c", "prediction"))
    assert flat.filter("c <> sentiment_label").count() == 0 and flat.filter("POS_confidence is null").count() == 0


def _reviews_of_few_texts(spark):
    words = ["awful broken late", "okay fine late", "great love fast", "broken but great", None, ""]
    data = [(words[(i * 7 + i // 5) % 6], "t" if i % 3 else None, float(i % 11), i % 2, i % 4, i % 2, (i * 7 + i // 3) % 3) for i in range(240)]
    ddl = "text string, title string, price double, price_missing int, helpful_vote int, verified_purchase int, label int"
    return spark.createDataFrame(data, ddl).coalesce(2)


def test_equal_texts_of_a_batch_are_read_once(spark):
    rows = _reviews_of_few_texts(spark)
    grouped = classifier.by_text(rows)
    # two batches, six texts, with and without title
    assert grouped.count() <= 24
    back = grouped.select("title", "text", F.explode("rows").alias("r")).select("title", "text", "r.*")
    assert sorted(map(str, back.select(*rows.columns).collect())) == sorted(map(str, rows.collect()))


@pytest.mark.parametrize("at_once", [1, 3, 4096])
def test_a_text_is_hashed_once_for_all_of_its_titles(spark, monkeypatch, at_once):
    """Titles share words with their texts; blocks may end between a text and its titles."""
    monkeypatch.setattr(classifier, "TEXTS_IN_BLOCK", at_once)
    words = ["great love, great fast", "awful broken late", "okay", None, ""]
    data = [(words[i % 5], ["great", "late late", None, ""][i // 5 % 4], float(i % 11), i % 2, i % 4, i % 2, i // 2 % 3) for i in range(200)]
    rows = spark.createDataFrame(data, "text string, title string, price double, price_missing int, helpful_vote int, verified_purchase int, label int").coalesce(1)
    pieces = classifier.by_piece(rows)
    assert pieces.filter("whole").count() == 5 and pieces.filter("not whole").count() == 20
    assert pieces.select(F.sum(F.size("rows"))).first()[0] == 200

    blocks = classifier._blocks(rows, "label", 64, 1.0, 0)
    scale, model = classifier._scale(blocks, 64, None), classifier._trained(blocks, 64, [0.1], 30, None)[0]
    blocks.unpersist()
    counted = classifier.with_terms(rows.select("text", "title", *classifier.NUMERIC), 64).collect()
    table = np.zeros((200, 64 + len(classifier.NUMERIC)))
    for i, r in enumerate(counted):
        table[i, r.terms] = r.counts
        table[i, 64:] = [r[c] for c in classifier.NUMERIC]
    spread = table.std(0, ddof=1)
    says = (spread > 0) & ~np.append((table[:, :64] > 0).all(0), [False] * len(classifier.NUMERIC))
    assert np.allclose(scale.mean, table.mean(0)) and scale.n == 200
    assert np.allclose(scale.inverse, np.where(says, 1 / np.where(says, spread, 1), 0))

    monkeypatch.setattr(classifier, "TEXTS_IN_BLOCK", 4096)
    blocks = classifier._blocks(rows, "label", 64, 1.0, 0)
    same = classifier._trained(blocks, 64, [0.1], 30, None)[0]
    blocks.unpersist()
    assert np.allclose(model.weights, same.weights) and np.allclose(model.intercepts, same.intercepts)


def test_training_on_texts_equals_training_on_rows(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from reviewloom.functions.text import tokens

    rows = _reviews_of_few_texts(spark)
    blocks = classifier._blocks(rows, "label", 64, 1.0, 0)
    model = classifier._trained(blocks, 64, [0.01], 100, None)[0]
    spoken = features.model_input(rows).withColumn("tokens", tokens(F.lower("combined_text")))
    stages = [
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=64), IDF(inputCol="tf", outputCol="tfidf"),
        VectorAssembler(inputCols=["tfidf", *classifier.NUMERIC], outputCol="features"),
        LogisticRegression(labelCol="label", regParam=0.01, family="multinomial", tol=1e-10, maxIter=500),
    ]
    plain = Pipeline(stages=stages).fit(spoken).transform(spoken)
    expected = {str(r[:-1]): r[-1] for r in plain.select(*rows.columns, vector_to_array("probability")).collect()}
    scored = classifier.score(model, rows, CLASS_NAMES).collect()
    assert len(scored) == 240 and model.steps < 100
    for r in scored:
        shares = json.loads(r.prediction)[1]
        assert [shares[c[:3]] for c in CLASS_NAMES] == pytest.approx(expected[str(r[:-1])], abs=0.0075)


def test_tuning_scores_the_held_out_rows(spark):
    rows = _reviews_of_few_texts(spark).withColumn("label", F.when(F.col("text").contains("great"), 2).when(F.col("text").contains("awful"), 0).otherwise(1))
    model, scores = classifier.tune_classifier(rows.union(rows.withColumn("label", F.lit(None).cast("int"))), n_features=64)
    assert list(scores) == [0.0, 0.01, 0.1] and max(scores.values()) == pytest.approx(1.0)
    said = classifier.score(model, rows, CLASS_NAMES).select("label", F.get_json_object("prediction", "$[0]").alias("p"))
    assert said.filter(F.col("p") != F.element_at(F.array(*map(F.lit, CLASS_NAMES)), F.col("label") + 1)).count() == 0
