"""The trained classifier next to a plain fit, and stored and loaded."""

import random

import numpy as np
from pyspark.sql import functions as F

from mentionlake.operators import classifier


def rows_of(spark, n=120):
    r = random.Random(2)
    good, bad, any_ = ["data", "used", "archive"], ["weather", "ugly", "rain"], [f"w{i}" for i in range(30)]
    rows = []
    for i in range(n):
        y = i % 2
        rows.append((i, " ".join(r.choices(any_, k=8) + r.choices(good if y else bad, k=2 if i % 5 else 0)), "RES", y))
    return spark.createDataFrame(rows + [(n, None, "RES", 1), (n + 1, "", None, 0), (n + 2, "no label", "RES", None)], "id int, text string, alias string, label int")


def test_the_classifier_equals_a_plain_fit(spark):
    rows = rows_of(spark)
    model = classifier.train_classifier(rows, features=512)
    used = rows.where("label is not null")
    prepared = model.transform(classifier._input(used, "text")).select("_weighed", "label", "_probability").collect()
    x = np.array([r["_weighed"].toArray() for r in prepared])
    y = np.array([r["label"] for r in prepared], float)
    x = np.column_stack([x, np.ones(len(x))])
    ridge = classifier.PENALTY * np.eye(x.shape[1])
    ridge[-1, -1] = 0
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.lstsq((x.T * (p * (1 - p))) @ x / len(y) + ridge, x.T @ (y - p) / len(y) - ridge @ w, rcond=None)[0]
        w += step
        if np.abs(step).max() < 1e-12:
            break
    fitted = model.stages[-1]
    v = np.append(fitted.coefficients.toArray(), fitted.intercept)
    loss = lambda c: np.logaddexp(0, -(2 * y - 1) * (x @ c)).mean() + c @ ridge @ c / 2
    assert loss(w) <= loss(v) <= loss(w) + 1e-4  # its steps end near the optimum
    got = np.array([r["_probability"][1] for r in prepared])
    assert np.abs(got - 1 / (1 + np.exp(-x @ w))).max() < 0.02
    assert ((got > 0.5) == (y > 0.5)).mean() > 0.85


def test_training_reads_its_texts_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(text):
        read.add(1)
        return text

    rows = rows_of(spark).where("text is not null and label is not null").localCheckpoint()
    classifier.train_classifier(rows.withColumn("text", noted.asNondeterministic()("text")), features=64, rounds=5)
    assert read.value == rows.count()


def test_a_stored_classifier_scores_alike(spark, tmp_path):
    rows = rows_of(spark)
    model = classifier.train_classifier(rows, features=512)
    classifier.save_classifier(model, f"{tmp_path}/m")
    again = classifier.load_classifier(f"{tmp_path}/m")
    mentions = rows.withColumnRenamed("text", "sentence").withColumn("_words", rows["id"]).drop("_words")
    first, second = (classifier.score_trained(mentions, m).orderBy("id").collect() for m in (model, again))
    assert first == second and len(first) == 123
    assert classifier.score_trained(mentions, model).columns == [*mentions.columns, "prediction", "confidence"]
    assert all(0.5 <= r["confidence"] <= 1 for r in first)
    assert classifier.score_trained(mentions.limit(0), model).collect() == []
