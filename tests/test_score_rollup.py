import math

import numpy as np
from pyspark.sql import functions as F

from mentionlake.operators import rollup, score

SCORED = "doc_id int, resource_name string, alias string, sentence string, prediction int, confidence double"


def scored(spark):
    rows = [
        (1, "R", "a", "s2", 1, 0.95), (1, "R", "a", "s1", 1, 0.9), (1, "R", "b", "s1", 1, 0.89),
        (1, "Q", "a", "s1", 0, 0.99), (2, None, "a", "s1", 1, 0.99), (3, "R", "a", "s9", 0, 0.7),
    ]
    return spark.createDataFrame(rows, SCORED)


def test_weights_and_scores_by_hand(spark):
    ex = spark.createDataFrame([("good good", "x", 1), ("bad", "x", 0)], "text string, alias string, label int")
    weights = score.train_weights(ex)
    rows = {r.feature: r for r in weights.where("negatives + positives > 0").collect()}
    # good x2, bad, and in each pair "sep" and the alias
    assert rows[-1].positives == 1 and rows[-1].weight_micro == 0
    tp, tn = 4 + score.FEATURES, 3 + score.FEATURES
    micro = {k: round(1e6 * (math.log((p + 1) / tp) - math.log((n + 1) / tn))) for k, p, n in
             [("good", 2, 0), ("bad", 0, 1), ("sep", 1, 1), ("x", 1, 1)]}
    m = spark.createDataFrame([(1, "Good!", "x"), (2, "bad", "x")], "doc_id int, sentence string, alias string")
    got = {r.doc_id: r for r in score.score_mentions(m, weights).collect()}
    p1 = 1 / (1 + math.exp(-(micro["good"] + micro["sep"] + micro["x"]) / 1e6))
    p2 = 1 / (1 + math.exp(-(micro["bad"] + micro["sep"] + micro["x"]) / 1e6))
    assert (got[1].prediction, got[1].confidence) == (1, round(p1, 6))
    assert (got[2].prediction, got[2].confidence) == (0, round(1 - p2, 6))


def test_a_long_text_is_scored_whole_and_with_its_alias(spark):
    ex = spark.createDataFrame([("good", "x", 1), ("bad", "y", 0)], "text string, alias string, label int")
    weights = score.train_weights(ex)
    filler = "word " * 600
    rows = [(1, filler, "x"), (2, filler, "y"), (3, filler + "good", "y"), (4, None, None)]
    m = spark.createDataFrame(rows, "doc_id int, sentence string, alias string")
    got = {r.doc_id: (r.prediction, r.confidence) for r in score.score_mentions(m, weights).collect()}
    assert got[1][0] == 1 and got[2][0] == 0 and got[3][1] != got[2][1]
    plan = score.score_mentions(m, weights)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan.split("Subquery")[0]


def test_plug_in_scorer_and_ties(spark):
    m = spark.createDataFrame(
        [(1, "s", "aaaa"), (2, "s", "aaaa"), (3, "s", "a"), (4, "s", "aa")],
        "doc_id int, sentence string, alias string",
    )

    def make():
        return lambda alias, sentence: np.array([len(a) / 4 for a in alias.ravel()])

    got = {r.doc_id: (r.prediction, r.confidence) for r in score.score_with(m, make).collect()}
    assert got == {1: (1, 1.0), 2: (1, 1.0), 3: (0, 0.75), 4: (0, 0.5)}


def test_bands(spark):
    df = spark.createDataFrame([(c,) for c in (0.99, 0.98, 0.9, 0.81, 0.8)], "c double")
    got = [r[0] for r in df.select(score.confidence_band(F.col("c"))).collect()]
    assert got == ["high", "medium-high", "medium-low", "medium-low", "low"]


def test_summary_threshold_and_null_keys(spark):
    got = rollup.summarise(scored(spark), sentences=True).collect()
    assert [(r.doc_id, r.resource_name, r.alias, r.match_count, r.mean_confidence, r.token_matches) for r in got] == [
        (1, "R", "a", 2, 0.925, "s1 || s2")
    ]
    assert len(rollup.summarise(scored(spark), ["resource_name"]).collect()) == 1


def test_specificity_without_one_class(spark):
    counts = rollup.prediction_counts(scored(spark).where("prediction = 0"))
    got = {(r.resource_name, r.alias): (r.negatives, r.positives, r.specificity) for r in rollup.specificity(counts).collect()}
    assert got == {("Q", "a"): (1, 0, 0.0), ("R", "a"): (1, 0, 0.0)}


def test_merge_equals_whole(spark):
    s = scored(spark)
    parts = rollup.prediction_counts(s.where("doc_id = 1")).unionByName(rollup.prediction_counts(s.where("doc_id <> 1")))
    assert sorted(map(tuple, rollup.merge_counts(parts).collect())) == sorted(map(tuple, rollup.prediction_counts(s).collect()))


def test_verdict_and_metrics(spark):
    s = scored(spark)
    docs = spark.createDataFrame([(1,), (3,), (4,)], "doc_id int")
    got = {r.doc_id: r.has_mention for r in score.publication_verdict(docs, s).collect()}
    assert got == {1: True, 3: False, 4: False}
    rows = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "label int, prediction int")
    m = score.eval_metrics(rows).first()
    assert (m.tp, m.fp, m.fn, m.tn, m.accuracy, m.precision, m.recall, m.f1) == (1, 1, 1, 2, 0.6, 0.5, 0.5, 0.5)
    assert score.eval_metrics(rows.where("label + prediction = 0")).first().f1 == 0.0


def test_scores_need_no_shuffle_after_detection(spark):
    from mentionlake.plans import inputs

    sf = "/root/testdata/sf0.001"
    ours = inputs.scored(spark, sf)
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    exchanges = [l for l in plan.splitlines() if "Exchange hashpartitioning(doc_id" in l]
    # texts spread over cores; mentions by sentence, then by article and alias; labels' texts
    assert len(exchanges) <= 4


def test_missing_resource_ids(spark):
    summary = spark.createDataFrame([("R",), ("Z",)], "resource_name string")
    lookup = spark.createDataFrame([("R", 7)], "alias string, resource_id int")
    found, missing = rollup.with_resource_ids(summary, lookup)
    assert [r.resource_id for r in found.collect()] == [7]
    assert [(r.resource_name, r.reason) for r in missing.collect()] == [("Z", "no resource id")]


def test_the_first_sentence_is_that_of_all(spark):
    from mentionlake.functions.text import first_sentence, sentence_array

    texts = [None, "", " \n", "One. Two.", "a\nb! c", ". x", "no end", "U.S.  Then? So.", "\n x.\n\ny."]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(first_sentence(F.col("t")).alias("a"), sentence_array(F.col("t"))[0].alias("b"))
    assert [r["a"] for r in rows.collect()] == [r["b"] for r in rows.collect()]


def test_queries_do_their_common_steps_once(spark, monkeypatch):
    from mentionlake.plans import catalogue, inputs

    calls = []
    for name in ("mentions", "metadata"):
        monkeypatch.setattr(inputs, name, lambda *a, f=getattr(inputs, name), n=name: calls.append(n) or f(*a))
    catalogue.mention_sketches(spark, "/root/testdata/sf0.001")
    catalogue._stored_facts(spark, "/root/testdata/sf0.001")
    assert sorted(calls) == ["mentions", "mentions", "metadata"]
