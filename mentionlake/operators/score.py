"""Scoring of (alias, sentence) pairs and what follows from a score.

The default scorer is a multinomial naive-Bayes model over hashed words, trained and
applied with built-in expressions. Its table of weights has a fixed number of rows, so
it can always be shipped to every task. Any other model plugs in through
:func:`score_with`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from mentionlake.functions.text import words

FEATURES = 65_536  # four hex digits of md5
PRIOR = -1
MICRO = 1_000_000
MIN_CONFIDENCE = 0.9


def model_input(text: Column, alias: Column) -> Column:
    """The one text a classifier sees for a pair, the alias first; nulls count as empty."""
    flat = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))
    return F.concat(F.coalesce(alias, F.lit("")), F.lit(" [SEP] "), F.trim(flat))


def pair_words(text: Column, alias: Column) -> Column:
    """All words of a pair in order, after one empty word that stands for the pair itself."""
    return F.concat(F.array(F.lit("")), words(model_input(text, alias)))


def feature_of(word: Column) -> Column:
    # Never null, or the optimizer adds a null test that hashes every word again.
    number = F.coalesce(F.conv(F.substring(F.md5(word), 1, 4), 16, 10).cast("int"), F.lit(PRIOR))
    return F.when(word == "", F.lit(PRIOR)).otherwise(number)


def train_weights(examples: DataFrame, balanced: bool = True) -> DataFrame:
    """``feature, negatives, positives, weight_micro`` from ``text, alias, label``.

    Counts are summed per feature before the shuffle, so common words cost no more than
    rare ones. Feature -1 counts examples and carries the prior, which is even where
    ``balanced``. Weights are add-one smoothed log odds in millionths.
    """
    per_word = examples.select(
        "label", F.explode_outer(pair_words(F.col("text"), F.col("alias"))).alias("word")
    )
    counts = per_word.groupBy(feature_of(F.col("word")).alias("feature")).agg(
        F.sum(F.lit(1) - F.col("label")).cast("bigint").alias("negatives"),
        F.sum("label").cast("bigint").alias("positives"),
    )
    every = examples.sparkSession.range(PRIOR, FEATURES).select(F.col("id").cast("int").alias("feature"))
    full = every.join(counts, "feature", "left").na.fill(0, ["negatives", "positives"])
    word = F.col("feature") >= 0
    # Totals over a table of fixed size; a second pass over the texts would cost more.
    whole = Window.partitionBy()
    rows = full.withColumn(
        "all_negatives", F.sum(F.when(word, F.col("negatives"))).over(whole)
    ).withColumn("all_positives", F.sum(F.when(word, F.col("positives"))).over(whole))
    pos, neg = F.col("positives") + 1.0, F.col("negatives") + 1.0
    odds = F.when(
        word,
        F.log(pos / (F.col("all_positives") + FEATURES))
        - F.log(neg / (F.col("all_negatives") + FEATURES)),
    ).otherwise(F.lit(0.0) if balanced else F.log(pos) - F.log(neg))
    return rows.select(
        "feature", "negatives", "positives", F.round(odds * MICRO).cast("bigint").alias("weight_micro")
    )


def with_probability(df: DataFrame, p1: Column) -> DataFrame:
    """Class and confidence, the probability of the chosen class; a tie is class 0. The
    probability passes through a one-row explode, so that filters on either column do not
    make Spark compute it again."""
    rows = df.select("*", F.explode(F.array(p1)).alias("_p1"))
    hit = F.col("_p1") > 0.5
    return (
        rows.withColumn("prediction", hit.cast("int"))
        .withColumn("confidence", F.round(F.when(hit, F.col("_p1")).otherwise(1 - F.col("_p1")), 6))
        .drop("_p1")
    )


def weight_array(weights: DataFrame) -> Column:
    """The weights by place, the prior first, as one literal of ``FEATURES + 1`` numbers,
    however large the corpus. They are fetched once, so a model trained in the same query
    is trained here. A feature that ``weights`` leaves out weighs nothing."""
    every = weights.sparkSession.range(PRIOR, FEATURES).select(F.col("id").cast("int").alias("feature"))
    full = every.join(weights.select("feature", "weight_micro"), "feature", "left")
    pairs = F.sort_array(F.collect_list(F.struct("feature", F.coalesce("weight_micro", F.lit(0)).cast("string").alias("w"))))
    text = full.agg(F.array_join(F.transform(pairs, lambda x: x["w"]), ",").alias("w")).first()["w"]
    return F.split(F.lit(text), ",").cast("array<bigint>")


def score_mentions(mentions: DataFrame, weights: DataFrame) -> DataFrame:
    """Adds ``prediction`` and ``confidence`` to each mention, summing the weights of its
    words inside the row: nothing is exploded, grouped or shuffled."""
    table = weight_array(weights)
    place = lambda w: feature_of(w) - F.lit(PRIOR)
    each = F.transform(pair_words(F.col("sentence"), F.col("alias")), lambda w: F.get(table, place(w)))
    logit = F.aggregate(each, F.lit(0).cast("bigint"), lambda total, w: total + w)
    p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit / F.lit(float(MICRO))))
    return with_probability(mentions, p1)


def score_with(
    mentions: DataFrame,
    make_predict: Callable,
    batch_size: int = 256,
    salts: int = 32,
    key: str = "doc_id",
) -> DataFrame:
    """Score with any batch model: ``make_predict()`` runs once per worker and returns
    a function from arrays of aliases and sentences to probabilities of class 1.

    Equal pairs are scored once per salt and joined back, so a sentence copied into a
    large part of the corpus spreads over ``salts`` tasks.
    """
    from pyspark.ml.functions import predict_batch_udf

    predict = predict_batch_udf(make_predict, return_type=T.DoubleType(), batch_size=batch_size)
    rows = mentions.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)))
    pairs = rows.select("alias", "sentence", "_salt").distinct()
    scored = pairs.withColumn("_p1", predict("alias", "sentence"))
    joined = rows.join(scored, ["alias", "sentence", "_salt"]).drop("_salt")
    p1 = F.col("_p1")
    return with_probability(joined.withColumn("_p", p1).drop("_p1"), F.col("_p")).drop("_p")


def confidence_band(confidence: Column) -> Column:
    return (
        F.when(confidence > 0.98, "high")
        .when(confidence > 0.9, "medium-high")
        .when(confidence > 0.8, "medium-low")
        .otherwise("low")
    )


def prediction_label(prediction: Column) -> Column:
    return F.when(prediction == 1, "MATCH").when(prediction == 0, "NO MATCH")


def confident(min_confidence: float = MIN_CONFIDENCE) -> Column:
    return (F.col("prediction") == 1) & (F.col("confidence") >= min_confidence)


def band_counts(scored: DataFrame) -> DataFrame:
    return (
        scored.select(
            confidence_band(F.col("confidence")).alias("band"),
            prediction_label(F.col("prediction")).alias("label"),
        )
        .groupBy("band", "label")
        .agg(F.count("*").alias("mentions"))
    )


def publication_verdict(
    texts: DataFrame, scored: DataFrame, min_confidence: float = MIN_CONFIDENCE, key: str = "doc_id"
) -> DataFrame:
    """Every article, with whether any confident positive mention was found."""
    yes = scored.where(confident(min_confidence)).select(key).distinct()
    return texts.select(key).join(yes.withColumn("_y", F.lit(True)), key, "left").select(
        key, F.coalesce("_y", F.lit(False)).alias("has_mention")
    )


def eval_metrics(predicted: DataFrame) -> DataFrame:
    """Confusion counts, accuracy and class-1 precision, recall and F1 of
    ``label, prediction``; a ratio without denominator is 0."""
    p, y = F.col("prediction") == 1, F.col("label") == 1
    n = predicted.agg(
        F.count_if(p & y).alias("tp"),
        F.count_if(p & ~y).alias("fp"),
        F.count_if(~p & y).alias("fn"),
        F.count_if(~p & ~y).alias("tn"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, F.round(a / b, 6)).otherwise(0.0)

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return n.select(
        "tp", "fp", "fn", "tn",
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )
