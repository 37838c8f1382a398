"""A trained mention classifier: weighted hashed words and logistic regression, as one
stored pipeline that scoring loads."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from mentionlake.operators.score import model_input, with_probability

FEATURES = 1 << 16
PENALTY = 0.01
ROUNDS = 100


def _input(rows: DataFrame, text: str) -> DataFrame:
    return rows.withColumn("_input", model_input(F.col(text), F.col("alias")))


def train_classifier(
    examples: DataFrame, features: int = FEATURES, penalty: float = PENALTY, rounds: int = ROUNDS
) -> PipelineModel:
    """Fits ``text, alias, label``: the alias and the whole text as one model input, its
    words hashed to ``features`` places and weighed by how few examples hold them, then
    a ridge logistic regression. Texts are cut into words once: their counts wait on disk for
    the passes that weigh and fit. Gradients are summed in the tasks; the driver holds one
    number per feature. Nothing in it is drawn at random. Examples without label are left out."""
    counting = [
        RegexTokenizer(inputCol="_input", outputCol="_words", pattern="[^\\p{L}\\p{N}]+", minTokenLength=1),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features),
    ]
    fitting = [
        IDF(inputCol="_counts", outputCol="_weighed"),
        LogisticRegression(
            featuresCol="_weighed", labelCol="_label", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_predicted",
            regParam=penalty, elasticNetParam=0.0, standardization=False, maxIter=rounds, tol=1e-9,
        ),
    ]
    rows = _input(examples.where("label is not null"), "text").select("_input", F.col("label").cast("double").alias("_label"))
    counts = PipelineModel(counting).transform(rows).select("_counts", "_label").persist(StorageLevel.DISK_ONLY)
    try:
        fitted = Pipeline(stages=fitting).fit(counts)
    finally:
        counts.unpersist()
    return PipelineModel([*counting, *fitted.stages])


def save_classifier(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_classifier(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_trained(mentions: DataFrame, model: PipelineModel, text: str = "sentence") -> DataFrame:
    """Adds ``prediction`` and ``confidence`` to each mention, in the row."""
    scored = model.transform(_input(mentions, text))
    return with_probability(scored.select(*mentions.columns, "_probability"), vector_to_array("_probability")[1]).drop("_probability")
