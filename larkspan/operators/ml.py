"""Models on embeddings: gender of speakers and k-means units, with Spark's own learners."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.functions.scalars import gender_number, gender_of_probability
from larkspan.operators.selection import first_n
from larkspan.operators.votes import first_label


def training_set(members: DataFrame, labels: DataFrame, embeddings: DataFrame, cluster: str = "cluster", most: int = 201) -> DataFrame:
    """(emb, g): up to ``most`` members of clusters whose first labelled member is m or f."""
    decided = first_label(members, labels, cluster).where(F.col("label").isin("m", "f"))
    own = first_n(members.join(decided, cluster), [cluster], ["pos"], most)
    return own.join(embeddings, ["f", "sp"]).select("emb", F.col("label").alias("g"))


def balance(training: DataFrame) -> DataFrame:
    return training.groupBy("g").agg(F.count(F.lit(1)).alias("n"))


def _features(rows: DataFrame) -> DataFrame:
    return rows.withColumn("features", array_to_vector(F.transform("emb", lambda x: x.cast("double"))))


def train_gender(training: DataFrame, seed: int = 42):
    """The model of the best area under the curve over a grid, on a seeded split, refitted on all rows."""
    rows = _features(training).withColumn("label", gender_number(F.col("g")).cast("double")).where("label is not null")
    learner = LogisticRegression(maxIter=50)
    grid = ParamGridBuilder().addGrid(learner.regParam, [0.0, 0.01, 0.1]).addGrid(learner.elasticNetParam, [0.0, 0.5]).build()
    return TrainValidationSplit(estimator=learner, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), trainRatio=0.8, seed=seed).fit(rows).bestModel


def predict_gender(model, rows: DataFrame, dead_band: float = 0.2) -> DataFrame:
    p = vector_to_array("probability")[1]
    return model.transform(_features(rows)).withColumn("p", p).withColumn("g", gender_of_probability(F.col("p"), dead_band)).drop("features", "rawPrediction", "probability", "prediction")


def train_units(rows: DataFrame, k: int = 100, seed: int = 42, rounds: int = 20):
    return KMeans(k=k, seed=seed, maxIter=rounds).fit(_features(rows))


def units(model, rows: DataFrame) -> DataFrame:
    return model.transform(_features(rows)).withColumnRenamed("prediction", "unit").drop("features")
