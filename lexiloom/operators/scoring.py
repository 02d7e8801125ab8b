"""Model scoring and training without anything beyond Spark: a pluggable scorer and a Spark ML baseline."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import word_count

#: Makes, once per worker, a function from texts to chances of label 1.
Scorer = Callable[[], Callable[[list[str]], list[float]]]


def score_with(df: DataFrame, make: Scorer, text: str = "text", out: str = "p") -> DataFrame:
    """Add the score of each text; the model is made once per worker and fed texts of like length. (MDL-01, SRT-02)"""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = make()
        for b in batches:
            yield pd.Series(scorer(b.fillna("").tolist()), dtype="float32")

    return df.sortWithinPartitions(word_count(F.coalesce(F.col(text), F.lit("")))).withColumn(out, F.pandas_udf(run, "float")(F.col(text)))


def train(df: DataFrame, features: int = 1 << 18, rounds: int = 20) -> PipelineModel:
    """A bag-of-words logistic regression over (text, label). (TRN-01)"""
    stages = [
        RegexTokenizer(inputCol="text", outputCol="_tokens", pattern=r"[\W_]+"), HashingTF(inputCol="_tokens", outputCol="_features", numFeatures=features),
        LogisticRegression(featuresCol="_features", labelCol="label", maxIter=rounds, regParam=0.01),
    ]
    return Pipeline(stages=stages).fit(df.select("text", F.col("label").cast("double").alias("label")))


def predict(model: PipelineModel, lines: DataFrame) -> DataFrame:
    """Label and confidence of each line that is not blank. (INF-01)"""
    rows = lines.filter(F.trim("text") != "")
    p = vector_to_array("probability").getItem(1)
    scored = model.transform(rows).withColumn("p", p.cast("float"))
    return scored.select(*rows.columns, "p", F.col("prediction").cast("int").alias("label"), F.greatest(p, 1 - p).alias("conf"))
