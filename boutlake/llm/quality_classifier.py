"""Quality scores: hashed word n-gram logistic regression trained with follow-the-regularised-leader updates.

Features are lower-cased words, the shapes of words (what they hold besides letters), adjacent pairs of either, and whether
neighbours are the same word, each as the root of its share of the document; a score is a sparse dot product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutlake.llm.common import held_out
from boutlake.llm.ftrl import Model

QUALITY = Model(kind="shape", l1=0.05, l2=0.1, alpha=0.5)
GOOD_AT = 0.5


def fit_quality(docs: DataFrame, labels: DataFrame, model: Model = QUALITY) -> Model:
    """Fit on labels.quality; see Model.fitted for nulls, repeats and the bound on rows."""
    return model.fitted(docs, labels, "quality")


def score_quality(docs: DataFrame, model: Model, threshold: float = GOOD_AT) -> DataFrame:
    """doc_id, score, predicted for each row of docs.

    A null or empty text scores the bias alone; repeated rows each get their score; extra columns are
    left out; an empty table gives an empty result.
    """
    return model.scored(docs).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op10_quality_classifier(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores by a model that has seen no labels of held-out documents."""
    model = fit_quality(documents, labels.where(~held_out()))
    return score_quality(documents, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
