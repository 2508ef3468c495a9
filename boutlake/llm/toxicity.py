"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are lower-cased and punctuation is left out; features are words, their first four to six bytes,
adjacent pairs and pairs with a gap of one, each counted once a document. Each coordinate has its own
rate, and the L1 term leaves a few thousand weights that travel with the scoring tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutlake.llm.common import held_out
from boutlake.llm.ftrl import Model

TOXICITY = Model(kind="skip", l1=1.0, alpha=0.5, epochs=4, positive=3.0)
TOXIC_AT = 0.7


def fit_toxicity(docs: DataFrame, labels: DataFrame, model: Model = TOXICITY) -> Model:
    """Fit on labels.toxic; see Model.fitted for nulls, repeats and the bound on rows."""
    return model.fitted(docs, labels, "toxic")


def score_toxicity(docs: DataFrame, model: Model, threshold: float = TOXIC_AT) -> DataFrame:
    """doc_id, score, predicted for each row of docs.

    A null or empty text scores the bias alone; repeated rows each get their score; extra columns are
    left out; an empty table gives an empty result.
    """
    return model.scored(docs).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores by a model that has seen no labels of held-out documents."""
    model = fit_toxicity(documents, labels.where(~held_out()))
    return score_toxicity(documents, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
