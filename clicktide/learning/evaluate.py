"""Accuracy and the area under the ROC curve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.functions.scalars import ratio
from clicktide.operators.ordered import running_total


def accuracy(scores: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scores.agg(
        F.avg((F.col(label).cast("int") == F.col(prediction).cast("int")).cast("double")).alias("accuracy")
    )


def roc_auc(scores: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """Exact rank-sum AUC of scores of any size; equal scores count half.

    Rows are merged by score before any ranking, and the distinct scores are ranked by range, so
    nothing is sorted in one task. A score or label that is null, or no number, is an error.
    """
    score, positive = F.col(probability).cast("double"), F.col(label).cast("int") == 1
    unusable = score.isNull() | F.isnan(score) | positive.isNull()
    checked = F.when(unusable, F.raise_error(F.lit("a score or label is missing")).cast("double"))
    by_score = scores.groupBy(checked.otherwise(score).alias("_score")).agg(
        F.count_if(positive).alias("_pos"), F.count_if(~positive).alias("_neg")
    )
    ranked = running_total(by_score, [], ["_score"], "_neg", "_upto")
    wins = F.col("_pos") * (F.col("_upto") - F.col("_neg") / 2.0)
    sums = ranked.agg(
        F.sum(wins).alias("wins"), F.sum("_pos").alias("pos"), F.sum("_neg").alias("neg")
    )
    pairs = F.col("pos").cast("double") * F.col("neg")
    return sums.select(ratio(F.col("wins"), pairs).alias("auc"))


def scores_of(scored: DataFrame, label: str = "label") -> tuple[float, float]:
    """Accuracy and AUC of a transformed frame with ``prediction`` and ``p``."""
    return accuracy(scored, label).first()[0], roc_auc(scored, label, "p").first()[0]
