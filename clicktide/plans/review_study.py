"""From labelled reviews to an ablation of extracted features against text alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.learning.ablation import (
    DENSE,
    ablation,
    attribution_audit,
    linear_attributions,
    prepare,
)
from clicktide.operators.extraction import extract_features
from clicktide.operators.sampling import balanced_sample
from clicktide.session import materialize


def review_study(
    reviews: DataFrame,
    id_col: str,
    extractor: Callable[[str], str],
    per_class: int = 500,
    rounds: int = 100,
    max_features: int = 500,
    **options,
) -> dict[str, DataFrame]:
    """Balanced sample, extraction, boosted trees on each feature set, attributions.

    The extraction is written once, so that no review is sent to the extractor twice.
    """
    labelled = reviews.where(F.col("label").isNotNull())
    sample = balanced_sample(labelled, "label", id_col, per_class).drop("rank")
    extracted = materialize(extract_features(sample, "review", extractor, **options), "extracted")
    prepared, fitted = prepare(extracted, id_col, max_features=max_features)
    names = [f"字_{c}" for c in fitted.vocabulary] + list(DENSE)
    attributions = linear_attributions(prepared, names)
    return {
        "ablation": ablation(prepared, rounds),
        "attributions": attributions,
        "audit": attribution_audit(attributions),
    }
