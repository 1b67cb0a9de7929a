"""Purchase probability: logistic regression with balanced classes."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.learning.evaluate import scores_of
from clicktide.learning.features import CATEGORICAL, NUMERIC, medians, one_hot, scale_figures
from clicktide.operators.sampling import stratified_folds
from clicktide.session import materialize


def balanced_weights(df: DataFrame, label: str = "label") -> tuple[DataFrame, int]:
    """Add ``weight`` = n / (classes * rows of the class); also returns n."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    n = sum(counts.values())
    weight = None
    for value, size in counts.items():
        w = F.lit(n / (len(counts) * size))
        weight = F.when(F.col(label) == value, w) if weight is None else weight.when(F.col(label) == value, w)
    return df.withColumn("weight", weight), n


def scaling_stage(df: DataFrame) -> SQLTransformer:
    """Median imputation and standardising as one SQL stage with the fitted figures.

    Spark's own scaler divides by the sample deviation; this one uses the population's. A null
    becomes the training median, whether training met a null in that column or not.
    """
    middle = medians(df, NUMERIC)
    filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in middle.items() if m is not None})
    terms = []
    for c, (mean, std) in scale_figures(filled, NUMERIC).items():
        # Without any value in training there is no median.
        default = mean if middle[c] is None else middle[c]
        terms.append(f"(coalesce(cast({c} as double), {default!r}D) - {mean!r}D) / {std!r}D AS z_{c}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


def train_buy_model(features: DataFrame, max_iter: int = 500) -> PipelineModel:
    """Fit on features with ``label``. Save with ``model.write().overwrite().save(path)``.

    The penalty equals an inverse strength of one on the sum of losses: weights add up to n,
    so Spark's mean loss needs 1 / n.
    """
    weighted, n = balanced_weights(features)
    stages = [
        scaling_stage(features),
        *one_hot(CATEGORICAL),
        VectorAssembler(
            inputCols=[f"z_{c}" for c in NUMERIC] + [f"{c}_vec" for c in CATEGORICAL],
            outputCol="features",
        ),
        LogisticRegression(
            weightCol="weight",
            maxIter=max_iter,
            regParam=1.0 / n,
            elasticNetParam=0.0,
            standardization=False,
        ),
    ]
    return Pipeline(stages=stages).fit(weighted)


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Add ``prediction`` and ``p``, the purchase probability."""
    scored = model.transform(features)
    return scored.select(*features.columns, "prediction", vector_to_array("probability")[1].alias("p"))


def steepest_slope(model: PipelineModel, weighted: DataFrame, n: int) -> float:
    """Largest part, in size, of the penalised mean loss's gradient; zero at its minimum.

    The gradient is added up from every row's residual, so it judges the fit by its data alone."""
    logistic = model.stages[-1]
    scored = model.transform(weighted)
    residual = F.col("weight") * (vector_to_array("probability")[1] - F.col("label"))
    parts = (
        scored.select(residual.alias("r"), F.posexplode(vector_to_array("features")).alias("j", "x"))
        .groupBy("j")
        .agg((F.sum(F.col("r") * F.col("x")) / n).alias("slope"))
        .collect()
    )  # one per coefficient
    intercept = scored.agg(F.sum(residual) / n).first()[0]
    penalised = [r.slope + logistic.getRegParam() * logistic.coefficients[r.j] for r in parts]
    return max(map(abs, [intercept, *penalised]))


def cross_validate(
    features: DataFrame, id_col: str, folds: int = 5, max_iter: int = 500, parallelism: int = 5
) -> DataFrame:
    """Accuracy and AUC per stratified fold; average them for the reported figures."""
    dealt = materialize(stratified_folds(features, "label", id_col, folds), "folds")

    def run(fold: int) -> tuple:
        model = train_buy_model(dealt.where(F.col("fold") != fold), max_iter)
        held_out = score(model, dealt.where(F.col("fold") == fold))
        return fold, *scores_of(held_out)

    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(run, range(folds)))
    return features.sparkSession.createDataFrame(rows, "fold int, accuracy double, auc double")


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean accuracy and AUC over the folds."""
    return folds.agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg("accuracy").alias("accuracy_mean"),
        F.avg("auc").alias("auc_mean"),
    )
