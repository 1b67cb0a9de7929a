"""How much structured features add to text: boosted trees on each set, and attributions."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.functions.scalars import ratio
from clicktide.learning.evaluate import accuracy, scores_of
from clicktide.learning.features import ordinal_encode
from clicktide.learning.tfidf import CharTfidf, entries, fit_char_tfidf, fuse
from clicktide.operators.cleaning import fill_unknown
from clicktide.operators.sampling import hash_rank, stratified_split
from clicktide.session import materialize, shared_dir

DENSE = ("cat", "sentiment", "category")


def prepare(
    df: DataFrame, id_col: str, dense: Sequence[str] = DENSE, max_features: int = 500, share: float = 0.2
) -> tuple[DataFrame, CharTfidf]:
    """Vectors ``text``, ``dense`` and ``features`` (both), and ``is_test``; written once."""
    filled = fill_unknown(df, dense)
    tfidf = fit_char_tfidf(filled, "review", max_features)
    coded = ordinal_encode(tfidf.transform(filled, "review", "text"), dense)
    width = len(tfidf.vocabulary) + len(dense)
    fused = fuse(coded, "text", dense, width)
    both = VectorAssembler(inputCols=list(dense), outputCol="dense").transform(fused)
    split = stratified_split(both, "label", id_col, share)
    keep = [id_col, "label", *dense, "text", "dense", "features", "is_test"]
    return materialize(split.select(*keep), "ablation"), tfidf


def ablation(prepared: DataFrame, rounds: int = 100) -> DataFrame:
    """Accuracy and AUC of boosted trees on text, on dense features and on both.

    ``delta`` columns compare with text alone.
    """
    spark = prepared.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))

    def run(experiment: tuple[str, str]) -> tuple:
        name, column = experiment
        trees = GBTClassifier(
            featuresCol=column, maxIter=rounds, stepSize=0.1, maxDepth=5, maxBins=64, seed=42,
            checkpointInterval=10, cacheNodeIds=True,
        )
        model = trees.fit(prepared.where(~F.col("is_test")))
        tested = model.transform(prepared.where("is_test")).select(
            "label", "prediction", vector_to_array("probability")[1].alias("p")
        )
        return name, model.numFeatures, *scores_of(tested)

    # The three fits are independent jobs; Spark runs their tasks side by side.
    experiments = (("A text", "text"), ("B dense", "dense"), ("C fused", "features"))
    with ThreadPoolExecutor(len(experiments)) as pool:
        rows = list(pool.map(run, experiments))
    base = rows[0]
    rows = [(*r, r[2] - base[2], r[3] - base[3]) for r in rows]
    return spark.createDataFrame(
        rows,
        "experiment string, features int, accuracy double, auc double, "
        "delta_accuracy double, delta_auc double",
    )


def linear_attributions(
    prepared: DataFrame, names: Sequence[str], dense: Sequence[str] = DENSE, max_iter: int = 100
) -> DataFrame:
    """Mean absolute attribution per feature of a logistic model on the test rows.

    For a linear model the exact attribution of a feature is its weight times the distance
    from its mean. The table of weights has one row per feature, so it is safe to broadcast.
    """
    spark = prepared.sparkSession
    model = LogisticRegression(maxIter=max_iter, regParam=0.01, standardization=False).fit(
        prepared.where(~F.col("is_test"))
    )
    test = prepared.where("is_test")
    means = test.agg(Summarizer.mean(F.col("features"))).first()[0]
    table = [
        (i, name, "dense" if name in dense else "text", float(w), float(m))
        for i, (name, w, m) in enumerate(zip(names, model.coefficients, means))
    ]
    weights = spark.createDataFrame(table, "i int, feature string, part string, w double, m double")
    n = test.count()
    w, x, m = F.col("w"), F.col("_x"), F.col("m")
    # Only non-zero entries are taken out; a zero adds abs(w * m).
    found = entries(test.select("features"), "features").withColumnRenamed("_i", "i")
    seen = found.join(F.broadcast(weights), "i").groupBy("i").agg(
        F.sum(F.abs(w * (x - m))).alias("_seen"), F.count(F.lit(1)).alias("_nnz")
    )
    zeros = (n - F.coalesce("_nnz", F.lit(0))) * F.abs(w * m)
    return weights.join(seen, "i", "left").select(
        "feature", "part", ((F.coalesce("_seen", F.lit(0.0)) + zeros) / n).alias("mean_abs_attribution")
    )


def top_features(attributions: DataFrame, k: int = 15) -> DataFrame:
    return attributions.orderBy(F.desc("mean_abs_attribution"), "feature").limit(k)


def attribution_audit(attributions: DataFrame) -> DataFrame:
    """Totals and per-feature means of both groups, and the ratio of the means."""
    def of(part: str):
        return F.when(F.col("part") == part, F.col("mean_abs_attribution"))

    sums = attributions.agg(
        F.count(of("dense")).alias("dense_features"),
        F.count(of("text")).alias("text_features"),
        F.coalesce(F.sum(of("dense")), F.lit(0.0)).alias("dense_total"),
        F.coalesce(F.sum(of("text")), F.lit(0.0)).alias("text_total"),
        F.coalesce(F.avg(of("dense")), F.lit(0.0)).alias("dense_mean"),
        F.coalesce(F.avg(of("text")), F.lit(0.0)).alias("text_mean"),
    )
    return sums.withColumn("mean_ratio", ratio(F.col("dense_mean"), F.col("text_mean")))


def permuted(df: DataFrame, id_col: str, column: str, seed: int = 42) -> DataFrame:
    """``df`` with the values of one column dealt out anew in a random but fixed order."""
    receivers = hash_rank(df, id_col, seed).drop(column, "group_size")
    givers = hash_rank(df.select(id_col, column), id_col, seed + 1).select("rank", column)
    return receivers.join(givers, "rank").drop("rank")


def permutation_importance(
    model, prepared: DataFrame, id_col: str, columns: Sequence[str] = DENSE
) -> DataFrame:
    """Loss of accuracy on the test rows when one dense column is dealt out anew."""
    test = prepared.where("is_test").drop("features", "dense")
    assemble = VectorAssembler(inputCols=["text", *columns], outputCol="features")

    def measured(df: DataFrame) -> float:
        return accuracy(model.transform(assemble.transform(df))).first()[0]

    whole = measured(test)
    rows = [(c, whole - measured(permuted(test, id_col, c))) for c in columns]
    return prepared.sparkSession.createDataFrame(rows, "feature string, accuracy_loss double")
