"""Queries over features and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from clicktide.catalog import register
from clicktide.catalog.review import keyword_extractor
from clicktide.catalog.shared_sql import BEHAVIOR, EVENTS, REVIEWS, with_
from clicktide.catalog.stream import _FAULTY, faulty_lines
from clicktide.learning import ablation as AB
from clicktide.learning import buy_model, evaluate, features, tfidf
from clicktide.operators import extraction
from clicktide.operators.sampling import stratified_folds
from clicktide.session import materialize, scratch
from clicktide.sources import adapters as A
from clicktide.streaming import events, run


def feature_rows(spark, sf):
    return features.buy_features(A.behavior(spark, sf, "event_id"), "event_id")


@register(
    "buy_features",
    with_(
        BEHAVIOR,
        """SELECT event_id, CAST(user_id AS DOUBLE) AS user_id, CAST(item_id AS DOUBLE) AS item_id,
                  CAST(category_id AS DOUBLE) AS category_id,
                  CAST(timestamp % 86400 // 3600 AS INTEGER) AS hour,
                  CAST((timestamp // 86400 + 3) % 7 AS INTEGER) AS dayofweek,
                  CAST((timestamp // 86400 + 3) % 7 >= 5 AS INTEGER)::DOUBLE AS is_weekend,
                  CAST(timestamp % 86400 // 3600 AS VARCHAR) AS hour_bucket,
                  CAST((timestamp // 86400 + 3) % 7 AS VARCHAR) AS day_bucket,
                  CAST(behavior_type = 'buy' AS INTEGER) AS label FROM behavior""",
    ),
)
def buy_features(spark, sf):
    return feature_rows(spark, sf)


@register(
    "ordinal_encode",
    with_(
        REVIEWS,
        """, d AS (SELECT cat, dense_rank() OVER (ORDER BY cat) - 1 AS code
             FROM (SELECT DISTINCT cat FROM reviews)),
e AS (SELECT sentiment, dense_rank() OVER (ORDER BY sentiment) - 1 AS code
      FROM (SELECT DISTINCT coalesce(sentiment, 'Unknown') AS sentiment FROM reviews))
SELECT doc_id, d.code AS cat, e.code AS sentiment FROM reviews r JOIN d USING (cat)
JOIN e ON e.sentiment = coalesce(r.sentiment, 'Unknown')""",
    ),
)
def ordinal_encode(spark, sf):
    from clicktide.catalog.review import labelled
    from clicktide.operators.cleaning import fill_unknown

    columns = ["cat", "sentiment"]
    filled = fill_unknown(labelled(spark, sf).select("doc_id", *columns), columns)
    return features.ordinal_encode(filled, columns)


@register(
    "impute_median",
    with_(
        EVENTS,
        """SELECT event_id, round(coalesce(x, (SELECT median(CASE WHEN event_type <> 'error' THEN value END)
             FROM ev)), 6) AS value FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS x FROM ev)""",
    ),
)
def impute_median(spark, sf):
    gappy = A.events(spark, sf).select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    filled = features.impute_median(gappy, ["value"])
    return filled.withColumn("value", F.round("value", 6))


@register(
    "impute_mode",
    with_(
        EVENTS,
        """, g AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS t FROM ev),
m AS (SELECT t FROM g WHERE t IS NOT NULL GROUP BY t ORDER BY count(*) DESC, t LIMIT 1)
SELECT event_id, coalesce(t, (SELECT t FROM m)) AS event_type FROM g""",
    ),
)
def impute_mode(spark, sf):
    gappy = A.events(spark, sf).select(
        "event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type")
    )
    return features.impute_mode(gappy, ["event_type"])


@register(
    "standard_scale",
    """SELECT event_id, round((value - (SELECT avg(value) FROM events))
              / (SELECT stddev_pop(value) FROM events), 6) AS value FROM events""",
)
def standard_scale(spark, sf):
    scaled = features.standard_scale(A.table(spark, sf, "events").select("event_id", "value"), ["value"])
    return scaled.withColumn("value", F.round("value", 6))


@register(
    "one_hot",
    """SELECT event_id, CASE event_type WHEN 'click' THEN '1.0,0.0,0.0,0.0' WHEN 'purchase' THEN '0.0,1.0,0.0,0.0'
              WHEN 'signup' THEN '0.0,0.0,1.0,0.0' WHEN 'view' THEN '0.0,0.0,0.0,1.0'
              ELSE '0.0,0.0,0.0,0.0' END AS encoded FROM events""",
)
def one_hot(spark, sf):
    """Fitted without error events, which therefore become zeros."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    e = A.table(spark, sf, "events").select("event_id", "event_type")
    model = Pipeline(stages=features.one_hot(["event_type"])).fit(e.where("event_type <> 'error'"))
    encoded = vector_to_array("event_type_vec").cast("array<string>")
    return model.transform(e).select("event_id", F.array_join(encoded, ",").alias("encoded"))


_TFIDF = """, d AS (SELECT doc_id, regexp_replace(lower(coalesce(review, '')), '\\s\\s+', ' ', 'g') AS t FROM reviews),
c AS (SELECT doc_id, c, count(*) AS tf FROM (SELECT doc_id, unnest(string_split(t, '')) AS c FROM d)
      WHERE c <> '' GROUP BY doc_id, c),
v AS (SELECT c, sum(tf) AS total, count(*) AS df FROM c GROUP BY c ORDER BY total DESC, c LIMIT 40),
w AS (SELECT doc_id, c AS feature, tf * (ln((1 + (SELECT count(*) FROM d))::DOUBLE / (1 + df)) + 1) AS w
      FROM c JOIN v USING (c))
SELECT doc_id, feature, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w"""


@register("char_tfidf", with_(REVIEWS, _TFIDF))
def char_tfidf(spark, sf):
    reviews = A.reviews(spark, sf).select("doc_id", "review")
    fitted = tfidf.fit_char_tfidf(reviews, "review", max_features=40)
    vectors = fitted.transform(reviews, "review", "vector")
    found = tfidf.weights(vectors, "doc_id", "vector", fitted.vocabulary)
    return found.withColumn("weight", F.round("weight", 6))


@register(
    "roc_auc",
    """WITH s AS (SELECT value, CAST(event_type = 'purchase' AS INTEGER) AS y FROM events),
       m AS (SELECT max(value) AS top FROM s),
       g AS (SELECT value / top AS p, sum(y) AS pos, sum(1 - y) AS neg FROM s, m GROUP BY 1),
       r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS below FROM g)
       SELECT round(sum(pos * (below + neg / 2.0))::DOUBLE / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 8) AS auc
       FROM r""",
)
def roc_auc(spark, sf):
    e = A.table(spark, sf, "events")
    top = e.agg(F.max("value")).first()[0]
    scores = e.select(
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        (F.col("value") / F.lit(top)).alias("probability"),
    )
    return evaluate.roc_auc(scores).select(F.round("auc", 8).alias("auc"))


@register(
    "accuracy",
    with_(
        BEHAVIOR,
        """SELECT round(avg(CAST((behavior_type = 'buy') = (item_id % 500 + 1 > 50) AS INTEGER)), 8) AS accuracy
           FROM behavior""",
    ),
)
def accuracy(spark, sf):
    guessed = feature_rows(spark, sf).withColumn("prediction", (F.col("category_id") > 50).cast("int"))
    return evaluate.accuracy(guessed).select(F.round("accuracy", 8).alias("accuracy"))


_LABELLED = """SELECT event_id, CAST(behavior_type = 'buy' AS INTEGER) AS label, true AS p_in_range,
                       true AS label_follows_p, true AS at_the_optimum FROM behavior"""


@register("buy_model_scores", with_(BEHAVIOR, _LABELLED))
def buy_model_scores(spark, sf):
    """Scores of every event, checked row by row, and whether the fit is at its optimum: there every
    part of the penalised loss's gradient is nearly zero."""
    rows = feature_rows(spark, sf)
    weighted, n = buy_model.balanced_weights(rows)
    model = buy_model.train_buy_model(rows)
    slope = buy_model.steepest_slope(model, weighted, n)
    return buy_model.score(model, rows).select(
        "event_id",
        "label",
        F.col("p").between(0, 1).alias("p_in_range"),
        (F.col("prediction") == (F.col("p") >= 0.5).cast("double")).alias("label_follows_p"),
        F.lit(slope < 1e-4).alias("at_the_optimum"),
    )


@register(
    "cv_metrics",
    with_(
        BEHAVIOR,
        """SELECT CAST(f AS INTEGER) AS fold, true AS in_range,
                  (SELECT count(*) FROM (SELECT (row_number() OVER (PARTITION BY behavior_type = 'buy'
                     ORDER BY md5(CAST(event_id AS VARCHAR) || '42'), event_id) - 1) % 5 AS fold FROM behavior)
                   WHERE fold = f) AS rows FROM range(5) t(f)""",
    ),
)
def cv_metrics(spark, sf):
    """Rows of each fold, and whether its figures lie between 0 and 1."""
    rows = feature_rows(spark, sf)
    sizes = stratified_folds(rows, "label", "event_id").groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))
    figures = buy_model.cross_validate(rows, "event_id")
    in_range = F.col("accuracy").between(0, 1) & F.col("auc").between(0, 1)
    return figures.join(sizes, "fold").select("fold", in_range.alias("in_range"), "rows")


@register(
    "score_stream",
    with_(
        _FAULTY,
        """SELECT event_time, user_id, item_id, item_id % 500 + 1 AS category_id, '' AS error,
                  true AS p_in_range, true AS label_follows_p FROM r WHERE error IS NULL""",
    ),
)
def score_stream(spark, sf):
    """A model is trained, saved, loaded again and used on the stream of faulty events."""
    path = scratch(spark, "model")
    buy_model.train_buy_model(feature_rows(spark, sf)).write().save(path)
    scorer, reason = events.load_scorer(spark, path)
    if reason:
        raise RuntimeError(reason)
    out, _ = run.run_available(
        events.score_and_route(faulty_lines(spark, sf), scorer), "model-scored", by=["route"]
    )
    p = F.col("buy_probability")
    return events.scored_events(run.read_batches(spark, out)).select(
        "event_time",
        "user_id",
        "item_id",
        "category_id",
        "error",
        p.between(0, 1).alias("p_in_range"),
        (F.col("predicted_label") == (p >= 0.5).cast("int")).alias("label_follows_p"),
    )


def prepared(spark, sf):
    """Vectors of the labelled reviews; the extractor runs once."""
    labelled = A.reviews(spark, sf).where(F.col("label").isNotNull())
    found = extraction.extract_features(labelled, "review", keyword_extractor)
    return AB.prepare(materialize(found, "extracted"), "doc_id")


# The 500 most frequent characters of labelled reviews, and the reviews' characters among them.
_CHARS = """, d AS (SELECT doc_id, cat, regexp_replace(lower(coalesce(review, '')), '\\s\\s+', ' ', 'g') AS t,
                    length(review) AS n, review FROM reviews WHERE label IS NOT NULL),
c AS (SELECT doc_id, c, count(*) AS tf FROM (SELECT doc_id, unnest(string_split(t, '')) AS c FROM d)
      WHERE c <> '' GROUP BY doc_id, c),
v AS (SELECT c FROM c GROUP BY c ORDER BY sum(tf) DESC, c LIMIT 500)"""


@register(
    "fuse",
    with_(
        REVIEWS,
        _CHARS
        + """, k AS (SELECT doc_id, count(*) AS nnz FROM c JOIN v USING (c) GROUP BY doc_id),
e AS (SELECT doc_id, dense_rank() OVER (ORDER BY cat) - 1 AS cat_code,
       dense_rank() OVER (ORDER BY CASE WHEN n % 7 = 0 THEN '解析失败'
         WHEN regexp_matches(review, 'tion', 'i') THEN '正面' ELSE '负面' END) - 1 AS s_code,
       dense_rank() OVER (ORDER BY CASE WHEN n % 7 = 0 THEN '解析失败'
         WHEN regexp_matches(review, 'keit', 'i') THEN '质量' ELSE '综合' END) - 1 AS c_code FROM d)
SELECT doc_id, (SELECT count(*) FROM v) + 3 AS width,
       coalesce(nnz, 0) + CAST(cat_code > 0 AS INTEGER) + CAST(s_code > 0 AS INTEGER)
         + CAST(c_code > 0 AS INTEGER) AS non_zero
FROM e LEFT JOIN k USING (doc_id)""",
    ),
)
def fuse(spark, sf):
    """Width and non-zero entries of each review's text vector with its dense columns."""
    vectors, fitted = prepared(spark, sf)
    v = F.unwrap_udt("features")
    width = F.coalesce(v["size"], F.size(v["values"])).cast("bigint")
    filled = F.size(F.filter(v["values"], lambda x: x != 0)).cast("bigint")
    return vectors.select("doc_id", width.alias("width"), filled.alias("non_zero"))


@register(
    "ablation",
    with_(
        REVIEWS,
        _CHARS
        + """SELECT experiment, CAST(CASE k WHEN 0 THEN vs WHEN 1 THEN 3 ELSE vs + 3 END AS INTEGER) AS features,
       true AS in_range, true AS deltas_add_up
FROM (SELECT count(*) AS vs FROM v), (VALUES ('A text', 0), ('B dense', 1), ('C fused', 2)) t(experiment, k)""",
    ),
)
def ablation(spark, sf):
    """Widths of the three experiments, and whether their figures are possible and consistent."""
    figures = AB.ablation(prepared(spark, sf)[0])
    base = figures.where("experiment = 'A text'").first()
    in_range = F.col("accuracy").between(0, 1) & F.col("auc").between(0, 1)
    adds_up = (F.col("delta_accuracy") == F.col("accuracy") - base["accuracy"]) & (
        F.col("delta_auc") == F.col("auc") - base["auc"]
    )
    return figures.select("experiment", "features", in_range.alias("in_range"), adds_up.alias("deltas_add_up"))


def _attributions(spark, sf):
    vectors, fitted = prepared(spark, sf)
    return AB.linear_attributions(vectors, [f"字_{c}" for c in fitted.vocabulary] + list(AB.DENSE))


@register(
    "attribution_top",
    with_(REVIEWS, _CHARS + "SELECT CAST(i AS INTEGER) AS place, true AS falling FROM range(1, 16) t(i)"),
)
def attribution_top(spark, sf):
    """The fifteen strongest features by place: none is stronger than the one before."""
    rows = AB.top_features(_attributions(spark, sf)).collect()
    strength = [float("inf")] + [r["mean_abs_attribution"] for r in rows]
    falling = [(i, strength[i] <= strength[i - 1]) for i in range(1, len(strength))]
    return spark.createDataFrame(falling, "place int, falling boolean")


@register(
    "attribution_audit",
    with_(
        REVIEWS,
        _CHARS
        + """SELECT CAST(3 AS BIGINT) AS dense_features, count(*) AS text_features,
       true AS totals_add_up, true AS means_add_up FROM v""",
    ),
)
def attribution_audit(spark, sf):
    """Sizes of both groups, and whether totals and means agree with the single features."""
    single = materialize(_attributions(spark, sf), "attributions")
    total = single.agg(F.sum("mean_abs_attribution")).first()[0]

    def close(a, b):
        return F.abs(a - b) <= 1e-9 * F.greatest(F.abs(b), F.lit(1.0))

    audit = AB.attribution_audit(single)
    dense, text = F.col("dense_features"), F.col("text_features")
    means = close(F.col("dense_mean") * dense, F.col("dense_total")) & close(
        F.col("text_mean") * text, F.col("text_total")
    )
    return audit.select(
        "dense_features",
        "text_features",
        close(F.col("dense_total") + F.col("text_total"), F.lit(total)).alias("totals_add_up"),
        means.alias("means_add_up"),
    )
