"""Queries over reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from clicktide.catalog import register
from clicktide.catalog.shared_sql import REVIEWS, with_
from clicktide.functions import scalars as S
from clicktide.operators import extraction, replies, reviews
from clicktide.session import scratch
from clicktide.sources import adapters as A

# The supplied texts are in European languages; groups and stop-words to match.
GROUPS = {
    "articles": ["the", "der", "les"],
    "endings": ["tion", "keit"],
    "digits": ["[0-9]{2}"],
    "absent": ["zzzzzz"],
}
STOP = frozenset(["the", "of", "and", "de", "der"])


def labelled(spark, sf):
    return reviews.derive_sentiment(A.reviews(spark, sf))


@register("derive_sentiment", with_(REVIEWS, "SELECT doc_id, cat, label, sentiment FROM reviews"))
def derive_sentiment(spark, sf):
    return labelled(spark, sf).drop("review")


@register(
    "category_distribution",
    with_(REVIEWS, "SELECT cat AS category, count(*) AS count FROM reviews GROUP BY cat"),
)
def category_distribution(spark, sf):
    return reviews.category_distribution(labelled(spark, sf))


@register(
    "category_distribution_positive",
    with_(
        REVIEWS,
        "SELECT cat AS category, count(*) AS count FROM reviews WHERE sentiment = '正面' GROUP BY cat",
    ),
)
def category_distribution_positive(spark, sf):
    return reviews.category_distribution(labelled(spark, sf), S.POSITIVE)


@register(
    "sentiment_pivot",
    with_(
        REVIEWS,
        """SELECT cat AS category, count(*) FILTER (s = '正面') AS 正面, count(*) FILTER (s = '负面') AS 负面,
                  CAST(0 AS BIGINT) AS 中性, count(*) FILTER (s = '解析失败') AS 解析失败
           FROM (SELECT cat, CASE WHEN doc_id % 9 = 0 THEN '解析失败' ELSE sentiment END AS s FROM reviews)
           WHERE s IS NOT NULL GROUP BY cat""",
    ),
)
def sentiment_pivot(spark, sf):
    """Some reviews carry the mark of an unusable reply as their sentiment."""
    marked = F.when(F.col("doc_id") % 9 == 0, extraction.FALLBACK).otherwise(F.col("sentiment"))
    return reviews.sentiment_pivot(labelled(spark, sf).withColumn("sentiment", marked))


@register(
    "sentiment_counts",
    with_(
        REVIEWS,
        """SELECT cat AS category, sentiment, count(*) AS count FROM reviews
           WHERE sentiment IS NOT NULL AND regexp_matches(review, 'tion', 'i') GROUP BY cat, sentiment""",
    ),
)
def sentiment_counts(spark, sf):
    return reviews.sentiment_counts(labelled(spark, sf), query="TION")


@register(
    "review_page",
    with_(
        REVIEWS,
        """SELECT doc_id, cat, review, label, sentiment, rn - 1 AS position, total FROM (
             SELECT *, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS total
             FROM reviews WHERE regexp_matches(review, 'tion', 'i'))
           WHERE rn > 40 AND rn <= 60""",
    ),
)
def review_page(spark, sf):
    return reviews.review_page(labelled(spark, sf), "doc_id", offset=40, limit=20, query="TION")


@register(
    "regex_search",
    with_(
        REVIEWS,
        "SELECT doc_id, cat FROM reviews WHERE regexp_matches(review, '[aeé]{2}n?t', 'i')",
    ),
)
def regex_search(spark, sf):
    return reviews.regex_search(A.reviews(spark, sf), "review", "[AEÉ]{2}N?T").select("doc_id", "cat")


@register(
    "literal_search",
    with_(REVIEWS, "SELECT doc_id, cat FROM reviews WHERE contains(lower(review), '***')"),
)
def literal_search(spark, sf):
    """``***`` is no valid pattern and is taken literally."""
    return reviews.regex_search(A.reviews(spark, sf), "review", "***").select("doc_id", "cat")


_FLAGS = {
    "articles": "regexp_matches(review, 'the|der|les', 'i')",
    "endings": "regexp_matches(review, 'tion|keit', 'i')",
    "digits": "regexp_matches(review, '[0-9]{2}')",
    "absent": "regexp_matches(review, 'zzzzzz', 'i')",
}


@register(
    "keyword_groups",
    with_(
        REVIEWS,
        "SELECT doc_id, " + ", ".join(f"{sql} AS {g}" for g, sql in _FLAGS.items()) + " FROM reviews",
    ),
)
def keyword_groups(spark, sf):
    flagged = reviews.keyword_groups(A.reviews(spark, sf), "review", GROUPS)
    return flagged.select("doc_id", *GROUPS)


@register(
    "sub_category_stats",
    with_(
        REVIEWS,
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{g}' AS sub_category, count(*) FILTER ({sql}) AS count FROM reviews"
            for g, sql in _FLAGS.items()
        )
        + ") WHERE count > 0",
    ),
)
def sub_category_stats(spark, sf):
    return reviews.sub_category_stats(labelled(spark, sf), groups=GROUPS)


@register(
    "word_frequency",
    with_(
        REVIEWS,
        r"""SELECT name, count(*) AS value FROM (
             SELECT unnest(regexp_extract_all(review, '[\pL\pM\pN_]+')) AS name FROM reviews)
           WHERE length(name) >= 2 AND name NOT IN ('the', 'of', 'and', 'de', 'der')
             AND NOT regexp_full_match(name, '\pN+')
           GROUP BY name ORDER BY value DESC, name LIMIT 100""",
    ),
)
def word_frequency(spark, sf):
    return reviews.word_frequency(labelled(spark, sf), stopwords=STOP)


@register(
    "word_frequency_filtered",
    with_(
        REVIEWS,
        r"""SELECT name, count(*) AS value FROM (
             SELECT unnest(regexp_extract_all(review, '[\pL\pM\pN_]+')) AS name FROM reviews
             WHERE cat = 'src3' AND regexp_matches(review, 'ent', 'i'))
           WHERE length(name) >= 2 AND name NOT IN ('the', 'of', 'and', 'de', 'der')
             AND NOT regexp_full_match(name, '\pN+')
           GROUP BY name ORDER BY value DESC, name LIMIT 50""",
    ),
)
def word_frequency_filtered(spark, sf):
    return reviews.word_frequency(labelled(spark, sf), 50, cat="src3", query="ent", stopwords=STOP)


_FEATURES = """f AS (
  SELECT doc_id, CASE WHEN length(review) % 7 = 0 THEN '解析失败'
                 WHEN regexp_matches(review, 'tion', 'i') THEN '正面' ELSE '负面' END AS sentiment,
         CASE WHEN length(review) % 7 = 0 THEN '解析失败'
              WHEN regexp_matches(review, 'keit', 'i') THEN '质量' ELSE '综合' END AS category,
         CASE WHEN length(review) % 7 = 0 THEN 'no json: ' || length(review)
              ELSE CAST(length(review) AS VARCHAR) END AS summary FROM reviews)"""


def keyword_extractor(text: str) -> str:
    """Stands in for a text model: answers in JSON, or in prose for some texts."""
    import json

    if len(text) % 7 == 0:
        return f"no json: {len(text)}"
    lower = text.lower()
    return json.dumps(
        {
            "sentiment": "正面" if "tion" in lower else "负面",
            "category": "质量" if "keit" in lower else "综合",
            "summary": str(len(text)),
        },
        ensure_ascii=False,
    )


@register(
    "extract_features",
    with_(REVIEWS + ", " + _FEATURES, "SELECT doc_id, sentiment, category, summary FROM f"),
)
def extract_features(spark, sf):
    found = extraction.extract_features(A.reviews(spark, sf), "review", keyword_extractor)
    return found.select("doc_id", "sentiment", "category", "summary")


@register(
    "extract_features_once",
    with_(
        REVIEWS + ", " + _FEATURES,
        """SELECT doc_id, sentiment, category, summary,
                  (SELECT count(DISTINCT review) FROM reviews) AS asked, 0::BIGINT AS asked_again FROM f""",
    ),
)
def extract_features_once(spark, sf):
    """Equal texts are asked once; what a second run asks is counted beside the features."""
    texts, store = A.reviews(spark, sf), scratch(spark, "replies")
    asked = [replies.fetch_replies(texts, "review", keyword_extractor, store) for _ in range(2)]
    found = replies.extract_features_once(texts, "review", keyword_extractor, store)
    return found.select(
        "doc_id", "sentiment", "category", "summary",
        F.lit(asked[0]).cast("bigint").alias("asked"), F.lit(asked[1]).cast("bigint").alias("asked_again"),
    )


@register(
    "extraction_summary",
    with_(
        REVIEWS + ", " + _FEATURES,
        """SELECT count(*) FILTER (sentiment <> '解析失败') AS succeeded,
                  count(*) FILTER (sentiment = '解析失败') AS fallback,
                  CAST(count(*) FILTER (sentiment <> '解析失败') AS DOUBLE) / count(*) AS success_rate
           FROM f""",
    ),
)
def extraction_summary(spark, sf):
    found = extraction.extract_features(A.reviews(spark, sf), "review", keyword_extractor)
    return extraction.extraction_summary(found)


@register(
    "build_prompt",
    with_(
        REVIEWS,
        "SELECT doc_id, '评论内容：' || substr(review, 1, 30) || '。' AS prompt FROM reviews",
    ),
)
def build_prompt(spark, sf):
    prompt = extraction.build_prompt(S.text_prefix("review", 30), "评论内容：%s。")
    return A.reviews(spark, sf).select("doc_id", prompt.alias("prompt"))
