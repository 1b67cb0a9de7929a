"""Review analytics: filters, counts, search, words, sub-categories."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.functions import scalars as S
from clicktide.functions import text as X
from clicktide.operators.sampling import page

SENTIMENTS = (S.POSITIVE, S.NEGATIVE, S.NEUTRAL)


def derive_sentiment(df: DataFrame) -> DataFrame:
    """Sentiment from the label where the column is missing; neutral where both are."""
    if "sentiment" in df.columns:
        return df
    if "label" not in df.columns:
        return df.withColumn("sentiment", F.lit(S.NEUTRAL))
    return df.withColumn("sentiment", S.lookup(F.col("label"), {1: S.POSITIVE, 0: S.NEGATIVE}))


def is_valid_pattern(df: DataFrame, query: str) -> bool:
    """Whether the JVM's regex engine accepts the pattern; evaluates one literal."""
    probe = df.sparkSession.range(1).select(F.lit("").rlike("(?iu)" + query))
    try:
        probe.collect()
    except PySparkException:
        return False
    return True


def search_condition(df: DataFrame, column: str, query: str) -> Column:
    """Case-insensitive regex; an invalid pattern is taken literally; null never matches."""
    if is_valid_pattern(df, query):
        return F.coalesce(F.col(column).rlike("(?iu)" + query), F.lit(False))
    return F.coalesce(F.lower(column).contains(query.lower()), F.lit(False))


def regex_search(df: DataFrame, column: str, query: str) -> DataFrame:
    return df.where(search_condition(df, column, query))


def optional_filters(
    df: DataFrame, cat: str | None = None, sentiment: str | None = None, query: str | None = None
) -> DataFrame:
    """Each filter applies only if it is given and not empty."""
    if cat:
        df = df.where(F.col("cat") == cat)
    if sentiment:
        df = df.where(F.col("sentiment") == sentiment)
    if query:
        df = regex_search(df, "review", query)
    return df


def category_distribution(df: DataFrame, sentiment: str | None = None) -> DataFrame:
    return (
        optional_filters(df, sentiment=sentiment)
        .where(F.col("cat").isNotNull())
        .groupBy(F.col("cat").alias("category"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "category")
    )


def sentiment_counts(df: DataFrame, cat: str | None = None, query: str | None = None) -> DataFrame:
    """(category, sentiment, count) of the reviews; any number of sentiments, as a text model may give."""
    picked = optional_filters(df, cat=cat, query=query).where(F.col("sentiment").isNotNull())
    return picked.groupBy(F.col("cat").alias("category"), "sentiment").agg(F.count(F.lit(1)).alias("count"))


def sentiment_pivot(
    df: DataFrame,
    cat: str | None = None,
    query: str | None = None,
    values: Sequence[str] = SENTIMENTS,
    max_others: int = 100,
) -> DataFrame:
    """Reviews per category and sentiment, 0 where there are none.

    Every sentiment found gets a column, after those of ``values``, which are always there. More than
    ``max_others`` further ones are no columns of a table: that raises, and ``sentiment_counts``
    has them as rows.
    """
    counts = sentiment_counts(df, cat, query)
    others = counts.where(~F.col("sentiment").isin(*values)).select("sentiment").distinct()
    found = [r[0] for r in others.limit(max_others + 1).collect()]
    if len(found) > max_others:
        raise ValueError(f"more than {max_others} sentiments besides {list(values)}: use sentiment_counts")
    names = [*values, *sorted(found)]
    pivoted = counts.groupBy("category").pivot("sentiment", names)
    return pivoted.agg(F.sum("count")).fillna(0, subset=names)


def review_page(
    df: DataFrame,
    key: str,
    offset: int = 0,
    limit: int = 20,
    cat: str | None = None,
    sentiment: str | None = None,
    query: str | None = None,
) -> DataFrame:
    """One page of the filtered reviews in source order, with the total of all matches."""
    return page(optional_filters(df, cat, sentiment, query), key, offset, limit)


def word_frequency(
    df: DataFrame,
    top_n: int = 100,
    cat: str | None = None,
    sentiment: str | None = None,
    query: str | None = None,
    tokenizer: Callable[[Column], Column] = X.word_tokens,
    stopwords: frozenset[str] = X.STOPWORDS,
) -> DataFrame:
    """Most frequent words. ``tokenizer`` maps text to an array of tokens; a vectorised UDF
    around a segmenter fits in. Words are counted before the shuffle, so a frequent word
    costs one row per task."""
    if not 10 <= top_n <= 500:
        raise ValueError("top_n must be within 10..500")
    words = (
        optional_filters(df, cat, sentiment, query)
        .where(F.col("review").isNotNull())
        .select(F.explode(tokenizer(F.col("review"))).alias("name"))
        .select(F.trim("name").alias("name"))
        .where(F.length("name") >= 2)
    )
    # What must not count is sorted out after counting, once per word instead of per use.
    return (
        words.groupBy("name")
        .agg(F.count(F.lit(1)).alias("value"))
        .where(X.is_countable(F.col("name"), stopwords))
        .orderBy(F.desc("value"), "name")
        .limit(top_n)
    )


def keyword_groups(
    df: DataFrame, column: str = "review", groups: dict[str, list[str]] = X.SUB_CATEGORY_KEYWORDS
) -> DataFrame:
    """Add a flag per keyword group; a row may be in several."""
    return df.withColumns({g: X.any_keyword(F.col(column), words) for g, words in groups.items()})


def sub_category_stats(
    df: DataFrame,
    cat: str | None = None,
    sentiment: str | None = None,
    query: str | None = None,
    groups: dict[str, list[str]] = X.SUB_CATEGORY_KEYWORDS,
) -> DataFrame:
    """Reviews per keyword group in one pass; empty groups dropped, equal counts in list order."""
    flags = keyword_groups(optional_filters(df, cat, sentiment, query), "review", groups)
    sums = flags.agg(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("rank"),
                    F.lit(g).alias("sub_category"),
                    F.count_if(F.col(f"`{g}`")).alias("count"),
                )
                for i, g in enumerate(groups)
            ]
        ).alias("groups")
    )
    return (
        sums.select(F.inline("groups"))
        .where(F.col("count") > 0)
        .orderBy(F.desc("count"), "rank")
        .select("sub_category", "count")
    )
