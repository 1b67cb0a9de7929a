import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from clicktide.functions.text import word_tokens
from clicktide.operators import extraction, reviews

# Python workers do not see the test folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "id bigint, cat string, label int, review string"


@pytest.fixture(scope="module")
def shop(spark):
    rows = [
        (1, "书籍", 1, "质量 很好，快递 FAST [ok]"),
        (2, "书籍", 0, "价格太贵 客服态度差 fast"),
        (3, "水果", 1, None),
        (4, "水果", None, "物流慢 12 34"),
        (5, "水果", 0, "包装破损"),
    ]
    return reviews.derive_sentiment(spark.createDataFrame(rows, SCHEMA))


def test_sentiment(shop, spark):
    assert [r["sentiment"] for r in shop.orderBy("id").collect()] == ["正面", "负面", "正面", None, "负面"]
    bare = spark.createDataFrame([("a",)], "review string")
    assert reviews.derive_sentiment(bare).first()["sentiment"] == "中性"


def test_search(shop):
    def ids(q):
        return [r["id"] for r in reviews.regex_search(shop, "review", q).orderBy("id").collect()]

    assert ids("fast") == [1, 2] and ids("F.ST") == [1, 2]
    assert ids("[") == [1]
    assert ids("快递|物流") == [1, 4]


def test_optional_filters(shop):
    def n(**k):
        return reviews.optional_filters(shop, **k).count()

    assert n() == n(cat="", sentiment="", query="") == 5
    assert n(cat="水果") == 3 and n(cat="水果", sentiment="负面") == 1 and n(query="fast", cat="书籍") == 2


def test_pivot(shop):
    found = {r["category"]: (r["正面"], r["负面"], r["中性"]) for r in reviews.sentiment_pivot(shop).collect()}
    assert found == {"书籍": (1, 1, 0), "水果": (1, 1, 0)}


def test_sub_categories_count_a_row_in_each_group(shop):
    found = [tuple(r) for r in reviews.sub_category_stats(shop).collect()]
    assert found == [("物流", 2), ("质量", 2), ("价格", 1), ("服务", 1), ("包装", 1)]
    assert reviews.sub_category_stats(shop, cat="none").collect() == []


def test_words(shop, spark):
    tokens = spark.createDataFrame([("ab 质量好 x_1，破损",)], "t string").select(word_tokens(F.col("t")))
    assert tokens.first()[0] == ["ab", "质量", "量好", "x_1", "破损"]
    counted = {r["name"]: r["value"] for r in reviews.word_frequency(shop, 10).collect()}
    assert counted["fast"] == 1 and counted["FAST"] == 1 and "12" not in counted and "慢" not in counted
    with pytest.raises(ValueError):
        reviews.word_frequency(shop, 5)


def test_plugged_tokenizer(shop):
    words = reviews.word_frequency(shop, 10, tokenizer=lambda c: F.split(c, " "))
    assert {"很好，快递", "FAST", "[ok]"} <= {r["name"] for r in words.collect()}


def test_page(shop):
    page = reviews.review_page(shop, "id", offset=1, limit=2, cat="水果").collect()
    assert [r["id"] for r in page] == [4, 5] and {r["total"] for r in page} == {3}


class Flaky:
    """Fails with a retryable error until its third call for a text."""

    def __init__(self):
        self.calls = 0

    def __call__(self, text):
        self.calls += text == "flaky"
        if text == "flaky" and self.calls < 3:
            raise extraction.RetryableError("busy")
        if text == "fatal":
            raise ValueError("unretryable")
        if text == "prose":
            return "Here is a long answer that is not JSON at all"
        return json.dumps({"sentiment": "正面", "category": "质量", "summary": text})


def test_extraction(spark):
    df = spark.createDataFrame([(1, "flaky"), (2, "prose"), (3, "good")], "id int, review string").coalesce(1)
    found = extraction.extract_features(df, "review", Flaky(), wait=(0.0, 0.01)).orderBy("id").collect()
    assert tuple(found[0])[2:] == ("正面", "质量", "flaky", None)
    assert tuple(found[1])[2:] == ("解析失败", "解析失败", "Here is a long answer that is ", None)
    whole = extraction.extract_features(df, "review", Flaky(), whole_fallback=True, wait=(0.0, 0.01))
    assert tuple(whole.orderBy("id").collect()[1])[2:] == ("解析失败",) * 3 + (None,)
    assert tuple(extraction.extraction_summary(whole).first()) == (2, 1, 2 / 3)


def test_extraction_gives_up_on_other_errors(spark):
    df = spark.createDataFrame([("fatal",)], "review string")
    with pytest.raises(Exception, match="unretryable"):
        extraction.extract_features(df, "review", Flaky(), on_error="raise").collect()
    with pytest.raises(extraction.RetryableError):
        def always(text):
            raise extraction.RetryableError(text)

        extraction.call_with_retry(always, "x", 3, (0.0, 0.0), (extraction.RetryableError,))
