import pytest
from pyspark.sql import functions as F

from clicktide.functions import scalars as S
from clicktide.operators import cleaning, profile, quality


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_behavior_codes(spark):
    assert column(spark, [1, 2, 3, 4, 9], F.col("x"), "int") == [1, 2, 3, 4, 9]
    coded = spark.createDataFrame([(1,), (2,), (3,), (4,), (9,)], "behavior_type int")
    assert [r[0] for r in cleaning.map_behavior_code(coded).collect()] == ["pv", "cart", "fav", "buy", "9"]
    text = spark.createDataFrame([("1",), ("pv",)], "behavior_type string")
    assert [r[0] for r in cleaning.map_behavior_code(text).collect()] == ["1", "pv"]


def test_event_id_by_type(spark):
    numbers = spark.createDataFrame([(None,), (0,), (-3,), (4,)], "event_id bigint")
    assert [r[0] for r in numbers.where(cleaning.valid_event_id(numbers)).collect()] == [4]
    texts = spark.createDataFrame([(None,), ("",), ("0",), ("x",)], "event_id string")
    assert [r[0] for r in texts.where(cleaning.valid_event_id(texts)).collect()] == ["0", "x"]


def test_numbers_and_times(spark):
    values = ["12.7", " 5 ", "-3.9", "1e3", "12d", "nan", "", None, "not_an_int", "99999999999999999999"]
    assert column(spark, values, S.safe_int("x")) == [12, 5, -3, 1000, None, None, None, None, None, None]
    times = ["1970-1-1 0:0:05.1", "1970-01-01 00:00:05.1", "1970-01-01 00:00:05.123", "1970-01-01 00:00:05.123456",
             "1970-01-01 00:00:05", "2099/99/99 99:99:99", "1970-13-01 00:00:05.1", None]
    assert column(spark, times, S.event_seconds("x")) == [5, 5, 5, 5, None, None, None, None]
    mixed = ["1970-01-01T00:01:00", "61", " 62 ", "junk", None]
    assert column(spark, mixed, F.unix_seconds(S.mixed_time("x"))) == [60, 61, 62, None, None]


def test_weekday_is_monday_based(spark):
    saturday = 1704500000
    assert column(spark, [saturday], S.weekday_of("x"), "bigint") == [5]
    assert column(spark, [saturday], S.weekend_flag(S.weekday_of("x")), "bigint") == [1.0]


def test_json_field(spark):
    values = ['{"os": "iOS"}', '{"a": 1}', "broken", "", None]
    assert column(spark, values, S.os_name("x")) == ["iOS", "Unknown", "Error", "Error", "Error"]
    assert column(spark, values, S.json_field("x", "$.os")) == ["iOS", None, None, None, None]


def test_mask_and_rules(spark):
    masked = column(spark, ["7", None, ""], S.mask_id("x"))
    assert len(masked[0]) == 64 and masked[1] == masked[2]
    rules = [" Buy ", "purchase", "cart", "fav", "PV", "view", "other", None]
    assert column(spark, rules, S.rule_probability("x")) == [0.95, 0.95, 0.35, 0.25, 0.08, 0.08, 0.12, 0.12]
    assert column(spark, rules, S.normalize_behavior("x")) == [
        "buy", "buy", "cart", "fav", "view", "view", "other", None]


def test_violators_and_suspects(log):
    rows = [(1, 1, 1, "buy", 1), (1, 1, 1, "pv", 1), (2, 1, 1, "buy", 1), (3, 1, 1, "fav", 1)]
    assert [r["user_id"] for r in cleaning.violators(log(rows)).collect()] == [2]
    views = [(1, i, 1, "pv", 5) for i in range(501)] + [(2, i, 1, "pv", 5) for i in range(500)] * 2
    assert [r["user_id"] for r in cleaning.suspect_users(log(views)).collect()] == [1]
    both = cleaning.suspect_users(log(views), dedup_first=False)
    assert {r["user_id"]: r["pv_count"] for r in both.collect()} == {1: 501, 2: 1000}


def test_funnel(log):
    rows = [(1, 1, 1, "buy", 1), (2, 1, 1, "pv", 1), (2, 1, 1, "buy", 1), (3, 1, 1, "pv", 1),
            (3, 1, 1, "cart", 1), (4, 1, 1, "pv", 1), (4, 1, 1, "fav", 1), (4, 1, 1, "buy", 1)]
    found = profile.funnel(log(rows)).first()
    assert tuple(found) == (3, 2, 1, 2 / 3, 1 / 2)
    assert tuple(profile.funnel(log([])).first()) == (0, 0, 0, 0.0, 0.0)


@pytest.mark.parametrize("top", [0.0, 0.2, 0.5, 1.0])
def test_hot_item_share(log, top):
    counts = [9, 7, 7, 7, 3, 1, 1, 1, 1, 1]
    rows = [(1, item, 1, "pv", i) for item, n in enumerate(counts) for i in range(n)]
    hot = max(1, int(len(counts) * top))
    found = profile.hot_item_share(log(rows), top).first()
    assert found["hot_items"] == hot and found["hot_rows"] == sum(counts[:hot])


def test_purchase_peak_takes_the_first_of_equals(log):
    rows = [(1, 1, 1, "buy", 3600 * h) for h in (5, 5, 2, 2, 9)]
    assert tuple(profile.purchase_peak(log(rows)).first()) == (2, 2)


def test_numeric_columns(spark):
    df = spark.createDataFrame([("1", "a", "2"), ("2", "3", ""), ("x", "b", None)], "a string, b string, c string")
    assert cleaning.numeric_columns(df, ["c", "zz"]) == ["c"]
    assert cleaning.numeric_columns(df) == ["a", "c"]
    assert cleaning.numeric_columns(df.select("a", "b")) == ["a", "b"]


def test_adaptive_clean_uses_what_is_there(spark):
    df = spark.createDataFrame([(" A ", None, "", "t", "1.1.1.1", "x1"), ("b", "7", "d", "t", "2.2.2.2", "")],
                               "event_type string, user_id string, device_info string, timestamp string, ip string, event_id string")
    clean = cleaning.adaptive_clean(df)
    assert clean.columns == ["event_id", "event_type", "masked_user_id", "device_info", "timestamp", "ip"]
    assert [r["event_type"] for r in clean.collect()] == ["a"]
    assert quality.cleaned_log_report(clean).where("passed").count() == 3


def test_quality_finds_faults(spark, log):
    rows = [(1, 1, 1, "pv", 5), (1, 1, 1, "pv", 5), (2, 1, 1, "buy", -1), (3, 1, 1, "odd", 5),
            (None, None, 1, None, None)]
    report = {r["check"]: (r["passed"], r["detail"]) for r in quality.quality_report(log(rows), min_rows=6).collect()}
    assert report["rows_present"] == (True, "5") and report["rows_enough"] == (False, "5")
    assert report["behavior_domain"] == (False, "2") and report["no_empty_row"] == (False, "1")
    assert report["no_negative_time"] == (False, "1") and report["no_duplicates"] == (False, "1")
    assert report["buy_within_pv"] == (False, "1") and report["null_ratio_item_id"] == (False, "1")
    missing = quality.quality_report(log(rows).drop("item_id"))
    assert {r["check"]: r["passed"] for r in missing.collect()}["columns_present"] is False
    assert [r["passed"] for r in quality.check_path(spark, "/tmp/nothing-here").collect()] == [False]
    assert {r["passed"] for r in quality.quality_report(log([]), min_rows=0).where(
        "check not like 'rows%'").collect()} == {True}


def test_hot_user_is_split_in_a_join_per_user(spark):
    """With broadcasts off, adaptive execution cuts the hot user's rows into several tasks."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        i = F.col("id")
        rows = spark.range(0, 60_000, 1, 8).select(
            F.when(i % 3 == 0, 7).otherwise(i % 500).alias("user_id"),
            i.alias("item_id"),
            F.lit("pv").alias("behavior_type"),
            i.alias("timestamp"),
        )
        kept = cleaning.keep_valid_users(rows, cleaning.user_balance(rows).where("valid"))
        checked = kept.agg(F.count(F.lit(1)), F.max(F.xxhash64(*kept.columns)))
        assert checked.collect()[0][0] == 60_000
        plan = checked._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
