"""The supplied tables seen as the library's inputs. Whole tables, no row filters by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.functions import scalars as S

# Event types of the events table as behaviours.
EVENT_BEHAVIORS = {"view": "pv", "click": "fav", "signup": "cart", "purchase": "buy"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``timestamp`` in epoch seconds and ``item_id`` from the properties."""
    e = table(spark, sf_dir, "events")
    return e.withColumns(
        {
            "timestamp": F.unix_seconds(F.col("ts").cast("timestamp")),
            "item_id": F.get_json_object("props", "$.k").cast("bigint"),
        }
    )


def behavior(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """The behaviour log; error events are not behaviours."""
    e = events(spark, sf_dir).where(F.col("event_type").isin(*EVENT_BEHAVIORS))
    return e.select(
        *extra,
        "user_id",
        "item_id",
        S.default_category("item_id").alias("category_id"),
        S.lookup(F.col("event_type"), EVENT_BEHAVIORS).alias("behavior_type"),
        "timestamp",
    )


def noisy_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour log with every kind of fault the cleaning removes.

    Each row comes a second time as a view of another category (a clashing copy), and the
    error events are added with an invalid time.
    """
    log = behavior(spark, sf_dir)
    copies = log.withColumns(
        {"category_id": F.col("category_id") + 7, "behavior_type": F.lit("pv")}
    )
    broken = (
        events(spark, sf_dir)
        .where(F.col("event_type") == "error")
        .select(
            "user_id",
            "item_id",
            S.default_category("item_id").alias("category_id"),
            F.lit("pv").alias("behavior_type"),
            F.lit(0).cast("bigint").alias("timestamp"),
        )
    )
    return log.unionByName(copies).unionByName(broken)


def raw_weblog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a dirty web log: padded upper-case types, guests, mixed times, odd JSON."""
    e = events(spark, sf_dir)
    t = F.col("event_type")
    user = F.col("user_id").cast("string")
    return e.select(
        "event_id",
        F.when(t == "error", F.concat(F.lit("guest-"), user))
        .when(F.col("user_id") == 0, "-1")
        .otherwise(user)
        .alias("user_id"),
        F.when(t == "view", F.col("timestamp").cast("string"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("action_time"),
        F.concat(F.lit("  "), F.upper(t), F.lit(" ")).alias("event_type"),
        F.when(t == "signup", "not json")
        .when(t == "click", '{"browser": "b"}')
        .otherwise(F.concat(F.lit('{"os": "os'), F.col("user_id") % 3, F.lit('"}')))
        .alias("device_info"),
        F.col("props").alias("metadata"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews; the label is null where a document has none."""
    d = documents(spark, sf_dir).select(
        "doc_id", F.col("source").alias("cat"), F.col("text").alias("review")
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return d.join(labels, "doc_id", "left")


def load_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a load sample of its event type's queue."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "event_type", "ts", F.round(F.col("value") / 50, 4).alias("load_pct"))


def hourly_arrivals(spark: SparkSession, sf_dir: str, capacity: int = 3) -> DataFrame:
    """Events per type and hour against a constant service capacity."""
    e = events(spark, sf_dir)
    return (
        e.groupBy("event_type", F.floor(F.col("timestamp") / 3600).cast("bigint").alias("hour_no"))
        .agg(F.count(F.lit(1)).alias("arrivals"))
        .withColumn("capacity", F.lit(capacity).cast("bigint"))
    )
