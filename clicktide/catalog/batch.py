"""Queries over the behaviour log, raw web log and load series."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from clicktide.catalog import register
from clicktide.catalog.shared_sql import (
    ARRIVALS,
    BEHAVIOR,
    EVENTS,
    NOISY,
    WEBLOG,
    dedup_sql,
    sessions_sql,
    with_,
)
from clicktide.functions import scalars as S
from clicktide.operators import cleaning, ordered, profile, quality, sampling, series, sessions, sketches
from clicktide.plans.behavior import clean_behavior
from clicktide.session import scratch
from clicktide.sources import adapters as A
from clicktide.sources import readers, versioned, writers

LONG_TIMEOUT = 21_600
THRESHOLD = 15

# -- projections, filters, cleaning ------------------------------------------------------


@register(
    "select_rename",
    with_(BEHAVIOR, "SELECT user_id AS uid, item_id, behavior_type AS behavior FROM behavior"),
)
def select_rename(spark, sf):
    log = A.behavior(spark, sf).drop("category_id", "timestamp")
    return cleaning.rename(log, {"user_id": "uid", "behavior_type": "behavior"})


@register(
    "map_behavior_code",
    with_(
        EVENTS,
        """SELECT event_id, CASE code WHEN 1 THEN 'pv' WHEN 2 THEN 'cart' WHEN 3 THEN 'fav'
             WHEN 4 THEN 'buy' ELSE CAST(code AS VARCHAR) END AS behavior_type
           FROM (SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'signup' THEN 2
             WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 9 END AS code FROM ev)""",
    ),
)
def map_behavior_code(spark, sf):
    codes = {"view": 1, "signup": 2, "click": 3, "purchase": 4}
    coded = A.events(spark, sf).select(
        "event_id", S.lookup(F.col("event_type"), codes, F.lit(9)).alias("behavior_type")
    )
    return cleaning.map_behavior_code(coded)


@register(
    "normalize_behavior",
    with_(
        WEBLOG,
        """SELECT t AS behavior, count(*) AS cnt FROM (
             SELECT CASE WHEN lower(trim(event_type)) IN ('buy', 'purchase') THEN 'buy'
                         WHEN lower(trim(event_type)) IN ('pv', 'view') THEN 'view'
                         ELSE lower(trim(event_type)) END AS t FROM weblog) GROUP BY t""",
    ),
)
def normalize_behavior(spark, sf):
    log = A.raw_weblog(spark, sf)
    return log.groupBy(S.normalize_behavior("event_type").alias("behavior")).agg(
        F.count(F.lit(1)).alias("cnt")
    )


@register(
    "drop_invalid",
    with_(
        NOISY,
        """SELECT behavior_type, count(*) AS cnt FROM noisy
           WHERE timestamp > 0 AND behavior_type IS NOT NULL AND behavior_type <> ''
           GROUP BY behavior_type""",
    ),
)
def drop_invalid(spark, sf):
    log = cleaning.drop_blank(cleaning.drop_invalid_time(A.noisy_log(spark, sf)), "behavior_type")
    return log.groupBy("behavior_type").agg(F.count(F.lit(1)).alias("cnt"))


@register(
    "mask_users",
    with_(
        WEBLOG,
        "SELECT event_id, sha256(coalesce(user_id, '')) AS masked_user_id FROM weblog",
    ),
)
def mask_users(spark, sf):
    return cleaning.mask_user_id(A.raw_weblog(spark, sf).select("event_id", "user_id"))


@register(
    "adaptive_clean",
    with_(
        WEBLOG,
        """SELECT event_id, lower(trim(event_type)) AS event_type,
                  sha256(coalesce(user_id, '')) AS masked_user_id, device_info, action_time, metadata
           FROM weblog WHERE event_id IS NOT NULL AND event_id > 0""",
    ),
)
def adaptive_clean(spark, sf):
    return cleaning.adaptive_clean(A.raw_weblog(spark, sf))


@register(
    "removal_report",
    with_(
        WEBLOG,
        """SELECT count(*) AS rows_before, count(*) FILTER (event_id > 0) AS rows_after,
                  count(*) - count(*) FILTER (event_id > 0) AS rows_removed,
                  (count(*) - count(*) FILTER (event_id > 0)) * 100.0 / count(*) AS removed_pct
           FROM weblog""".replace("* 100.0 /", "* CAST(100.0 AS DOUBLE) /"),
    ),
)
def removal_report(spark, sf):
    raw = A.raw_weblog(spark, sf)
    return cleaning.removal_report(raw, cleaning.adaptive_clean(raw))


@register(
    "special_users",
    with_(
        WEBLOG,
        """SELECT count(*) FILTER (user_id = '-1') AS minus_one,
                  count(*) FILTER (user_id = 'guest' OR user_id LIKE 'guest-%') AS guests
           FROM weblog""",
    ),
)
def special_users(spark, sf):
    return cleaning.special_user_counts(A.raw_weblog(spark, sf))


@register(
    "coerce_numeric",
    with_(
        WEBLOG,
        """SELECT event_id, try_cast(user_id AS DOUBLE) AS user_id,
                  try_cast(action_time AS DOUBLE) AS action_time
           FROM weblog WHERE try_cast(user_id AS DOUBLE) IS NOT NULL""",
    ),
)
def coerce_numeric(spark, sf):
    log = A.raw_weblog(spark, sf).select("event_id", "user_id", "action_time")
    return cleaning.drop_null_rows(cleaning.coerce_numeric(log, ["user_id", "action_time"]), ["user_id"])


@register(
    "mixed_time",
    with_(
        WEBLOG,
        """SELECT event_id, CAST(floor(epoch(CASE WHEN regexp_full_match(action_time, '[0-9]+')
                  THEN to_timestamp(CAST(action_time AS BIGINT))::TIMESTAMP
                  ELSE CAST(action_time AS TIMESTAMP) END)) AS BIGINT) AS action_seconds
           FROM weblog""".replace(
            "to_timestamp(CAST(action_time AS BIGINT))::TIMESTAMP",
            "make_timestamp(TRY_CAST(action_time AS BIGINT) * 1000000)",
        ).replace("CAST(action_time AS TIMESTAMP)", "TRY_CAST(action_time AS TIMESTAMP)"),
    ),
)
def mixed_time(spark, sf):
    log = A.raw_weblog(spark, sf)
    return log.select("event_id", F.unix_seconds(S.mixed_time("action_time")).alias("action_seconds"))


@register(
    "json_field",
    with_(
        WEBLOG,
        """SELECT os, count(*) AS cnt FROM (
             SELECT CASE WHEN NOT json_valid(device_info) THEN 'Error'
                         ELSE coalesce(CASE WHEN json_valid(device_info) THEN device_info END ->> '$.os',
                                       'Unknown') END AS os FROM weblog)
           GROUP BY os""",
    ),
)
def json_field(spark, sf):
    log = A.raw_weblog(spark, sf).select(S.os_name().alias("os"))
    return profile.value_counts(log, "os", "cnt")


@register(
    "numeric_detect",
    with_(
        WEBLOG,
        """SELECT avg(CAST(try_cast(CAST(event_id AS VARCHAR) AS DOUBLE) IS NOT NULL AS INT)) AS event_id,
                  avg(CAST(try_cast(user_id AS DOUBLE) IS NOT NULL AS INT)) AS user_id,
                  avg(CAST(try_cast(action_time AS DOUBLE) IS NOT NULL AS INT)) AS action_time,
                  avg(CAST(try_cast(event_type AS DOUBLE) IS NOT NULL AS INT)) AS event_type
           FROM weblog""",
    ),
)
def numeric_detect(spark, sf):
    log = A.raw_weblog(spark, sf).select("event_id", "user_id", "action_time", "event_type")
    return cleaning.numeric_shares(log)


# -- de-duplication, bots, violators, the cleaned log --------------------------------------

_KEPT = dedup_sql(
    "(SELECT * FROM noisy WHERE timestamp > 0)",
    "user_id, item_id, timestamp",
    "behavior_type, category_id",
)
_SUSPECT_SQL = f"""SELECT user_id, count(*) AS pv_count FROM (
  SELECT DISTINCT user_id, item_id, timestamp FROM noisy
  WHERE timestamp > 0 AND behavior_type = 'pv') GROUP BY user_id HAVING count(*) > {THRESHOLD}"""


@register("dedup", with_(NOISY, _KEPT))
def dedup(spark, sf):
    return cleaning.dedup(cleaning.drop_invalid_time(A.noisy_log(spark, sf)))


@register(
    "dedup_by_behavior",
    with_(
        NOISY,
        dedup_sql("noisy", "user_id, item_id, behavior_type, timestamp", "category_id"),
    ),
)
def dedup_by_behavior(spark, sf):
    return cleaning.dedup(A.noisy_log(spark, sf), cleaning.DEDUP_KEYS_WITH_BEHAVIOR)


@register("suspect_users", with_(NOISY, _SUSPECT_SQL))
def suspect_users(spark, sf):
    return cleaning.suspect_users(A.noisy_log(spark, sf), THRESHOLD)


@register(
    "suspect_users_before_dedup",
    with_(
        NOISY,
        f"""SELECT user_id, count(*) AS pv_count FROM noisy
            WHERE timestamp > 0 AND behavior_type = 'pv'
            GROUP BY user_id HAVING count(*) > {4 * THRESHOLD}""",
    ),
)
def suspect_users_before_dedup(spark, sf):
    return cleaning.suspect_users(A.noisy_log(spark, sf), 4 * THRESHOLD, dedup_first=False)


@register(
    "drop_suspects",
    with_(
        BEHAVIOR,
        f"""SELECT user_id, item_id, category_id, behavior_type, timestamp FROM behavior
            WHERE user_id NOT IN (SELECT user_id FROM behavior WHERE behavior_type = 'pv'
                                  GROUP BY user_id HAVING count(*) > {THRESHOLD})""",
    ),
)
def drop_suspects(spark, sf):
    log = A.behavior(spark, sf)
    return cleaning.drop_suspects(log, cleaning.suspect_users(log, THRESHOLD, dedup_first=False))


@register(
    "suspect_impact",
    with_(
        BEHAVIOR,
        f"""SELECT count(*) FILTER (n > {THRESHOLD}) AS suspects,
                   CAST(coalesce(sum(n) FILTER (n > {THRESHOLD}), 0) AS BIGINT) AS suspect_pv,
                   CAST(sum(n) AS BIGINT) AS total_pv,
                   CAST(coalesce(sum(n) FILTER (n > {THRESHOLD}), 0) AS DOUBLE)
                     / CAST(sum(n) AS DOUBLE) AS suspect_ratio
            FROM (SELECT user_id, count(*) AS n FROM behavior
                  WHERE behavior_type = 'pv' GROUP BY user_id)""",
    ),
)
def suspect_impact(spark, sf):
    return profile.suspect_impact(A.behavior(spark, sf), THRESHOLD)


@register(
    "violators",
    with_(
        BEHAVIOR,
        """SELECT user_id, count(*) FILTER (behavior_type = 'buy') AS buy_cnt,
                  count(*) FILTER (behavior_type = 'pv') AS pv_cnt
           FROM behavior GROUP BY user_id
           HAVING count(*) FILTER (behavior_type = 'buy') > count(*) FILTER (behavior_type = 'pv')""",
    ),
)
def violators(spark, sf):
    return cleaning.violators(A.behavior(spark, sf))


@register(
    "keep_valid_users",
    with_(
        BEHAVIOR,
        """SELECT user_id, item_id, category_id, behavior_type, timestamp FROM behavior
           WHERE user_id IN (SELECT user_id FROM behavior GROUP BY user_id
             HAVING count(*) FILTER (behavior_type = 'buy') <= count(*) FILTER (behavior_type = 'pv'))""",
    ),
)
def keep_valid_users(spark, sf):
    log = A.behavior(spark, sf)
    return cleaning.keep_valid_users(log, cleaning.user_balance(log).where("valid"))


def _clean_sql(timeout: int, threshold: int, per_behavior: bool = False) -> str:
    more = ", behavior_type" if per_behavior else ""
    keys = "user_id, item_id, timestamp" + more
    kept = dedup_sql("(SELECT * FROM noisy WHERE timestamp > 0)", keys, "behavior_type, category_id")
    body = f""", kept AS ({kept}),
good AS (SELECT user_id FROM kept GROUP BY user_id
  HAVING count(*) FILTER (behavior_type = 'pv') <= {threshold}
     AND count(*) FILTER (behavior_type = 'buy') <= count(*) FILTER (behavior_type = 'pv')),
used AS (SELECT * FROM kept WHERE user_id IN (SELECT user_id FROM good))
{sessions_sql("used", "user_id" + more, timeout)}"""
    return with_(NOISY, "").rstrip() + body


@register("clean_behavior", _clean_sql(LONG_TIMEOUT, THRESHOLD))
def clean_behavior_query(spark, sf):
    return clean_behavior(
        A.noisy_log(spark, sf), THRESHOLD, LONG_TIMEOUT, behaviors=S.BEHAVIORS
    )


@register("clean_behavior_any_type", _clean_sql(LONG_TIMEOUT, THRESHOLD))
def clean_behavior_any_type(spark, sf):
    return clean_behavior(A.noisy_log(spark, sf), THRESHOLD, LONG_TIMEOUT)


@register("clean_behavior_per_type", _clean_sql(1800, 4 * THRESHOLD, per_behavior=True))
def clean_behavior_per_type(spark, sf):
    return clean_behavior(
        A.noisy_log(spark, sf), 4 * THRESHOLD, 1800, per_behavior=True, behaviors=S.BEHAVIORS
    )


# -- profiles --------------------------------------------------------------------------


@register(
    "event_counts",
    with_(BEHAVIOR, "SELECT behavior_type, count(*) AS cnt FROM behavior GROUP BY behavior_type"),
)
def event_counts(spark, sf):
    return profile.value_counts(A.behavior(spark, sf), "behavior_type", "cnt")


@register(
    "top_items",
    with_(
        BEHAVIOR,
        """SELECT item_id, count(*) AS cnt FROM behavior GROUP BY item_id
           ORDER BY cnt DESC, item_id LIMIT 10""",
    ),
)
def top_items(spark, sf):
    return profile.top_k(A.behavior(spark, sf), "item_id", 10, "cnt")


@register(
    "null_profile",
    with_(
        NOISY,
        """SELECT count(*) AS total_rows, count(*) FILTER (user_id IS NULL) AS user_id_null,
                  count(*) FILTER (behavior_type IS NULL OR behavior_type = '') AS behavior_type_null
           FROM noisy""",
    ),
)
def null_profile(spark, sf):
    return profile.profile_nulls(A.noisy_log(spark, sf))


@register(
    "time_profile",
    with_(
        NOISY,
        """SELECT min(timestamp) AS min_ts, max(timestamp) AS max_ts,
                  strftime(make_timestamp(min(timestamp) FILTER (timestamp > 0) * 1000000), '%Y-%m-%d %H:%M:%S') AS min_date,
                  strftime(make_timestamp(max(timestamp) FILTER (timestamp > 0) * 1000000), '%Y-%m-%d %H:%M:%S') AS max_date,
                  count(*) FILTER (timestamp <= 0) AS invalid_count FROM noisy""",
    ),
)
def time_profile(spark, sf):
    found = profile.profile_time(A.noisy_log(spark, sf))
    as_text = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("min_date", "max_date")}
    return found.withColumns(as_text)


@register("unique_visitors", with_(BEHAVIOR, "SELECT count(DISTINCT user_id) AS uv_count FROM behavior"))
def unique_visitors(spark, sf):
    return profile.unique_visitors(A.behavior(spark, sf))


@register(
    "visitor_sketches",
    with_(
        BEHAVIOR,
        """, d AS (SELECT *, timestamp // 86400 AS day FROM behavior),
             r AS (SELECT max(day) AS last FROM d)
           SELECT behavior_type, count(*) AS rows, count(DISTINCT user_id) AS exact, true AS within
           FROM d, r WHERE day BETWEEN last - 20 AND last - 3 GROUP BY behavior_type""",
    ),
)
def visitor_sketches(spark, sf):
    """Unique visitors of a range of days from the sketches, beside the exact count of the log.

    The days are written in two parts, the second of which replaces days of the first."""
    log = A.behavior(spark, sf).withColumn("_day", sketches.day_of())
    last = log.agg(F.max("_day")).first()[0]
    root = scratch(spark, "sketches")
    days = log.where(F.col("_day") <= F.date_sub(F.lit(last), 10)).drop("_day")
    sketches.update_days(days, root)
    sketches.update_days(log.where(F.col("_day") >= F.date_sub(F.lit(last), 12)).drop("_day"), root)
    first_day, last_day = (str(last - timedelta(days=d)) for d in (20, 3))
    found = sketches.visitors_between(spark, root, first_day, last_day)
    exact = (
        log.where(F.col("_day").between(F.lit(first_day), F.lit(last_day)))
        .groupBy("behavior_type")
        .agg(F.count_distinct("user_id").alias("exact"))
    )
    off = F.abs(F.col("uv_count") - F.col("exact")) <= sketches.error_bound() * F.col("exact")
    return found.join(exact, "behavior_type").select("behavior_type", "rows", "exact", off.alias("within"))


@register(
    "hourly_activity",
    with_(
        NOISY,
        """SELECT CAST(timestamp % 86400 // 3600 AS INTEGER) AS hour, behavior_type, count(*) AS cnt
           FROM noisy WHERE behavior_type IN ('pv', 'buy') AND timestamp > 0 GROUP BY 1, 2""",
    ),
)
def hourly_activity(spark, sf):
    return profile.hourly_activity(A.noisy_log(spark, sf))


@register(
    "purchase_peak",
    with_(
        BEHAVIOR,
        """SELECT CAST(timestamp % 86400 // 3600 AS INTEGER) AS hour, count(*) AS cnt FROM behavior
           WHERE behavior_type = 'buy' GROUP BY 1 ORDER BY cnt DESC, hour LIMIT 1""",
    ),
)
def purchase_peak(spark, sf):
    return profile.purchase_peak(A.behavior(spark, sf))


_FUNNEL = """, u AS (SELECT user_id, bool_or(behavior_type = 'pv') AS v,
    bool_or(behavior_type IN ('fav', 'cart')) AS w, bool_or(behavior_type = 'buy') AS b
  FROM {src} GROUP BY user_id),
c AS (SELECT count(*) FILTER (v) AS pv_users, count(*) FILTER (v AND w) AS fav_cart_users,
             count(*) FILTER (v AND w AND b) AS buy_users FROM u)
SELECT *, CASE WHEN pv_users > 0 THEN fav_cart_users::DOUBLE / pv_users ELSE 0 END AS fav_cart_rate,
       CASE WHEN fav_cart_users > 0 THEN buy_users::DOUBLE / fav_cart_users ELSE 0 END AS buy_rate
FROM c"""


@register("funnel", "WITH " + BEHAVIOR + _FUNNEL.format(src="behavior"))
def funnel(spark, sf):
    return profile.funnel(A.behavior(spark, sf))


@register(
    "user_behaviors",
    with_(
        BEHAVIOR,
        """SELECT user_id, array_to_string(list_sort(list(DISTINCT behavior_type)), ',') AS behaviors
           FROM behavior GROUP BY user_id""",
    ),
)
def user_behaviors(spark, sf):
    sets = profile.user_behaviors(A.behavior(spark, sf))
    return sets.withColumn("behaviors", F.array_join("behaviors", ","))


@register(
    "behavior_share",
    with_(
        BEHAVIOR,
        """SELECT behavior_type, count(*) AS cnt,
                  count(*) * CAST(100.0 AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS pct
           FROM behavior GROUP BY behavior_type""",
    ),
)
def behavior_share(spark, sf):
    return profile.behavior_share(A.behavior(spark, sf))


@register(
    "hot_items",
    with_(
        BEHAVIOR,
        """, i AS (SELECT item_id, count(*) AS n FROM behavior GROUP BY item_id),
r AS (SELECT n, row_number() OVER (ORDER BY n DESC, item_id) AS rn, count(*) OVER () AS items FROM i)
SELECT max(items) AS items, max(CAST(greatest(1, floor(items * 0.2)) AS BIGINT)) AS hot_items,
       CAST(sum(n) FILTER (rn <= greatest(1, floor(items * 0.2))) AS BIGINT) AS hot_rows,
       CAST(sum(n) AS BIGINT) AS total_rows,
       CAST(sum(n) FILTER (rn <= greatest(1, floor(items * 0.2))) AS DOUBLE)
         / CAST(sum(n) AS DOUBLE) AS hot_share FROM r""",
    ),
)
def hot_items(spark, sf):
    return profile.hot_item_share(A.behavior(spark, sf))


@register(
    "disallowed_behaviors",
    with_(
        WEBLOG,
        """SELECT DISTINCT lower(trim(event_type)) AS behavior_type FROM weblog
           WHERE lower(trim(event_type)) NOT IN ('view', 'click', 'purchase')""",
    ),
)
def disallowed_behaviors(spark, sf):
    log = A.raw_weblog(spark, sf).select(S.standardize("event_type").alias("behavior_type"))
    return profile.disallowed_behaviors(log, ("view", "click", "purchase"))


# -- sessions and series -----------------------------------------------------------------


@register(
    "sessionize",
    with_(
        BEHAVIOR,
        sessions_sql(
            "(SELECT user_id, item_id, category_id, behavior_type, timestamp FROM behavior)",
            "user_id",
            1800,
        ),
    ),
)
def sessionize(spark, sf):
    return sessions.sessionize(A.behavior(spark, sf))


@register(
    "sessionize_long",
    with_(
        BEHAVIOR,
        sessions_sql("(SELECT user_id, item_id, timestamp FROM behavior)", "user_id", LONG_TIMEOUT),
    ),
)
def sessionize_long(spark, sf):
    log = A.behavior(spark, sf).select("user_id", "item_id", "timestamp")
    return sessions.sessionize(log, LONG_TIMEOUT)


@register(
    "sessionize_global",
    with_(
        BEHAVIOR,
        f"""SELECT user_id, item_id, timestamp,
                   CAST(sum(brk) OVER (ORDER BY user_id, timestamp, tie ROWS UNBOUNDED PRECEDING) AS BIGINT)
                     AS session_id
            FROM (SELECT *, CASE WHEN timestamp - lag(timestamp) OVER w > {LONG_TIMEOUT}
                    OR lag(timestamp) OVER w IS NULL THEN 1 ELSE 0 END AS brk, row_number() OVER w AS tie
                  FROM behavior WINDOW w AS (PARTITION BY user_id ORDER BY timestamp))""",
    ),
)
def sessionize_global(spark, sf):
    log = A.behavior(spark, sf).select("user_id", "item_id", "timestamp")
    return sessions.sessionize_global(log, LONG_TIMEOUT)


@register(
    "recent_view",
    with_(
        BEHAVIOR,
        """SELECT event_id, user_id, behavior_type,
                  coalesce(max(CASE WHEN behavior_type = 'pv' THEN 1 ELSE 0 END) OVER (
                    PARTITION BY user_id ORDER BY timestamp, event_id
                    ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 0) = 1 AS recent_view FROM behavior""",
    ),
)
def recent_view(spark, sf):
    log = A.behavior(spark, sf, "event_id").select(
        "event_id", "user_id", "behavior_type", "timestamp"
    )
    return series.recent_view_flag(log, ["timestamp", "event_id"]).drop("timestamp")


@register(
    "hysteresis",
    """SELECT event_id, event_type, load_pct,
              coalesce(last_value(s IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id
                ROWS UNBOUNDED PRECEDING), 0) = 1 AS backpressure_active
       FROM (SELECT *, CASE WHEN load_pct >= 0.85 THEN 1 WHEN load_pct <= 0.30 THEN 0 END AS s
             FROM (SELECT event_id, event_type, ts, round(value / 50, 4) AS load_pct FROM events))""",
)
def hysteresis(spark, sf):
    samples = A.load_samples(spark, sf)
    return series.hysteresis(samples, ["event_type"], ["ts", "event_id"]).drop("ts")


_BACKLOG = """, s AS (SELECT *, sum(arrivals - capacity) OVER (PARTITION BY event_type ORDER BY hour_no
    ROWS UNBOUNDED PRECEDING) AS walk FROM arrivals),
b AS (SELECT event_type, hour_no, arrivals, capacity, CAST(walk - least(0, min(walk) OVER (
    PARTITION BY event_type ORDER BY hour_no ROWS UNBOUNDED PRECEDING)) AS BIGINT) AS queue_depth FROM s)"""


@register("backlog", "WITH " + ARRIVALS + _BACKLOG + " SELECT * FROM b")
def backlog(spark, sf):
    return series.backlog(A.hourly_arrivals(spark, sf), ["event_type"], ["hour_no"])


@register(
    "load_pct",
    "WITH " + ARRIVALS + """ SELECT event_type, hour_no, round(arrivals / 8.0, 4) AS bounded,
        CAST(-1 AS DOUBLE) AS unbounded FROM arrivals""".replace("8.0", "CAST(8 AS DOUBLE)"),
)
def load_pct(spark, sf):
    loads = A.hourly_arrivals(spark, sf)
    return loads.select(
        "event_type",
        "hour_no",
        S.load_pct("arrivals", F.lit(8)).alias("bounded"),
        S.load_pct("arrivals", F.lit(0), unbounded=-1.0).alias("unbounded"),
    )


@register(
    "slope",
    "WITH " + ARRIVALS + _BACKLOG + """,
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY hour_no) AS rn,
             count(*) OVER (PARTITION BY event_type) AS n FROM b)
SELECT event_type, max(n) AS samples, round(regr_slope(
         CASE WHEN n >= 3 AND rn > greatest(1, floor(n * 0.4)) THEN queue_depth END, hour_no), 6)
         AS measured_slope FROM r GROUP BY event_type""",
)
def slope(spark, sf):
    depth = series.backlog(A.hourly_arrivals(spark, sf), ["event_type"], ["hour_no"])
    found = series.regression_slope(depth, ["event_type"], "hour_no", "queue_depth")
    return found.withColumn("measured_slope", F.round("measured_slope", 6))


@register(
    "histogram",
    """WITH e AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1),
       b AS (SELECT event_type, lo, hi,
                    CAST(least(29, floor((value - lo) / (hi - lo) * 30)) AS BIGINT) AS bin
             FROM events JOIN e USING (event_type))
       SELECT event_type, bin, round(max(lo + (hi - lo) * bin / 30), 6) AS bin_start, count(*) AS cnt
       FROM b GROUP BY event_type, bin""",
)
def histogram(spark, sf):
    bins = series.histogram(A.table(spark, sf, "events"), ["event_type"], "value")
    return bins.withColumn("bin_start", F.round("bin_start", 6))


@register(
    "metrics_summary",
    """WITH s AS (SELECT event_type, event_id, ts, round(value / 50, 4) AS load_pct FROM events),
       g AS (SELECT *, CASE WHEN load_pct >= 0.85 THEN 1 WHEN load_pct <= 0.30 THEN 0 END AS s FROM s),
       h AS (SELECT event_id, load_pct, coalesce(last_value(s IGNORE NULLS) OVER (
               PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 0) = 1 AS a FROM g)
       SELECT CAST(max(floor(load_pct * 500)) AS BIGINT) AS max_queue_depth,
              max(load_pct) AS max_load_pct, count(*) FILTER (a) AS active_samples FROM h""",
)
def metrics_summary(spark, sf):
    samples = series.hysteresis(A.load_samples(spark, sf), ["event_type"], ["ts", "event_id"])
    depth = F.floor(F.col("load_pct") * 500).cast("bigint")
    return series.metrics_summary(samples.withColumn("queue_depth", depth))


# -- sorting, pages, samples, sets -------------------------------------------------------


@register(
    "order_by_limit",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""",
)
def order_by_limit(spark, sf):
    orders = A.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@register(
    "slice_rows",
    """SELECT event_id, user_id, event_type, position FROM (
         SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS position FROM events)
       WHERE position >= 500 AND position < 700""",
)
def slice_rows(spark, sf):
    e = A.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return sampling.slice_rows(e, "event_id", 500, 700)


@register(
    "sample_n",
    """SELECT event_id, user_id FROM events
       ORDER BY md5(CAST(event_id AS VARCHAR) || '42'), event_id LIMIT 300""",
)
def sample_n(spark, sf):
    return sampling.sample_n(A.table(spark, sf, "events").select("event_id", "user_id"), "event_id", 300)


@register(
    "balanced_sample",
    """SELECT doc_id, quality, rank FROM (SELECT *, row_number() OVER (PARTITION BY quality
         ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id) AS rank FROM labels)
       WHERE rank <= 40""",
)
def balanced_sample(spark, sf):
    labels = A.table(spark, sf, "labels").select("doc_id", "quality")
    return sampling.balanced_sample(labels, "quality", "doc_id", 40)


@register(
    "stratified_split",
    """SELECT event_id, event_type, rank <= round(n * 0.2) AS is_test FROM (
         SELECT *, row_number() OVER (PARTITION BY event_type
             ORDER BY md5(CAST(event_id AS VARCHAR) || '42'), event_id) AS rank,
           count(*) OVER (PARTITION BY event_type) AS n FROM events)""",
)
def stratified_split(spark, sf):
    e = A.table(spark, sf, "events").select("event_id", "event_type")
    return sampling.stratified_split(e, "event_type", "event_id")


@register(
    "stratified_folds",
    """SELECT event_id, event_type, CAST((row_number() OVER (PARTITION BY event_type
             ORDER BY md5(CAST(event_id AS VARCHAR) || '42'), event_id) - 1) % 5 AS INTEGER) AS fold
       FROM events""",
)
def stratified_folds(spark, sf):
    e = A.table(spark, sf, "events").select("event_id", "event_type")
    return sampling.stratified_folds(e, "event_type", "event_id")


@register(
    "running_position",
    """SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id)
         AS position FROM events""",
)
def running_position(spark, sf):
    e = A.table(spark, sf, "events").select("event_id", "event_type", "value")
    return ordered.running_position(e, ["event_type"], ["value", "event_id"]).drop("value")


@register(
    "union_all",
    with_(BEHAVIOR, "SELECT behavior_type, count(*) AS cnt FROM behavior GROUP BY behavior_type"),
)
def union_all(spark, sf):
    log = A.behavior(spark, sf)
    parts = [log.where(F.col("behavior_type") == b) for b in S.BEHAVIORS]
    return profile.value_counts(readers.union_all(parts), "behavior_type", "cnt")


# -- sources and sinks -------------------------------------------------------------------

_BY_TYPE = with_(
    BEHAVIOR,
    "SELECT user_id, item_id, category_id, timestamp, behavior_type FROM behavior",
)


@register("partition_round_trip", _BY_TYPE)
def partition_round_trip(spark, sf):
    return writers.round_trip(A.behavior(spark, sf), "by-behavior", "behavior_type")


@register(
    "compact",
    """SELECT l_returnflag, count(*) AS cnt, sum(l_linenumber)::BIGINT AS lines
       FROM lineitem GROUP BY l_returnflag""",
)
def compact(spark, sf):
    root, out = scratch(spark, "by-flag"), scratch(spark, "compacted")
    items = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    writers.write_partitioned(items, root, "l_returnflag", codec="zstd", level=3)
    writers.compact(spark, root, out)
    return (
        spark.read.parquet(out)
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("cnt"), F.sum("l_linenumber").alias("lines"))
    )


@register(
    "replace_partitions",
    with_(
        BEHAVIOR,
        """SELECT user_id, item_id, category_id, timestamp, behavior_type FROM behavior
           WHERE user_id IN (SELECT user_id FROM behavior GROUP BY user_id
             HAVING count(*) FILTER (behavior_type = 'buy') <= count(*) FILTER (behavior_type = 'pv'))""",
    ),
)
def replace_partitions(spark, sf):
    path = scratch(spark, "replaced")
    writers.write_partitioned(A.behavior(spark, sf), path, "behavior_type")
    stored = spark.read.parquet(path)
    good = cleaning.user_balance(stored).where("valid")
    writers.replace_partitions(cleaning.keep_valid_users(stored, good), path, ["behavior_type"])
    return spark.read.parquet(path)


@register(
    "overwrite_partitions",
    with_(
        BEHAVIOR,
        """SELECT user_id, CASE WHEN behavior_type = 'buy' THEN -item_id ELSE item_id END AS item_id,
                  category_id, timestamp, behavior_type, 2 AS versions, behavior_type <> 'buy' AS kept_files
           FROM behavior""",
    ),
)
def overwrite_partitions(spark, sf):
    """The purchases are written anew from the table itself; files of other partitions stay."""
    path = scratch(spark, "versioned")
    versioned.overwrite_partitions(A.behavior(spark, sf), path, "behavior_type")
    before = versioned.read_versioned(spark, path)
    bought = before.where("behavior_type = 'buy'").withColumn("item_id", -F.col("item_id"))
    versioned.overwrite_partitions(bought, path, "behavior_type")
    old_files = before.select(F.input_file_name().alias("file")).distinct()
    found = versioned.read_versioned(spark, path).withColumn("file", F.input_file_name())
    kept = found.join(old_files.withColumn("kept_files", F.lit(True)), "file", "left").drop("file")
    return kept.withColumns(
        {
            "kept_files": F.coalesce("kept_files", F.lit(False)),
            "versions": F.lit(len(versioned.versions(spark, path))),
        }
    )


@register(
    "compact_files",
    with_(
        BEHAVIOR,
        """SELECT user_id, item_id, category_id, timestamp, behavior_type, true AS fewer_files FROM behavior""",
    ),
)
def compact_files(spark, sf):
    """A log in many small files, merged by their sizes."""
    path = scratch(spark, "small-files")
    log = A.behavior(spark, sf).repartition(8)
    versioned.overwrite_partitions(log, path, "behavior_type", rebalance=False)
    before = sum(map(len, versioned.file_sizes(spark, path).values()))
    versioned.compact_files(spark, path, 128 << 20)
    after = sum(map(len, versioned.file_sizes(spark, path).values()))
    return versioned.read_versioned(spark, path).withColumn("fewer_files", F.lit(after < before))


@register(
    "behavior_csv",
    with_(
        BEHAVIOR,
        """SELECT user_id, item_id, category_id, behavior_type, timestamp FROM behavior""",
    ),
)
def behavior_csv(spark, sf):
    path = scratch(spark, "behavior-csv")
    A.behavior(spark, sf).write.csv(path)
    return readers.read_behavior_csv(spark, path)


@register("weblog_csv", with_(WEBLOG, "SELECT * FROM weblog"))
def weblog_csv(spark, sf):
    path = scratch(spark, "weblog-csv")
    writers.write_csv(A.raw_weblog(spark, sf), path)
    read = readers.read_csv_inferred(spark, path)
    return read.withColumn("event_id", F.col("event_id").cast("bigint"))


@register(
    "sniff_csv",
    with_(
        BEHAVIOR,
        """SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id,
                  CAST(category_id AS VARCHAR) AS category_id, behavior_type,
                  CAST(timestamp AS VARCHAR) AS timestamp FROM behavior""",
    ),
)
def sniff_csv(spark, sf):
    path = scratch(spark, "sniffed")
    writers.write_csv(A.behavior(spark, sf), path)
    return readers.sniff_csv(spark, path)


@register(
    "json_lines",
    with_(BEHAVIOR, "SELECT behavior_type, count(*) AS cnt FROM behavior GROUP BY behavior_type"),
)
def json_lines(spark, sf):
    path = scratch(spark, "json-lines")
    log = A.behavior(spark, sf)
    writers.write_json_lines(log, path)
    return profile.value_counts(spark.read.schema(log.schema).json(path), "behavior_type", "cnt")


@register(
    "glob_counts",
    with_(BEHAVIOR, "SELECT count(*) AS cnt, sum(item_id)::BIGINT AS items FROM behavior"),
)
def glob_counts(spark, sf):
    root = scratch(spark, "glob")
    writers.write_partitioned(A.behavior(spark, sf), root, "behavior_type")
    every = readers.read_glob(spark, root)
    return every.agg(F.count(F.lit(1)).alias("cnt"), F.sum("item_id").alias("items"))


@register(
    "storage_report",
    """SELECT l_returnflag, true AS has_files, true AS has_size, true AS adds_up, l_returnflag = 'TOTAL' AS has_saving
       FROM (SELECT DISTINCT l_returnflag FROM lineitem UNION ALL SELECT 'TOTAL')""",
)
def storage_report(spark, sf):
    """Every value's files and size are there, and the total is their sum."""
    root = scratch(spark, "stored")
    writers.write_partitioned(A.table(spark, sf, "lineitem"), root, "l_returnflag")
    report = writers.storage_report(spark, root, "l_returnflag", original_mb=1024.0)
    single = report.where("l_returnflag <> 'TOTAL'").agg(F.sum("files"), F.sum("mb")).first()
    sums = (F.col("files") == single[0]) & (F.abs(F.col("mb") - single[1]) < 1e-9)
    return report.select(
        "l_returnflag",
        (F.col("files") > 0).alias("has_files"),
        (F.col("mb") > 0).alias("has_size"),
        (sums | (F.col("l_returnflag") != "TOTAL")).alias("adds_up"),
        F.col("saving_pct").isNotNull().alias("has_saving"),
    )


# -- data quality ------------------------------------------------------------------------


@register(
    "quality_report",
    with_(
        NOISY,
        """, a AS (SELECT count(*) AS n, count(*) FILTER (behavior_type NOT IN ('pv','cart','fav','buy')
        OR behavior_type IS NULL) AS outside, count(*) FILTER (user_id IS NULL AND item_id IS NULL AND
        behavior_type IS NULL AND timestamp IS NULL) AS empty, count(*) FILTER (timestamp < 0) AS neg,
        count(*) FILTER (user_id IS NULL) AS n1, count(*) FILTER (item_id IS NULL) AS n2,
        count(*) FILTER (behavior_type IS NULL) AS n3, count(*) FILTER (timestamp IS NULL) AS n4 FROM noisy),
v AS (SELECT count(*) AS bad FROM (SELECT user_id FROM noisy GROUP BY user_id HAVING
        count(*) FILTER (behavior_type = 'buy') > count(*) FILTER (behavior_type = 'pv'))),
d AS (SELECT CAST(sum(n - 1) AS BIGINT) AS dups FROM (SELECT count(*) AS n FROM noisy
        GROUP BY user_id, item_id, behavior_type, timestamp))
SELECT 'rows_present' AS "check", n > 0 AS passed, CAST(n AS VARCHAR) AS detail FROM a
UNION ALL SELECT 'rows_enough', n >= 1000, CAST(n AS VARCHAR) FROM a
UNION ALL SELECT 'columns_present', true, '' FROM a
UNION ALL SELECT 'behavior_domain', outside = 0, CAST(outside AS VARCHAR) FROM a
UNION ALL SELECT 'no_empty_row', empty = 0, CAST(empty AS VARCHAR) FROM a
UNION ALL SELECT 'no_negative_time', neg = 0, CAST(neg AS VARCHAR) FROM a
UNION ALL SELECT 'null_ratio_user_id', n1 <= n * 0.01, CAST(n1 AS VARCHAR) FROM a
UNION ALL SELECT 'null_ratio_item_id', n2 <= n * 0.01, CAST(n2 AS VARCHAR) FROM a
UNION ALL SELECT 'null_ratio_behavior_type', n3 <= n * 0.01, CAST(n3 AS VARCHAR) FROM a
UNION ALL SELECT 'null_ratio_timestamp', n4 <= n * 0.01, CAST(n4 AS VARCHAR) FROM a
UNION ALL SELECT 'buy_within_pv', bad = 0, CAST(bad AS VARCHAR) FROM v
UNION ALL SELECT 'no_duplicates', dups = 0, CAST(dups AS VARCHAR) FROM d""",
    ),
)
def quality_report(spark, sf):
    return quality.quality_report(A.noisy_log(spark, sf), min_rows=1000)


@register(
    "cleaned_log_report",
    with_(
        WEBLOG,
        """, c AS (SELECT lower(trim(event_type)) AS t, sha256(coalesce(user_id, '')) AS m, event_id
  FROM weblog WHERE event_id > 0)
SELECT 'types_lower_case' AS "check", count(*) FILTER (t IS NULL OR t <> lower(t)) = 0 AS passed,
       CAST(count(*) FILTER (t IS NULL OR t <> lower(t)) AS VARCHAR) AS detail FROM c
UNION ALL SELECT 'hash_length', count(*) FILTER (m IS NULL OR length(m) <> 64) = 0,
       CAST(count(*) FILTER (m IS NULL OR length(m) <> 64) AS VARCHAR) FROM c
UNION ALL SELECT 'event_id_present', count(*) FILTER (event_id IS NULL) = 0,
       CAST(count(*) FILTER (event_id IS NULL) AS VARCHAR) FROM c""",
    ),
)
def cleaned_log_report(spark, sf):
    return quality.cleaned_log_report(cleaning.adaptive_clean(A.raw_weblog(spark, sf)))


@register(
    "quality_summary",
    with_(
        NOISY,
        """SELECT 8 + CAST(bad = 0 AS BIGINT) + CAST(dups = 0 AS BIGINT) + CAST(neg = 0 AS BIGINT)
                  AS passed, CAST(12 AS BIGINT) AS checks
           FROM (SELECT count(*) AS bad FROM (SELECT user_id FROM noisy GROUP BY user_id HAVING
                   count(*) FILTER (behavior_type = 'buy') > count(*) FILTER (behavior_type = 'pv'))),
                (SELECT sum(n - 1) AS dups FROM (SELECT count(*) AS n FROM noisy
                   GROUP BY user_id, item_id, behavior_type, timestamp)),
                (SELECT count(*) FILTER (timestamp < 0) AS neg FROM noisy)""",
    ),
)
def quality_summary(spark, sf):
    return quality.summary(quality.quality_report(A.noisy_log(spark, sf), min_rows=10**12))
