"""Queries that run as streams over JSON lines of the events table."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import functions as F

from clicktide.catalog import register
from clicktide.catalog.shared_sql import EVENTS, with_
from clicktide.functions import scalars as S
from clicktide.plans.scoring import start_scoring
from clicktide.session import scratch
from clicktide.sources import adapters as A
from clicktide.sources import faulty, paced, readers
from clicktide.streaming import drift, event_sessions, events, fitting, metrics, run, sessions, windows
from clicktide.streaming.load import LoadBoard
from clicktide.streaming.load_state import stream_hysteresis

RATE = 0.1
# Event types as stream behaviours; errors come without one.
STREAM_BEHAVIORS = {"view": "view", "signup": "cart", "purchase": "purchase", "click": "fav"}


def stream_events(spark, sf):
    e = A.events(spark, sf)
    return e.select(
        "event_id",
        F.date_format("ts", windows.TIME_FORMAT).alias("event_time"),
        "user_id",
        "item_id",
        S.lookup(F.col("event_type"), STREAM_BEHAVIORS).alias("behavior_type"),
        F.substring(F.md5(F.col("user_id").cast("string")), 1, 12).alias("session_id"),
    )


def line_stream(spark, lines):
    """Write lines into a folder of the shared directory and read that as a stream."""
    path = scratch(spark, "lines")
    lines.write.text(path)
    return readers.read_event_stream(spark, path)


def clean_lines(spark, sf):
    return line_stream(spark, faulty.inject_faults(stream_events(spark, sf), "event_id", 0.0).select("value"))


def odd_times(spark, sf):
    """Lines whose time has three or six digits of fraction, or stands in ``timestamp``."""
    e = stream_events(spark, sf)
    kind = F.col("event_id") % 3
    millis = F.col("event_time")
    timed = e.withColumns(
        {
            "timestamp": F.when(kind == 1, F.unix_seconds(F.try_to_timestamp(millis, F.lit(windows.TIME_FORMAT)))),
            "event_time": F.when(kind == 0, F.concat(millis, F.lit("000"))).when(kind == 2, millis),
        }
    )
    return timed.select(F.to_json(F.struct(*[c for c in timed.columns if c != "event_id"])).alias("value"))


def faulty_lines(spark, sf):
    return line_stream(spark, faulty.inject_faults(stream_events(spark, sf), "event_id", RATE).select("value"))


def routed(spark, sf):
    path, _ = run.run_available(
        events.score_and_route(faulty_lines(spark, sf)), "routed", by=["route"]
    )
    return run.read_batches(spark, path)


_FAULTY = (
    EVENTS
    + f""", h AS (SELECT *, md5(CAST(event_id AS VARCHAR) || '42') AS d,
    CASE event_type WHEN 'view' THEN 'view' WHEN 'signup' THEN 'cart' WHEN 'purchase' THEN 'purchase'
                    WHEN 'click' THEN 'fav' END AS behavior_type,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS event_time FROM ev),
k AS (SELECT *, CASE WHEN CAST('0x' || substr(d, 1, 4) AS INTEGER) < {int(RATE * 65536)}
        THEN CAST('0x' || substr(d, 5, 1) AS INTEGER) % 4 END AS kind,
      CAST('0x' || substr(d, 6, 1) AS INTEGER) % 3 AS fld FROM h),
r AS (SELECT *, CASE WHEN kind = 0 AND fld = 0 THEN 'missing user_id'
        WHEN kind = 0 AND fld = 1 THEN 'missing item_id'
        WHEN kind = 0 THEN 'missing event_time' WHEN kind = 1 THEN 'bad item_id'
        WHEN kind = 2 THEN 'bad event_time' WHEN kind = 3 THEN 'event must be an object' END AS error,
      CASE behavior_type WHEN 'purchase' THEN 0.95::DOUBLE WHEN 'cart' THEN 0.35::DOUBLE
        WHEN 'fav' THEN 0.25::DOUBLE WHEN 'view' THEN 0.08::DOUBLE ELSE 0.12::DOUBLE END AS p FROM k)"""
)


@register(
    "parse_events",
    with_(
        _FAULTY,
        """SELECT event_id, error, CASE WHEN error IS NULL THEN user_id END AS user_id,
                  CASE WHEN error IS NULL THEN item_id END AS item_id,
                  CASE WHEN error IS NULL THEN item_id % 500 + 1 END AS category_id,
                  CASE WHEN error IS NULL THEN CAST(timestamp % 86400 // 3600 AS INTEGER) END AS hour,
                  CASE WHEN error IS NULL THEN CAST(isodow(ts) - 1 AS INTEGER) END AS dayofweek,
                  CASE WHEN error IS NULL THEN CAST(isodow(ts) >= 6 AS INTEGER)::DOUBLE END AS is_weekend
           FROM r""",
    ),
)
def parse_events(spark, sf):
    lines = faulty.inject_faults(stream_events(spark, sf), "event_id", RATE).drop("fault")
    parsed = events.parse_events(lines)
    good = F.col("error").isNull()
    kept = ("user_id", "item_id", "category_id", "hour", "dayofweek", "is_weekend")
    return parsed.select("event_id", "error", *[F.when(good, F.col(c)).alias(c) for c in kept])


@register(
    "route_dead_letters",
    with_(
        _FAULTY,
        """SELECT CASE WHEN error IS NULL THEN 'scored' ELSE 'dead' END AS route,
                  coalesce(error, 'RULE_FALLBACK') AS error, count(*) AS cnt FROM r GROUP BY 1, 2""",
    ),
)
def route_dead_letters(spark, sf):
    return routed(spark, sf).groupBy("route", "error").agg(F.count(F.lit(1)).alias("cnt"))


@register(
    "rule_score",
    with_(
        _FAULTY,
        """SELECT event_time, user_id, item_id, CAST(p >= 0.5 AS INTEGER) AS predicted_label,
                  p AS buy_probability, 'RULE_FALLBACK' AS error FROM r WHERE error IS NULL""",
    ),
)
def rule_score(spark, sf):
    scored = events.scored_events(routed(spark, sf))
    return scored.select(
        "event_time", "user_id", "item_id", "predicted_label", "buy_probability", "error"
    )


def make_hour_model():
    """Stands in for loading a model of another library."""

    def predict(rows):
        return (rows[:, 3] + rows[:, 4]) / 32.0

    return predict


@register(
    "external_score",
    with_(
        _FAULTY,
        """SELECT event_time, user_id, item_id, CAST(q >= 0.5 AS INTEGER) AS predicted_label,
                  q AS buy_probability FROM (
             SELECT *, (timestamp % 86400 // 3600 + isodow(ts) - 1) / 32::DOUBLE AS q FROM r)
           WHERE error IS NULL""",
    ),
)
def external_score(spark, sf):
    def scorer(parsed):
        return events.external_score(parsed, make_hour_model, batch_size=1000)

    path, _ = run.run_available(
        events.score_and_route(faulty_lines(spark, sf), scorer), "external", by=["route"]
    )
    scored = events.scored_events(run.read_batches(spark, path))
    return scored.select("event_time", "user_id", "item_id", "predicted_label", "buy_probability")


@register(
    "dead_letters",
    with_(
        _FAULTY,
        """SELECT error, count(*) AS cnt,
                  count(*) FILTER (kind = 3) AS broken_payloads FROM r WHERE error IS NOT NULL GROUP BY error""",
    ),
)
def dead_letters(spark, sf):
    letters = events.dead_letters(routed(spark, sf))
    return letters.groupBy("error").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.count_if(F.col("raw") == faulty.BAD_PAYLOAD).alias("broken_payloads"),
    )


@register(
    "scoring_summary",
    with_(
        _FAULTY,
        """SELECT count(*) FILTER (error IS NULL) AS scored, count(*) FILTER (error IS NOT NULL) AS failed,
                  count(*) FILTER (error IS NULL AND p >= 0.5) AS positive,
                  CAST(count(*) FILTER (error IS NULL AND p >= 0.5) AS DOUBLE)
                    / count(*) FILTER (error IS NULL) AS positive_ratio,
                  round(avg(p) FILTER (error IS NULL), 8) AS avg_buy_probability FROM r""",
    ),
)
def scoring_summary(spark, sf):
    found = events.scoring_summary(events.failed_as_score(routed(spark, sf)))
    return found.withColumn("avg_buy_probability", F.round("avg_buy_probability", 8))


@register(
    "pipeline_metrics",
    with_(
        _FAULTY,
        """SELECT count(*) AS produced, count(*) FILTER (error IS NULL) AS consumed,
                  count(*) FILTER (error IS NOT NULL) AS failed,
                  count(*) FILTER (error IS NOT NULL) AS dead_lettered,
                  count(*) FILTER (error IS NULL) AS fallback_predictions,
                  count(*) FILTER (kind IS NOT NULL) AS chaos_injected FROM r""",
    ),
)
def pipeline_metrics(spark, sf):
    lines = faulty.inject_faults(stream_events(spark, sf), "event_id", RATE)
    return metrics.pipeline_metrics(events.score_and_route(lines.drop("event_id")))


@register(
    "progress_metrics",
    with_(
        _FAULTY,
        """SELECT count(*) AS produced, count(*) FILTER (error IS NULL) AS consumed,
                  count(*) FILTER (error IS NOT NULL) AS dead_lettered,
                  count(*) FILTER (error IS NULL) AS fallback_predictions FROM r""",
    ),
)
def progress_metrics(spark, sf):
    path, query = run.run_available(
        events.score_and_route(faulty_lines(spark, sf)), "observed", by=["route"], counters=metrics.counters()
    )
    per_batch = metrics.progress_metrics(spark, query, path)
    counters = ("produced", "consumed", "dead_lettered", "fallback_predictions")
    return per_batch.agg(*[F.sum(c).alias(c) for c in counters])


_STREAM = (
    EVENTS
    + """, s AS (SELECT user_id, CASE event_type WHEN 'view' THEN 'view' WHEN 'signup' THEN 'cart'
      WHEN 'purchase' THEN 'purchase' WHEN 'click' THEN 'fav' ELSE 'unknown' END AS behavior_type,
    epoch_us(ts) // 1000 AS ms FROM ev)"""
)


@register(
    "window_counts",
    with_(
        _STREAM,
        """SELECT ms // 10000 * 10 AS window_start, count(*) FILTER (behavior_type = 'view') AS "view",
                  count(*) FILTER (behavior_type = 'cart') AS cart,
                  count(*) FILTER (behavior_type = 'purchase') AS purchase,
                  count(*) FILTER (behavior_type IN ('fav', 'unknown')) AS other,
                  count(*) FILTER (behavior_type NOT IN ('fav', 'unknown')) AS total,
                  count(*) FILTER (behavior_type = 'view') / 10::DOUBLE AS view_rate,
                  count(*) FILTER (behavior_type = 'purchase') / 10::DOUBLE AS purchase_rate
           FROM s GROUP BY 1""",
    ),
)
def window_counts(spark, sf):
    counts = windows.window_counts(windows.timed_events(line_stream(spark, odd_times(spark, sf))))
    path, _ = run.run_available(counts, "windows", output_mode="update")
    return run.latest(spark, path, ["window_start"])


@register(
    "untimed_events",
    with_(
        _FAULTY,
        """SELECT coalesce(kind = 2 OR kind = 0 AND fld = 2, false) = false AS timed, count(*) AS cnt
           FROM r WHERE kind IS DISTINCT FROM 3 GROUP BY 1""",
    ),
)
def untimed_events(spark, sf):
    counts = windows.untimed(windows.timed_events(faulty_lines(spark, sf)))
    path, _ = run.run_available(counts, "untimed", output_mode="complete")
    return run.last_batch(spark, path)


@register(
    "bounded_batches",
    with_(
        _FAULTY,
        """SELECT CASE WHEN error IS NULL THEN 'scored' ELSE 'dead' END AS route,
                  coalesce(error, 'RULE_FALLBACK') AS error, count(*) AS cnt,
                  true AS several_batches FROM r GROUP BY 1, 2""",
    ),
)
def bounded_batches(spark, sf):
    """Several files, one per batch while the load is high, on a timer; the rows of one batch."""
    lines = faulty.inject_faults(stream_events(spark, sf), "event_id", RATE).select("value")
    source = scratch(spark, "lines")
    lines.repartition(4).write.text(source)
    samples = spark.range(3).select(F.col("id").alias("at"), F.lit(0.9).alias("load_pct"))
    out = scratch(spark, "bounded")
    query = start_scoring(
        spark, source, out, scratch(spark, "bounded-state"), files_per_batch=3,
        processing_time="100 milliseconds", load_samples=samples,
    )
    query.processAllAvailable()
    query.stop()
    found = run.read_batches(spark, out)
    several = found.select("batch_id").distinct().count() > 1
    return found.groupBy("route", "error").agg(
        F.count(F.lit(1)).alias("cnt"), F.lit(several).alias("several_batches")
    )


@register(
    "paced_batches",
    with_(
        _FAULTY,
        """SELECT CASE WHEN error IS NULL THEN 'scored' ELSE 'dead' END AS route,
                  coalesce(error, 'RULE_FALLBACK') AS error, count(*) AS cnt, 4 AS batches FROM r GROUP BY 1, 2""",
    ),
)
def paced_batches(spark, sf):
    """Twelve files, six a batch: two at a time while the load is high, so 2, 2, 6 and 2 in one run."""
    lines = faulty.inject_faults(stream_events(spark, sf), "event_id", RATE).select("value")
    source, out, state, board = (scratch(spark, n) for n in ("lines", "paced", "paced-state", "board"))
    lines.repartition(12).write.text(source)
    load = LoadBoard(board)
    load.report(0, 0.9)
    batches = []

    def shape(batch):
        batches.append(batch)
        # The load is in between after the first batch, which changes nothing, and low after the second.
        load.report(len(batches), {1: 0.5, 2: 0.2}.get(len(batches), 0.5))
        return events.score_and_route(batch)

    stream = paced.read_paced_lines(spark, source, f"{state}-position", 6, board)
    query = run.start(stream, out, state, processing_time="100 milliseconds", by=["route"], shape=shape)
    query.processAllAvailable()
    query.stop()
    found = run.read_batches(spark, out)
    number = found.select("batch_id").distinct().count()
    return found.groupBy("route", "error").agg(
        F.count(F.lit(1)).alias("cnt"), F.lit(number).cast("int").alias("batches")
    )


@register(
    "stream_hysteresis",
    """SELECT event_id, event_type, load_pct,
              coalesce(last_value(s IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id
                ROWS UNBOUNDED PRECEDING), 0) = 1 AS backpressure_active
       FROM (SELECT *, CASE WHEN load_pct >= 0.85 THEN 1 WHEN load_pct <= 0.30 THEN 0 END AS s
             FROM (SELECT event_id, event_type, ts, round(value / 50, 4) AS load_pct FROM events))""",
)
def stream_hysteresis_query(spark, sf):
    """A last sample of another series, far ahead in time, lets all others leave."""
    samples = A.load_samples(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    samples = samples.withColumn("us", F.unix_micros("ts"))
    source, out, state = (scratch(spark, n) for n in ("samples", "active", "active-state"))
    samples.write.parquet(source)
    far = F.lit("2100-01-01").cast("timestamp")
    for last in (False, True):
        if last:
            end = samples.limit(1).withColumns({"ts": far, "event_type": F.lit("end")})
            end.write.mode("append").parquet(source)
        stream = spark.readStream.schema(samples.schema).parquet(source)
        plan = stream_hysteresis(stream, ["event_type"], "ts", order=("us", "event_id"))
        with run.rocksdb_state(spark):
            query = run.start(plan, out, state)
        query.awaitTermination()
    return run.read_batches(spark, out).drop("batch_id", "ms", "us")


@register(
    "running_totals",
    with_(
        _STREAM,
        """SELECT behavior_type, count(*) AS cnt, count(*) * CAST(100.0 AS DOUBLE)
             / CAST(sum(count(*)) OVER () AS DOUBLE) AS pct FROM s GROUP BY behavior_type""",
    ),
)
def running_totals(spark, sf):
    totals = windows.running_totals(windows.timed_events(clean_lines(spark, sf)))
    path, _ = run.run_available(totals, "totals", output_mode="complete")
    return windows.with_percent(run.last_batch(spark, path))


_SESSIONS = """, b AS (SELECT *, CASE WHEN ms - lag(ms) OVER w > {ms} OR lag(ms) OVER w IS NULL
      THEN 1 ELSE 0 END AS brk, row_number() OVER w AS rn FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ms)),
n AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS session_no FROM b)
"""


@register(
    "stream_sessions",
    with_(
        _STREAM,
        _SESSIONS.format(ms=21_600_000)
        + """SELECT user_id, min(ms) AS start_ms, max(ms) AS end_ms, count(*) AS events
             FROM n GROUP BY user_id, session_no""",
    ),
)
def stream_sessions(spark, sf):
    return flushed(spark, sf, "sessions", lambda e: sessions.stream_sessions(e, 21_600))


@register(
    "stream_session_history",
    with_(
        _STREAM,
        _SESSIONS.format(ms=21_600_000)
        + """, p AS (SELECT *, row_number() OVER (PARTITION BY user_id, session_no ORDER BY ms DESC, behavior_type DESC)
               AS back FROM n)
             SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(ms) AS start_ms, max(ms) AS end_ms,
                    count(*) AS events,
                    string_agg(CASE WHEN back <= 10 THEN ms || ':' || behavior_type END, ' '
                               ORDER BY ms, behavior_type) AS history
             FROM p GROUP BY user_id, session_no""",
    ),
)
def stream_session_history(spark, sf):
    found = sessions.numbered(flushed(spark, sf, "history", lambda e: sessions.session_history(e, 21_600)))
    text = F.transform("history", lambda h: F.concat(h["ms"].cast("string"), F.lit(":"), h["behavior"]))
    return found.withColumn("history", F.array_join(text, " "))


@register(
    "stream_event_sessions",
    with_(
        _STREAM.replace("SELECT user_id, CASE", "SELECT user_id, item_id, CASE"),
        _SESSIONS.format(ms=21_600_000).replace("ORDER BY ms", "ORDER BY ms, behavior_type, item_id")
        + """, t AS (SELECT *, min(ms) OVER (PARTITION BY user_id, session_no) AS start_ms FROM n)
             SELECT user_id, item_id, behavior_type, ms,
                    substr(sha256(user_id || ':' || start_ms), 1, 12) AS session_id,
                    lag(ms) OVER w AS last_active_ms,
                    string_agg(behavior_type, ' ') OVER (w ROWS 9 PRECEDING) AS history
             FROM t WINDOW w AS (PARTITION BY user_id, session_no ORDER BY rn)""",
    ),
)
def stream_event_sessions(spark, sf):
    def plan(e):
        return event_sessions.event_sessions(
            e, ["item_id"], ("ms", "behavior_type", "item_id"), 21_600
        )

    with run.rocksdb_state(spark):
        found = flushed(spark, sf, "event-sessions", plan, ["item_id"])
    return found.withColumn("history", F.array_join("history", " "))


def flushed(spark, sf, name, plan, ids=()):
    """Sessions in append mode. When all events are in, a line without a user, far ahead in time,
    moves the watermark past the open sessions; the query goes on from its checkpoint, and its batch with
    that line also takes what the events before have made due."""
    lines = scratch(spark, "lines")
    faulty.inject_faults(stream_events(spark, sf), "event_id", 0.0).select("value").write.text(lines)
    out, state = scratch(spark, name), scratch(spark, f"{name}-state")
    for extra in (None, '{"event_time": "2100-01-01 00:00:00.000"}'):
        if extra:
            spark.range(1).select(F.lit(extra).alias("value")).write.mode("append").text(lines)
        stream = plan(windows.timed_events(readers.read_event_stream(spark, lines), ids))
        with nullcontext() if extra else run.no_empty_batches(spark):
            run.start(stream, out, state).awaitTermination()
    return run.read_batches(spark, out).drop("batch_id")


@register(
    "online_zscore",
    with_(
        EVENTS,
        """, f AS (SELECT item_id, timestamp FROM ev ORDER BY event_id LIMIT 1000),
m AS (SELECT avg(item_id) AS m1, stddev_pop(item_id) AS s1, avg(timestamp) AS m2, stddev_pop(timestamp) AS s2 FROM f)
SELECT count(*) AS consumed, round(avg((item_id - m1) / s1), 6) AS z_mean_item_id,
       round(stddev_pop((item_id - m1) / s1), 6) AS z_std_item_id,
       round(avg((timestamp - m2) / s2), 6) AS z_mean_timestamp,
       round(stddev_pop((timestamp - m2) / s2), 6) AS z_std_timestamp FROM ev, m""",
    ),
)
def online_zscore(spark, sf):
    columns = ["item_id", "timestamp"]
    e = A.events(spark, sf).select("event_id", *columns)
    scaling = drift.fit_scaling(e, columns, ["event_id"])
    path = scratch(spark, "numbers")
    e.write.json(path)
    stream = spark.readStream.schema(e.schema).json(path)
    out, _ = run.run_available(drift.drift_report(stream, scaling), "drift", output_mode="complete")
    found = run.last_batch(spark, out)
    return found.withColumns({c: F.round(c, 6) for c in found.columns if c.startswith("z_")})


@register(
    "fitted_in_stream",
    with_(
        EVENTS,
        """, f AS (SELECT item_id, timestamp FROM ev ORDER BY event_id LIMIT 1000),
m AS (SELECT avg(item_id) AS m1, stddev_pop(item_id) AS s1, avg(timestamp) AS m2, stddev_pop(timestamp) AS s2 FROM f)
SELECT event_id, round((item_id - m1) / s1, 6) AS z_item_id, round((timestamp - m2) / s2, 6) AS z_timestamp
FROM ev, m WHERE event_id NOT IN (SELECT event_id FROM ev ORDER BY event_id LIMIT 1000)""",
    ),
)
def fitted_in_stream(spark, sf):
    """The first 1,000 events of the stream make the scaling, all that follow are scored."""
    e = A.events(spark, sf).select("event_id", "item_id", "timestamp")
    source, out, state, checkpoint = (scratch(spark, n) for n in ("numbers", "fitted", "fit-state", "fit-check"))
    e.write.json(source)
    stream = spark.readStream.schema(e.schema).json(source)
    query = fitting.start_fitted(stream, ["item_id", "timestamp"], ["event_id"], out, state, checkpoint)
    query.awaitTermination()
    z = {c: F.round(c, 6) for c in ("z_item_id", "z_timestamp")}
    return run.read_batches(spark, out).select("event_id", *z).withColumns(z)
