"""Column expressions. Each returns a Column built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of the numeric behaviour column.
BEHAVIOR_CODES = {1: "pv", 2: "cart", 3: "fav", 4: "buy"}
BEHAVIORS = ("pv", "cart", "fav", "buy")

# Sentiment names of labelled reviews.
POSITIVE, NEGATIVE, NEUTRAL = "正面", "负面", "中性"

# Purchase probability per behaviour when no model is usable.
RULE_PROBABILITIES = {
    "buy": 0.95,
    "purchase": 0.95,
    "cart": 0.35,
    "fav": 0.25,
    "view": 0.08,
    "pv": 0.08,
}
RULE_DEFAULT = 0.12

#: Plain decimal notation; keeps Java forms such as ``12d`` out.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(key: Column, table: dict, default: Column | None = None) -> Column:
    """``table[key]`` as one CASE expression."""
    out = None
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out if default is None else out.otherwise(default)


def to_number(c: str | Column) -> Column:
    """Text to double; anything unparseable becomes null."""
    text = col(c).cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def safe_int(c: str | Column) -> Column:
    """Text to bigint by way of double, cutting the fraction; null where that fails."""
    return to_number(c).try_cast("bigint")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 where ``whole`` is 0 or null."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))


def hour_of(ts: str | Column) -> Column:
    return F.hour(F.timestamp_seconds(col(ts)))


def weekday_of(ts: str | Column) -> Column:
    """Monday is 0."""
    return F.weekday(F.timestamp_seconds(col(ts)))


def weekend_flag(weekday: Column) -> Column:
    return F.when(weekday.isin(5, 6), 1.0).otherwise(0.0)


def default_category(item: str | Column) -> Column:
    return F.pmod(col(item), F.lit(500)) + 1


def mask_id(c: str | Column) -> Column:
    """SHA-256 of the id as 64 hex digits; null counts as the empty text."""
    return F.sha2(F.coalesce(col(c).cast("string"), F.lit("")), 256)


def standardize(c: str | Column) -> Column:
    return F.lower(F.trim(col(c)))


def normalize_behavior(c: str | Column) -> Column:
    """buy/purchase become buy, pv/view become view; the rest is only trimmed and lower-cased."""
    text = standardize(col(c).cast("string"))
    return (
        F.when(text.isin("buy", "purchase"), "buy").when(text.isin("pv", "view"), "view").otherwise(text)
    )


def event_seconds(c: str | Column) -> Column:
    """``yyyy-M-d H:m:s.f`` (fraction required, 1-6 digits) to epoch seconds, else null."""
    text = col(c).cast("string")
    parsed = F.try_to_timestamp(text, F.lit("yyyy-M-d H:m:s.SSSSSS"))
    return F.when(text.rlike(r"\.\d{1,6}$"), F.unix_seconds(parsed))


def stamp_or_time(stamp: str | Column, time: str | Column) -> Column:
    """Epoch seconds if given and not empty, else ``yyyy-M-d H:m:s.f``, as a timestamp with its
    fraction; null where that cannot be read."""
    text = col(time).cast("string")
    parsed = F.when(text.rlike(r"\.\d{1,6}$"), F.try_to_timestamp(text, F.lit("yyyy-M-d H:m:s.SSSSSS")))
    given = col(stamp).isNotNull() & (col(stamp) != "")
    return F.when(given, F.timestamp_seconds(safe_int(stamp))).otherwise(parsed)


def mixed_time(c: str | Column) -> Column:
    """Text holding either an ISO-8601 time or epoch seconds."""
    text = F.trim(col(c).cast("string"))
    epoch = F.timestamp_seconds(to_number(text))
    return F.coalesce(F.when(~text.rlike(NUMBER), F.try_to_timestamp(text)), epoch)


def json_field(c: str | Column, path: str, missing: str | None = None, bad: str | None = None) -> Column:
    """A JSON field as unquoted text; ``missing`` if the key is absent, ``bad`` if it is not JSON."""
    value = F.get_json_object(col(c), path)
    valid = F.try_parse_json(col(c)).isNotNull()
    if missing is None and bad is None:
        return value
    return F.when(~valid | col(c).isNull(), F.lit(bad)).otherwise(F.coalesce(value, F.lit(missing)))


def os_name(c: str | Column = "device_info") -> Column:
    return json_field(c, "$.os", missing="Unknown", bad="Error")


def text_prefix(c: str | Column, n: int = 30) -> Column:
    return F.substring(col(c), 1, n)


def rule_probability(behavior: str | Column) -> Column:
    key = standardize(F.coalesce(col(behavior).cast("string"), F.lit("")))
    return lookup(key, RULE_PROBABILITIES, F.lit(RULE_DEFAULT))


def load_pct(depth: str | Column, limit: str | Column, unbounded: float = 0.0) -> Column:
    """Queue depth over its limit, rounded to 4 digits; ``unbounded`` where there is no limit."""
    return F.when(col(limit) > 0, F.round(col(depth) / col(limit), 4)).otherwise(F.lit(unbounded))


def hash_key(id_col: str | Column, seed: int | str) -> Column:
    """Hex digest that gives a reproducible, engine-independent random order."""
    return F.md5(F.concat(col(id_col).cast("string"), F.lit(str(seed))))
