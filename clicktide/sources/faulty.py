"""Broken events made from good ones: test input for parsing, routing and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.functions import scalars as S
from clicktide.streaming.events import FIELDS

# The injected faults and what they look like.
FAULTS = ("drop_field", "wrong_type", "bad_timestamp", "non_dict")
DROPPABLE = ("user_id", "item_id", "event_time")
BAD_ITEM, BAD_TIME, BAD_PAYLOAD = "not_an_int", "2099/99/99 99:99:99", '"BROKEN_EVENT_PAYLOAD"'


def _hex_number(digest, start: int, digits: int):
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("int")


def inject_faults(df: DataFrame, id_col: str, rate: float, seed: int = 42) -> DataFrame:
    """Events as JSON ``value``; about ``rate`` of them carry one of four faults (``fault``).

    The choice hangs on a hash of the id, so a rerun breaks the same events.
    """
    digest = S.hash_key(id_col, seed)
    chosen = _hex_number(digest, 1, 4) < int(rate * 65536)
    kind = F.when(chosen, S.lookup(_hex_number(digest, 5, 1) % 4, dict(enumerate(FAULTS))))
    field = F.when(
        kind == "drop_field", S.lookup(_hex_number(digest, 6, 1) % 3, dict(enumerate(DROPPABLE)))
    )
    columns = [c for c in df.columns if c != id_col or c in FIELDS]

    def kept(c: str):
        value = F.col(c)
        if c == "event_time":
            value = F.when(F.col("fault") == "bad_timestamp", BAD_TIME).otherwise(value)
        if c in DROPPABLE:
            value = F.when(F.coalesce(F.col("_field"), F.lit("")) != c, value)
        return value.alias(c)

    good = F.to_json(F.struct(*[kept(c) for c in columns]))
    wrong = F.to_json(F.struct(*[F.lit(BAD_ITEM).alias(c) if c == "item_id" else kept(c) for c in columns]))
    value = (
        F.when(F.col("fault") == "non_dict", BAD_PAYLOAD)
        .when(F.col("fault") == "wrong_type", wrong)
        .otherwise(good)
    )
    return df.withColumns({"fault": kind, "_field": field}).select(
        id_col, value.alias("value"), "fault"
    )
