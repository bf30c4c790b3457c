"""From raw message text to the event table's columns; batch and stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom.functions.scalars import parse_event_time, utc_date
from clickloom.schemas import (
    CUSTOMER,
    EVENT_SPEED,
    EVENT_V1,
    EVENT_V2,
    EVENT_V2_JSON,
    GEO,
    MARKETING,
    PRODUCT,
)

PARSE_OPTIONS = {"mode": "PERMISSIVE", "allowNonNumericNumbers": "false"}

#: Columns of a message stream that say where a message stood.
POSITION = {"partition": "source_partition", "offset": "source_offset"}


def message_text(messages: DataFrame) -> DataFrame:
    """Binary messages as text."""
    return messages.withColumn("value", F.col("value").cast("string"))


def parse_json(messages: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fields of the JSON text in ``value``. A field of the wrong type is null, and so is every
    field of text that does not parse. ``keep`` carries columns such as the offset along."""
    # Generating the fields keeps later filters above the parser. Pushed below it, each of their
    # fields would parse the text once more.
    return messages.select(*keep, F.inline(F.array(F.from_json("value", schema, PARSE_OPTIONS))))


def timed(parsed: DataFrame) -> DataFrame:
    """``event_time_ts`` for rows whose event time is valid; the others are dropped."""
    with_time = parsed.withColumn("event_time_ts", parse_event_time(F.col("event_time")))
    return with_time.filter(F.col("event_time_ts").isNotNull())


def speed_events(messages: DataFrame) -> DataFrame:
    """The few fields the running counts need, valid rows only."""
    return timed(parse_json(messages, EVENT_SPEED))


def with_product(events: DataFrame) -> DataFrame:
    return events.filter(F.col("product_id").isNotNull())


def normalize_v1(parsed: DataFrame) -> DataFrame:
    """Flat events (time as text) in the event table's shape; absent structs are null."""
    rows = timed(parsed)
    absent = {"marketing": MARKETING, "customer": CUSTOMER, "geo": GEO, "product": PRODUCT}
    filled: dict[str, Column] = {name: F.lit(None).cast(kind) for name, kind in absent.items()}
    filled["event_source"] = F.lit(None).cast("string")
    filled["device"] = F.when(
        F.col("device").isNotNull(),
        F.struct(F.col("device").alias("device_type"), F.lit(None).cast("string").alias("os")))
    filled["order"] = F.when(
        F.col("order_id").isNotNull(),
        F.struct(
            "order_id", F.lit(None).cast("string").alias("status"),
            F.lit(None).cast("string").alias("payment_method"),
            F.lit(None).cast("string").alias("payment_provider"),
            F.col("revenue").alias("total")))
    return _shape(rows, filled)


def normalize_v2(parsed: DataFrame) -> DataFrame:
    """Nested events (time as text) in the event table's shape."""
    return _shape(timed(parsed), {})


def _shape(rows: DataFrame, filled: dict[str, Column]) -> DataFrame:
    filled = {
        **filled,
        "event_time": F.col("event_time_ts"),
        "event_date": utc_date(F.col("event_time_ts")),
        **{name: F.col(read) if read in rows.columns else F.lit(None) for read, name in POSITION.items()},
    }
    return rows.select(*[
        filled.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in EVENT_V2])


def events_from_v1(messages: DataFrame) -> DataFrame:
    return normalize_v1(parse_json(messages, EVENT_V1, position_of(messages)))


def events_from_v2(messages: DataFrame) -> DataFrame:
    return normalize_v2(parse_json(messages, EVENT_V2_JSON, position_of(messages)))


def position_of(messages: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in POSITION if c in messages.columns)


def first_per_event(events: DataFrame) -> DataFrame:
    """One row per ``event_id``: the one that stood first on the topic, else the earliest; rows that lack a place or time
    come last, and a hash of the whole row decides between those alike in both. Rows without an id stay.

    Repeats fall together before the shuffle, however often an event was sent.
    """
    row = F.struct(*[F.col(c) for c in events.columns])
    places = [c for c in POSITION.values() if c in events.columns]
    order = [F.col(c).isNull() for c in places] + [F.col(c) for c in places]
    order += [F.col("event_time").isNull(), F.col("event_time")] if "event_time" in events.columns else []
    order += [F.xxhash64(F.to_json(row)), F.xxhash64(F.lit(1), F.to_json(row))]
    once = events.filter(F.col("event_id").isNotNull()).groupBy("event_id").agg(
        F.min_by(row, F.struct(*order)).alias("_row")).select("_row.*")
    return once.unionByName(events.filter(F.col("event_id").isNull()))
