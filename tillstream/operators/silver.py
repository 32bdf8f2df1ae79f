"""Raw envelope to typed, validated Silver rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions import event_time, first_of

# topic -> (payload layout, required fields, accepted event types or None)
RULES: dict[str, tuple[str, tuple[str, ...], tuple[str, ...] | None]] = {
    "clickstream": (schemas.CLICKSTREAM, ("event_type", "user_id", "item_id"), schemas.CLICK_TYPES),
    "inventory": (schemas.INVENTORY, ("event_type", "item_id"), schemas.INVENTORY_TYPES),
    "user_events": (schemas.USER_EVENTS, ("event_type", "user_id"), None),
}


def parse_payload(raw: DataFrame, schema: str, text: str = "raw_value",
                  keep: Sequence[str] = ()) -> DataFrame:
    """JSON text to columns. Malformed text gives NULLs in all of them, a value
    of the wrong type a NULL in its own.

    The struct is unpacked by a generator over a one-element array. A filter on
    a parsed column cannot move below a generator, so each text is parsed once;
    with a plain projection Catalyst pushes the filter down and parses the text
    again for every field the filter names.
    """
    return raw.select(*keep, F.inline(F.array(F.from_json(F.col(text), schema))))


def reject_reason(required: Sequence[str], types: Sequence[str] | None) -> Column:
    """Why a parsed row is not accepted; NULL for an accepted row."""
    none_set = F.coalesce(*[F.col(c).cast("string") for c in required]).isNull()
    steps = [(none_set, F.lit("unreadable"))]
    steps += [(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]
    if types is not None:
        steps.append((~F.col("event_type").isin(*types), F.lit("unknown event_type")))
    return first_of(steps)


def _position(bronze: DataFrame) -> list[str]:
    """Where a record stood in its topic: what decides between equal times."""
    return [c for c in ("partition", "offset") if c in bronze.columns]


def accepted(bronze: DataFrame, topic: str, accept: Sequence[str] | None = None) -> DataFrame:
    """Silver rows: payload, envelope times and position, typed event time, stamp and day.

    ``accept`` sets an allow-list of event types where the topic has none
    (user events). A row with an unreadable time stays, without a day.
    """
    schema, required, types = RULES[topic]
    return (
        parse_payload(bronze, schema, keep=("kafka_timestamp", "ingestion_timestamp", *_position(bronze)))
        .filter(reject_reason(required, accept or types).isNull())
        .withColumn("event_ts", event_time("timestamp"))
        .withColumn("processed_at", F.current_timestamp())
        .withColumn("event_date", F.to_date("event_ts"))
    )


def silver_clickstream(bronze: DataFrame) -> DataFrame:
    return accepted(bronze, "clickstream")


def silver_inventory(bronze: DataFrame) -> DataFrame:
    return accepted(bronze, "inventory")


def silver_user_events(bronze: DataFrame, accept: Sequence[str] | None = None) -> DataFrame:
    return accepted(bronze, "user_events", accept)


def quarantine(bronze: DataFrame, topic: str, accept: Sequence[str] | None = None) -> DataFrame:
    """Refused rows with a reason. Only the fields the rules name are parsed."""
    schema, required, types = RULES[topic]
    needed = ", ".join(f for f in schema.split(", ") if f.split()[0] in required)
    parsed = parse_payload(bronze, needed, keep=("raw_value", "kafka_timestamp", "ingestion_timestamp"))
    reason = reject_reason(required, accept or types)
    return parsed.withColumn("reject_reason", reason).filter(
        F.col("reject_reason").isNotNull()
    ).select("reject_reason", "raw_value", "kafka_timestamp", "ingestion_timestamp")
