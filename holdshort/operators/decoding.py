"""Raw message log to decoded-message table: one projection, no row functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort.functions import frames
from holdshort.functions.timing import from_epoch_ms
from holdshort.sources.rejects import LINE, REASON


def decode_messages(raw: DataFrame, compat: bool = False, reference=None) -> DataFrame:
    """Decode (message, ts_kafka). A frame that cannot be read keeps its row with null fields.

    Text, payload and type code are columns before the fields are, so they are worked out once per row.
    """
    where = {} if reference is None else {"reference": reference}
    parts = frames.with_position(frames.with_frame_parts(raw), **where)
    out = parts.withColumns({
        "ts": from_epoch_ms("ts_kafka"),
        "kinds": frames.message_kinds("downlink_format"),
        "icao": frames.icao_address(),
        "typecode": F.col("tc").cast("double"),
        "flight_status": frames.flight_status(compat=compat),
        "wake_category": frames.wake_category(compat=compat),
        "callsign": frames.callsign(),
        "altitude_ft": frames.altitude_ft(),
        "squawk": frames.squawk(),
        "_vel": frames.velocity(),
    })
    return out.withColumns({
        "speed": F.col("_vel.speed"), "angle": F.col("_vel.angle"),
        "vertical_rate": F.col("_vel.vertical_rate"), "speed_type": F.col("_vel.speed_type"),
    }).drop("_vel", "head", "me", "tc")


def mark_unreadable(decoded: DataFrame) -> DataFrame:
    """Decoded rows with `_reason` `frame` where the message could not be read, to be split by `split_rejects`."""
    return decoded.withColumns({LINE: F.col("message"), REASON: F.when(F.col("hex").isNull(), "frame")})


def decode_quality(decoded: DataFrame) -> DataFrame:
    """How many frames were read: rows, unreadable frames, and rows without a usable downlink format."""
    return decoded.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("hex").isNull()).alias("unreadable"),
        F.count_if(F.array_contains("kinds", "NONE")).alias("other_formats"),
    )
