"""Announcement of the event minutes a write has touched."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideline.functions.codec import envelope, notice_json


def notice_lines(minutes: DataFrame, enveloped: bool = False) -> DataFrame:
    """One compact JSON text per minute, optionally in the base64 form of a message bus."""
    text = notice_json(F.col("minute"))
    return minutes.select((envelope(text) if enveloped else text).alias("value"))


def write_notices(minutes: DataFrame, root: str, batch_id: int, enveloped: bool = False) -> None:
    """Write the notices of one micro-batch; a replay of the batch replaces them."""
    notice_lines(minutes, enveloped).write.mode("overwrite").text(f"{root}/batch_id={batch_id}")
