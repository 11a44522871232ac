"""Example user transforms, referred to by name as a user's own would be."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tag_and_upper(transports: DataFrame) -> DataFrame:
    """Frame form: upper-case the payload text and add an attribute."""
    tagged = F.map_concat("attributes", F.create_map(F.lit("tagged"), F.lit("yes")))
    return transports.select(
        "event_id",
        tagged.alias("attributes"),
        F.upper(F.col("payload").cast("string")).cast("binary").alias("payload"),
        "event_ts",
    )


def reject_large(event: dict) -> dict:
    """Event form: refuse payloads whose ``k`` is above 90, double the others."""
    body = json.loads(event["payload"])
    if body["k"] > 90:
        raise ValueError(f"k is out of range: {body['k']}")
    return event | {"payload": json.dumps({"k": 2 * body["k"]}).encode()}
