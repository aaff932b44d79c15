"""Turns of conversations with nulls settled and a defined order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A turn is known by half of the SHA-256 of its role and text, in hex.
KEY_HEX = 32
#: Turns by number (null first), then role, then key; rows equal in all of these are interchangeable.
ORDER = ["turn", "role", "key"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and key of every row; a null role or text is empty. Other columns are not read."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role, text)
    whole = F.concat(F.char_length("role"), F.lit(":"), "role", "text")
    return rows.withColumn("key", F.substring(F.sha2(whole, 256), 1, KEY_HEX))
