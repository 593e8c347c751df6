"""Chat updates (JSON): schema, parsing, and a feed derived from conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from vitrine.constants import DEFAULT_USER_NAME

UPDATE_SCHEMA = StructType([
    StructField("update_id", LongType()),
    StructField("ts", TimestampNTZType()),  # wall clock: same value in any session zone
    StructField("message", StructType([
        StructField("chat", StructType([StructField("id", LongType())])),
        StructField("from", StructType([StructField("first_name", StringType())])),
        StructField("text", StringType()),
    ])),
])


def parse_updates(updates: DataFrame) -> DataFrame:
    """Flatten updates; drop those without a message, chat id or text; a
    missing first name becomes the default addressee."""
    return (updates.filter(F.col("message").isNotNull()
                           & F.col("message.chat.id").isNotNull()
                           & F.col("message.text").isNotNull())
            .select("update_id", "ts", F.col("message.chat.id").alias("chat_id"),
                    F.coalesce(F.col("message.from.first_name"), F.lit(DEFAULT_USER_NAME))
                    .alias("first_name"),
                    F.col("message.text").alias("text")))


# FIXED VALUES: conventions of the update feed derived from ``conversations``.
FEED_EPOCH = "2024-01-01 00:00:00"
TURN_ID_FACTOR = 1 << 32  # turns of any number keep ids of their own
ANONYMOUS_EVERY = 3


def updates_from_conversations(conversations: DataFrame) -> DataFrame:
    """User turns as chat updates: update_id = conv_id * 2^32 + turn, one
    minute per conversation and one second per turn after a fixed epoch;
    every third conversation has no first name."""
    u = conversations.filter(F.col("role") == "user")
    return u.select(
        (F.col("conv_id") * TURN_ID_FACTOR + F.col("turn")).alias("update_id"),
        (F.lit(FEED_EPOCH).cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.col("conv_id").cast("int"),
                              F.col("turn").cast("decimal(10,6)"))).alias("ts"),
        F.struct(
            F.struct(F.col("conv_id").alias("id")).alias("chat"),
            F.struct(F.when(F.col("conv_id") % ANONYMOUS_EVERY == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("Cliente "), F.col("conv_id").cast("string")))
                     .alias("first_name")).alias("from"),
            F.col("text").alias("text")).alias("message"))
