"""JSON transaction messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerscope.schemas import RAW_MESSAGE


def parse_messages(df: DataFrame, schema: T.StructType = RAW_MESSAGE) -> DataFrame:
    """Typed columns from a ``value`` column of bytes or text, batch or stream.

    Messages that cannot be parsed, or carry no numeric id, are left out.
    """
    data = F.from_json(F.col("value").cast("string"), schema)
    rows = df.select(data.alias("data")).select("data.*")
    return rows.withColumn("id", F.col("id").try_cast("bigint")).filter(F.col("id").isNotNull())


def rejected(df: DataFrame, schema: T.StructType = RAW_MESSAGE) -> DataFrame:
    """(value, reason) of the messages that ``parse_messages`` leaves out or cannot date.

    The reasons are ``unreadable``, ``no id`` and ``no time``; rows of the last kind are kept
    by the parser with a NULL time.
    """
    text = F.col("value").cast("string")
    bad = "__unreadable"
    fields = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    data = F.from_json(text, fields, {"columnNameOfCorruptRecord": bad})
    rows = df.select(text.alias("value"), data.alias("data"))
    time = F.col("data.timestamp")
    reason = (
        F.when(F.col("data").isNull() | F.col(f"data.{bad}").isNotNull(), "unreadable")
        .when(F.col("data.id").try_cast("bigint").isNull(), "no id")
        .when(time.isNotNull() & time.try_cast("timestamp").isNull(), "no time")
    )
    return rows.select("value", reason.alias("reason")).filter("reason IS NOT NULL")


def kafka_options(
    bootstrap: str, topic: str, user: str | None = None, password: str | None = None,
    starting: str = "latest",
) -> dict[str, str]:
    """Reader options for one topic, with SASL over TLS when a user is given."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if user:
        module = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{module} required username="{user}" password="{password}";',
        }
    return options


def kafka_source(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming DataFrame with a binary ``value``; needs the Kafka connector package."""
    return spark.readStream.format("kafka").options(**options).load()
