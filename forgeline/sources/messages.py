"""Message streams: a broker's topics, or files of messages with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

_COLUMNS = schemas.MESSAGE_LOG.fieldNames()
#: Broker times in files keep their microseconds.
FILE_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def kafka_options(servers: list[str], topics: list[str] | tuple[str, ...] = schemas.TOPICS, **extra: str) -> dict[str, str]:
    """Subscribe to the topics from the earliest offset on. The offsets read so far live in
    the query's checkpoint."""
    return {
        "kafka.bootstrap.servers": ",".join(servers),
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        **extra,
    }


def stream_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    raw = spark.readStream.format("kafka").options(**options).load()
    sent = F.col("timestamp").cast("timestamp_ntz").alias("timestamp")
    return raw.select("topic", "partition", "offset", sent, F.col("value").cast("string").alias("value"))


def stream_message_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON-lines files of (topic, partition, offset, timestamp, value), oldest first."""
    reader = spark.readStream.schema(schemas.MESSAGE_LOG).options(**FILE_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path).select(*_COLUMNS)


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MESSAGE_LOG).options(**FILE_OPTIONS).json(path).select(*_COLUMNS)
