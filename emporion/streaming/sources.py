"""Topic sources with the Kafka row shape.

``kafka_topic`` is the production source (needs the Kafka connector on the
classpath).  ``file_topic`` reads Parquet files holding Kafka-shaped rows
(key, value, topic, partition, offset, timestamp, timestampType); it is the
offline stand-in used in tests and for replays.  Both return a streaming
DataFrame with the same columns, so the parsers do not care which one feeds
them.  Rate limits: ``maxOffsetsPerTrigger`` (Kafka) / ``maxFilesPerTrigger``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import KAFKA_ROW


def kafka_topic(spark: SparkSession, bootstrap: str, topic: str, starting_offsets: str = "latest",
                max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def file_topic(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    reader = spark.readStream.schema(KAFKA_ROW).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
