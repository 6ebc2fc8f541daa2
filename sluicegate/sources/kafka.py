"""Kafka topics as a source and a sink; the connector jar is the deployment's to add."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def subscribe_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Lost offsets stop the query unless the caller says otherwise.

    ``min_partitions`` splits a hot topic partition over several tasks.
    """
    if not servers or not topic:
        raise ValueError("servers and topic are needed")
    if starting_offsets not in ("earliest", "latest") and not starting_offsets.startswith("{"):
        raise ValueError(f"starting offsets: 'earliest', 'latest' or JSON, not {starting_offsets!r}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    return spark.readStream.format("kafka").options(**subscribe_options(servers, topic, **settings)).load()


def send_batch(messages: DataFrame, servers: str, topic: str) -> None:
    """Send rows of ``value`` (and ``key``) from the executors."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
