"""The three queues of the pipeline as Spark sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from millrace.sources.dump import QueueDump

QUEUES = ("raw", "events", "errors")


def check_queue(queue: str) -> str:
    if queue not in QUEUES:
        raise ValueError(f"Unknown queue type {queue}")
    return queue


def kafka_source_options(brokers: str, topic: str, queue: str, max_offsets: int | None = None) -> dict[str, str]:
    """Read options: earliest offsets first; Spark's checkpoint takes the place of committed offsets."""
    check_queue(queue)
    if not brokers:
        raise ValueError("Missing Kafka brokers")
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "groupIdPrefix": f"millrace-{queue}",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_sink_options(brokers: str, topic: str | None, queue: str) -> dict[str, str]:
    check_queue(queue)
    if not brokers:
        raise ValueError("Missing Kafka brokers")
    if not topic:
        raise ValueError(f"Missing topic of queue {queue}")
    return {"kafka.bootstrap.servers": brokers, "topic": topic}


def batch_limit(fmt: str, n: int) -> dict[str, str]:
    """Read option that bounds a micro-batch: messages of Kafka and of a queue's dump, files of a folder."""
    return {{"kafka": "maxOffsetsPerTrigger", "queue_dump": "limit"}.get(fmt, "maxFilesPerTrigger"): str(n)}


def read_queue(
    spark: SparkSession, queue: str, fmt: str, options: dict[str, str], streaming: bool = True
) -> DataFrame:
    """Messages of a queue as one binary column ``value``."""
    check_queue(queue)
    options = dict(options)
    if fmt == QueueDump.name():
        spark.dataSource.register(QueueDump)
        return spark.readStream.format(fmt).options(**options).load()
    reader = spark.readStream if streaming else spark.read
    path = options.pop("path", None)
    reader = reader.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema("value BINARY")
    frame = reader.load(path) if path else reader.load()
    return frame.selectExpr("CAST(value AS BINARY) AS value")


def write_queue(df: DataFrame, queue: str, fmt: str, options: dict[str, str], mode: str = "append") -> None:
    """Write a ``value`` column as one message per row."""
    check_queue(queue)
    options = dict(options)
    path = options.pop("path", None)
    writer = df.select("value").write.format(fmt).options(**options).mode(mode)
    writer.save(path) if path else writer.save()


def dev_sink(df: DataFrame, queue: str, name: str | None = None) -> DataStreamWriter:
    """A stream's messages on the console, or in the in-memory table ``name``."""
    check_queue(queue)
    shown = df.selectExpr("CAST(value AS STRING) AS value")
    if name:
        return shown.writeStream.format("memory").queryName(name).outputMode("append")
    return shown.writeStream.format("console").outputMode("append")


def written_bytes(df: DataFrame) -> DataFrame:
    """How many bytes a batch of messages holds."""
    return df.selectExpr("coalesce(sum(octet_length(value)), 0) AS bytes")
