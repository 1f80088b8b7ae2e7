"""Message sources: a Kafka topic, or a folder of message files with the same
``key, value, timestamp`` columns (the stand-in used where no broker is
reachable, e.g. tests)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from leadlake.schemas import MESSAGE_SCHEMA


@dataclass(frozen=True)
class MessageSource:
    """Where messages come from.

    ``kind="kafka"``: ``options`` holds ``kafka.bootstrap.servers`` etc. and
    ``topic`` is subscribed from the earliest offset.
    ``kind="files"``: ``path`` is a folder of ``fmt`` files (parquet by
    default) with the message schema; new files are new messages.

    A micro-batch of a file stream takes files up to ``max_bytes_per_trigger`` (at
    least one), unless ``max_files_per_trigger`` bounds it, and one of a Kafka
    stream up to ``max_offsets_per_trigger`` messages: a task's memory follows the
    batch, not the backlog.
    """
    kind: str
    topic: str | None = None
    path: str | None = None
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int = 64 * 1024 * 1024
    max_offsets_per_trigger: int = 2_000_000

    def __post_init__(self):
        if self.kind == "kafka" and not self.topic:
            raise ValueError("a kafka source needs a topic")
        if self.kind == "files" and not self.path:
            raise ValueError("a file source needs a path")
        if self.kind not in ("kafka", "files"):
            raise ValueError("kind must be 'kafka' or 'files'")


def read_message_stream(spark: SparkSession, source: MessageSource) -> DataFrame:
    """Unbounded read from the earliest message."""
    if source.kind == "kafka":
        reader = (spark.readStream.format("kafka").option("subscribe", source.topic)
                  .option("startingOffsets", "earliest")
                  .option("maxOffsetsPerTrigger", str(source.max_offsets_per_trigger)))
        for k, v in source.options.items():
            reader = reader.option(k, v)
        return reader.load()
    reader = spark.readStream.schema(MESSAGE_SCHEMA).format(source.fmt)
    if source.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(source.max_files_per_trigger))
    elif not {"maxfilespertrigger", "maxbytespertrigger"} & {k.lower() for k in source.options}:
        reader = reader.option("maxBytesPerTrigger", str(source.max_bytes_per_trigger))
    for k, v in source.options.items():
        reader = reader.option(k, v)
    return reader.load(source.path)


def read_message_batch(spark: SparkSession, source: MessageSource) -> DataFrame:
    """Bounded snapshot: earliest .. latest offsets (or all files now present)."""
    if source.kind == "kafka":
        reader = (spark.read.format("kafka").option("subscribe", source.topic)
                  .option("startingOffsets", "earliest").option("endingOffsets", "latest"))
        for k, v in source.options.items():
            reader = reader.option(k, v)
        return reader.load()
    return spark.read.schema(MESSAGE_SCHEMA).format(source.fmt).load(source.path)
