"""Message sources: a topic, or files of messages standing in for one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keyscore.functions.scalar import cast_kv
from keyscore.records import MESSAGE_SCHEMA


def read_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    max_per_trigger: int | None = None,
    max_bytes: int | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A stream of messages.

    For a topic ``options`` hold ``kafka.bootstrap.servers`` and ``subscribe``; reading starts at
    the latest offsets unless told otherwise. For files they hold ``path``. ``max_per_trigger``
    bounds a micro-batch: offsets for a topic, files otherwise. ``max_bytes`` bounds that of files by
    their size.
    """
    options = dict(options or {})
    if fmt == "kafka":
        options.setdefault("startingOffsets", "latest")
        if max_per_trigger:
            options["maxOffsetsPerTrigger"] = str(max_per_trigger)
        return spark.readStream.format("kafka").options(**options).load()
    if max_per_trigger:
        options["maxFilesPerTrigger"] = str(max_per_trigger)
    if max_bytes:
        options["maxBytesPerTrigger"] = str(max_bytes)
    return spark.readStream.format(fmt).schema(schema or MESSAGE_SCHEMA).options(**options).load()


def with_kafka_meta(df: DataFrame) -> DataFrame:
    """Key and value as strings, with the partition and offset they came from."""
    return cast_kv(df, "partition", "offset")
