"""Stream configuration: a master list and one small file per stream (YAML or JSON)."""

from __future__ import annotations

import json
from dataclasses import asdict, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keyscore.records import Alert, Category, Sensor, StreamConfig

try:
    import yaml
except ImportError:  # JSON configuration still works
    yaml = None


def _parse(text: str, path: str) -> dict:
    if yaml is not None:
        return yaml.safe_load(text)
    try:
        return json.loads(text)
    except ValueError as error:
        raise ImportError(f"reading {path} needs PyYAML") from error


def read_properties(spark: SparkSession, path: str) -> dict:
    """One small configuration file, such as the connection settings, from any file system Spark reads."""
    rows = spark.read.text(path, wholetext=True).filter("trim(value) <> ''").take(2)
    if len(rows) != 1:
        raise ValueError(f"{path} holds {'more than one' if rows else 'no'} configuration file")
    return _parse(rows[0].value, path)


def load_config(spark: SparkSession, folder: str, master: str, suffix: str = ".yml") -> list[StreamConfig]:
    """Every stream of the master list with its own file.

    The key is the master's ``equipName``, which is what the messages carry; the file's ``name``
    only names artefacts, and may differ.
    """
    streams = []
    for entry in read_properties(spark, f"{folder}/{master}")["config"]:
        body = read_properties(spark, f"{folder}/{entry['fileName']}{suffix}")
        streams.append(
            StreamConfig(
                key=entry["equipName"],
                name=body.get("name", entry["equipName"]),
                cont=tuple(_make(Sensor, c) for c in body.get("cont") or ()),
                disc=tuple(_make(Category, d) for d in body.get("disc") or ()),
                alrt=tuple(_make(Alert, a) for a in body.get("alrt") or ()),
                err=float(body.get("err", 0.0)),
                success=float(body.get("success", 0.0)),
                takt_time=int(entry.get("taktTime", 0)),
                offset_delay=int(entry.get("offsetDelay", 0)),
                consumer_topic=entry.get("consumerTopic", ""),
                producer_topic=entry.get("producerTopic", ""),
            )
        )
    keys = [s.key for s in streams]
    if len(set(keys)) != len(keys):
        raise ValueError("two streams share a key")
    return streams


def _make(cls, entry: dict):
    kinds = {"int": int, "float": float, "str": str, "bool": bool}
    return cls(**{f.name: kinds[f.type](entry[f.name]) for f in fields(cls) if f.name in entry})


def config_tables(spark: SparkSession, streams: list[StreamConfig]) -> dict[str, DataFrame]:
    """The configuration as tables ``stream, cont, disc, alrt``; the parts carry the stream's key."""
    head = [
        (s.key, s.name, s.err, s.success, s.takt_time, s.offset_delay, s.consumer_topic, s.producer_topic)
        for s in streams
    ]
    tables = {
        "stream": spark.createDataFrame(
            head,
            "key string, name string, err double, success double, takt_time int, offset_delay int, "
            "consumer_topic string, producer_topic string",
        )
    }
    for part, cls in (("cont", Sensor), ("disc", Category), ("alrt", Alert)):
        rows = [(s.key, *asdict(item).values()) for s in streams for item in getattr(s, part)]
        tables[part] = spark.createDataFrame(rows, _table_schema(cls))
    return tables


def _table_schema(cls) -> T.StructType:
    kinds = {"int": T.IntegerType(), "float": T.DoubleType(), "str": T.StringType(), "bool": T.BooleanType()}
    return T.StructType(
        [T.StructField("key", T.StringType())] + [T.StructField(f.name, kinds[f.type]) for f in fields(cls)]
    )
