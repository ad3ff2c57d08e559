"""Small hand-made records."""

import json
import random

from keyscore.records import ENDPOINT, Category, Layout, Sensor, StreamConfig

SMALL = Layout(sensors=("sensor0", "sensor1"), categories=("cat0", "cat1"), sizes=(2, 3), divisors=(25.0, 50.0))


def message(uuid, cats, sensors, result=1, layout=SMALL, **extra):
    record = {
        "uuid": uuid,
        "CurrentTime": "2020-01-01 00:00:00",
        "Topic": "t",
        "Result": result,
        "Categories": dict(zip(layout.categories, cats)),
        "Sensors": dict(zip(layout.sensors, sensors)),
    }
    record.update(extra)
    return json.dumps(record)


def small_records(n=200, seed=3):
    """(uuid, CurrentTime, Result, cat0, cat1, sensor0, sensor1); Result is 1 where the sensors add up to more."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.uniform(0, 100), rng.uniform(0, 100)
        rows.append((f"u{i}", "2020-01-01 00:00:00", int(a + b > 100), i % 2, i % 3, a, b))
    return rows


RECORD_SCHEMA = (
    "uuid string, CurrentTime string, Result int, cat0 int, cat1 int, sensor0 double, sensor1 double"
)

STREAMS = [
    StreamConfig(
        key="press",
        name="pressing",
        cont=(Sensor(21, "heat"), Sensor(22, "flow")),
        disc=(Category(16, "mode", 3), Category(17, "lid", 2)),
    ),
    StreamConfig(key="wash", name="wash", cont=(Sensor(1, "weight"),), disc=(Category(2, "grade", 2),)),
]

__all__ = ["ENDPOINT", "RECORD_SCHEMA", "SMALL", "STREAMS", "message", "small_records"]
