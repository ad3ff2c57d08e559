"""Record shapes: the endpoint record, feature layouts and per-stream configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Layout:
    """Which fields of a record become features, and how wide each one is.

    ``sizes`` are the number of levels of each category; ``divisors`` the fixed scale of
    each sensor. The fixed layout puts the sensors first and gives each category one slot
    less than it has levels.
    """

    sensors: tuple[str, ...]
    categories: tuple[str, ...]
    sizes: tuple[int, ...]
    divisors: tuple[float, ...]

    def __post_init__(self):
        if len(self.sensors) != len(self.divisors):
            raise ValueError("one divisor per sensor is needed")
        if len(self.categories) != len(self.sizes):
            raise ValueError("one size per category is needed")

    @property
    def width(self) -> int:
        return len(self.sensors) + sum(size - 1 for size in self.sizes)

    @property
    def offsets(self) -> tuple[int, ...]:
        """First slot of each category."""
        start, out = len(self.sensors), []
        for size in self.sizes:
            out.append(start)
            start += size - 1
        return tuple(out)

    def slots(self) -> list[tuple[int, str, str]]:
        """(slot, name, type) of every feature; ``q`` is numeric, ``i`` an indicator."""
        names = [(name, "q") for name in self.sensors]
        for name, size in zip(self.categories, self.sizes):
            names += [(f"{name}{level}", "i") for level in range(size - 1)]
        return [(slot, name, kind) for slot, (name, kind) in enumerate(names)]


# Levels of cat0..cat7 and scale of sensor0..sensor9 of the endpoint record.
ENDPOINT_SIZES = (2, 5, 4, 3, 2, 5, 4, 3)
ENDPOINT_DIVISORS = (25.0, 50.0, 75.0, 100.0, 125.0, 150.0, 175.0, 200.0, 225.0, 250.0)

# The stream keys that select one of the four models.
MODEL_KEYS = ("LR", "SVC", "RF", "GBT")

ENDPOINT = Layout(
    sensors=tuple(f"sensor{i}" for i in range(len(ENDPOINT_DIVISORS))),
    categories=tuple(f"cat{i}" for i in range(len(ENDPOINT_SIZES))),
    sizes=ENDPOINT_SIZES,
    divisors=ENDPOINT_DIVISORS,
)


def endpoint_schema(layout: Layout = ENDPOINT) -> T.StructType:
    """The fixed record with nested structs."""
    return T.StructType(
        [
            T.StructField("uuid", T.StringType()),
            T.StructField("CurrentTime", T.StringType()),
            T.StructField("Topic", T.StringType()),
            T.StructField("Result", T.IntegerType()),
            T.StructField("Categories", _fields(layout.categories, T.IntegerType())),
            T.StructField("Sensors", _fields(layout.sensors, T.DoubleType())),
        ]
    )


def endpoint_map_schema() -> T.StructType:
    """The same record with its categories and sensors as maps."""
    return T.StructType(
        [
            T.StructField("uuid", T.StringType()),
            T.StructField("CurrentTime", T.StringType()),
            T.StructField("Topic", T.StringType()),
            T.StructField("Result", T.IntegerType()),
            T.StructField("Categories", T.MapType(T.StringType(), T.IntegerType())),
            T.StructField("Sensors", T.MapType(T.StringType(), T.DoubleType())),
        ]
    )


MESSAGE_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)


def _fields(names, kind) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name in names])


# --- per-stream configuration ---------------------------------------------------------


@dataclass(frozen=True)
class Sensor:
    id: int
    name: str
    max: float = 0.0
    min: float = 0.0
    dist: str = ""
    pos1: float = 0.0
    pos2: float = 0.0
    neg1: float = 0.0
    neg2: float = 0.0


@dataclass(frozen=True)
class Category:
    id: int
    name: str
    num: int
    levels: str = ""
    pos: str = ""
    neg: str = ""


@dataclass(frozen=True)
class Alert:
    id: int
    name: str
    atype: str = ""
    warn: float = 0.0
    alarm: float = 0.0
    incr: bool = False


@dataclass(frozen=True)
class StreamConfig:
    """One stream: ``key`` is what its messages carry, ``name`` what its artefacts are called."""

    key: str
    name: str
    cont: tuple[Sensor, ...]
    disc: tuple[Category, ...]
    alrt: tuple[Alert, ...] = ()
    err: float = 0.0
    success: float = 0.0
    takt_time: int = 0
    offset_delay: int = 0
    consumer_topic: str = ""
    producer_topic: str = ""


@dataclass(frozen=True)
class ColumnPlan:
    """Columns that the feature stages read, add and leave behind."""

    categories: list[str]
    sensors: list[str]
    encoded: list[str] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "encoded", [f"{name}Vec" for name in self.categories])

    @property
    def assembled(self) -> list[str]:
        return self.encoded + self.sensors

    @property
    def dropped(self) -> list[str]:
        return self.encoded + self.sensors + self.categories + ["unscaled"]


def record_schema(cfg: StreamConfig) -> T.StructType:
    """The record of one configured stream."""
    return T.StructType(
        [
            T.StructField("uuid", T.StringType()),
            T.StructField("currentTime", T.StringType()),
            T.StructField("topic", T.StringType()),
            T.StructField("result", T.IntegerType()),
            T.StructField("categories", _fields([c.name for c in cfg.disc], T.IntegerType())),
            T.StructField("sensors", _fields([s.name for s in cfg.cont], T.DoubleType())),
        ]
    )


def column_plan(source: StreamConfig | Layout) -> ColumnPlan:
    """The column plan of a configured stream or of a fixed layout."""
    if isinstance(source, Layout):
        return ColumnPlan(list(source.categories), list(source.sensors))
    return ColumnPlan([c.name for c in source.disc], [s.name for s in source.cont])
