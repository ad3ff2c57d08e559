import json

import pytest

from keyscore.functions.scalar import parse_json
from keyscore.operators.features import feature_names, fixed_layout
from keyscore.records import ENDPOINT, Layout, column_plan, endpoint_schema, record_schema
from keyscore.sources.config import config_tables, load_config, read_properties
from tests.fixtures import SMALL, STREAMS, message


def test_endpoint_layout():
    assert ENDPOINT.width == 30
    assert ENDPOINT.offsets == (10, 11, 15, 18, 20, 21, 25, 28)
    slots = ENDPOINT.slots()
    assert slots[0] == (0, "sensor0", "q") and slots[10] == (10, "cat00", "i")
    assert slots[14] == (14, "cat13", "i") and slots[29] == (29, "cat71", "i")


def test_layout_lengths_must_agree():
    with pytest.raises(ValueError):
        Layout(("a",), (), (), ())


def test_feature_names(spark):
    assert feature_names(spark, SMALL).count() == SMALL.width == 5


def test_stream_schema_and_columns():
    schema = record_schema(STREAMS[0])
    assert schema["categories"].dataType.names == ["mode", "lid"]
    plan = column_plan(STREAMS[0])
    assert plan.encoded == ["modeVec", "lidVec"]
    assert plan.assembled == ["modeVec", "lidVec", "heat", "flow"]
    assert set(plan.dropped) >= set(plan.assembled) | {"mode", "unscaled"}


@pytest.mark.parametrize(
    "text, sensor0, cat1, uuid",
    [
        ("not json", None, None, None),
        (message("u", [0, "x"], [1.0, 2.0]), 1.0, None, "u"),  # wrong type nulls that field
        (message("u", [0, 1], [1.0, 2.0]).replace("Sensors", "sensors"), None, 1, "u"),  # names keep their case
        (message("u", [0, 1], [1.0, 2.0], more={"x": 1}), 1.0, 1, "u"),  # unknown fields are ignored
    ],
)
def test_parse_edges(spark, text, sensor0, cat1, uuid):
    rows = spark.createDataFrame([("LR", text)], "key string, value string")
    row = parse_json(rows, endpoint_schema(SMALL)).select("data.*").first()
    assert (row.Sensors.sensor0 if row.Sensors else None) == sensor0
    assert (row.Categories.cat1 if row.Categories else None) == cat1
    assert row.uuid == uuid


def test_fixed_layout_brute_force(spark):
    rows = [(c0, c1, None if c0 is None else 10.0 * c0, -5.0 * c1) for c0 in (0, 1, 7, None) for c1 in (0, 1, 2)]
    df = spark.createDataFrame(rows, "cat0 int, cat1 int, sensor0 double, sensor1 double")
    for row in fixed_layout(df, SMALL, vector=False).collect():
        expected = [row.sensor0 / 25 if row.sensor0 is not None else None, row.sensor1 / 50]
        expected += [1.0 if row.cat0 == 1 else 0.0] + [1.0 if row.cat1 == level else 0.0 for level in (1, 2)]
        assert row.features == expected


MASTER = """
config:
- equipName: press
  fileName: press07
  taktTime: 1500
  offsetDelay: 250
  consumerTopic: press
  producerTopic: plant
"""
STREAM = """
alrt:
- {alarm: 95.0, atype: alarm, id: 3, incr: true, name: hot, warn: 80.0}
cont:
- {dist: norm, id: 1, max: 120.0, min: 5.0, name: heat, neg1: 70.0, neg2: 6.0, pos1: 40.0, pos2: 8.0}
disc:
- {id: 2, levels: "idle, slow, fast", name: mode, neg: "0.5, 0.3, 0.2", num: 3, pos: "0.1, 0.3, 0.6"}
err: 0.05
name: pressing
success: 0.7
"""


def test_load_config(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "streams.yml").write_text(MASTER)
    (tmp_path / "press07.yml").write_text(STREAM)
    (stream,) = load_config(spark, str(tmp_path), "streams.yml")
    assert (stream.key, stream.name, stream.offset_delay) == ("press", "pressing", 250)
    assert stream.cont[0].max == 120.0 and stream.disc[0].num == 3 and stream.alrt[0].incr is True
    tables = config_tables(spark, [stream])
    assert tables["disc"].first().levels == "idle, slow, fast"
    assert tables["stream"].first().producer_topic == "plant"
    assert tables["alrt"].count() == tables["cont"].count() == 1


def test_json_config_and_shared_keys(spark, tmp_path):
    entry = {"equipName": "a", "fileName": "a01"}
    (tmp_path / "streams.yml").write_text(json.dumps({"config": [entry, entry]}))
    (tmp_path / "a01.yml").write_text(json.dumps({"name": "a", "cont": [], "disc": []}))
    assert read_properties(spark, str(tmp_path / "a01.yml"))["name"] == "a"
    with pytest.raises(ValueError):
        load_config(spark, str(tmp_path), "streams.yml")
