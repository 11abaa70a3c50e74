import json

from opsflow.operators.envelope import envelope, envelope_structured


def test_literal_envelope_unescapes_embedded_json(spark):
    df = spark.createDataFrame([("a1", '{"k": {"x": 1}}', None, "ends}")], "accId string, props string, n string, t string")
    out = envelope(df).first()
    assert out["key"] == "a1"
    value = out["value"]
    assert '"props":{"k": {"x": 1}}' in value        # embedded JSON text became an object
    assert '"n":null' in value                        # nulls kept
    assert '"t":"ends}' in value and value.endswith('"t":"ends}}')   # a value ending in } loses its quote


def test_literal_envelope_round_trips_plain_rows(spark):
    df = spark.createDataFrame([("a1", '{"k": {"x": 1}}', None)], "accId string, props string, n string")
    assert json.loads(envelope(df).first()["value"])["props"] == {"k": {"x": 1}}


def test_literal_envelope_damages_real_backslashes(spark):
    df = spark.createDataFrame([("a1", "C:\\dir")], "accId string, path string")
    assert "C:dir" in envelope(df).first()["value"]


def test_structured_envelope_keeps_backslashes(spark):
    df = spark.createDataFrame([("a1", '{"k": 5}', "C:\\dir")], "accId string, props string, path string")
    value = json.loads(envelope_structured(df, {"props": "k int"}).first()["value"])
    assert value["props"] == {"k": 5}
    assert value["path"] == "C:\\dir"
