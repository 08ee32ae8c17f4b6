"""Rescued data inside structs and arrays."""

import json

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from quarrysight.sources.rescue import rescue_json

POINT = StructType([StructField("x", DoubleType()), StructField("tag", StringType())])
SCHEMA = StructType([StructField("id", IntegerType()), StructField("at", POINT), StructField("points", ArrayType(POINT)),
                     StructField("deep", StructType([StructField("in", StructType([StructField("n", IntegerType())]))]))])


def test_nested_misfits_have_their_path(spark):
    cases = {
        '{"id": 1, "at": {"x": 1.5, "tag": "a"}, "points": [{"x": 2}], "deep": {"in": {"n": 3}}}': None,
        '{"id": 1, "at": {"x": "far", "tag": "a", "y": 2}}': {"at.x": "far", "at.y": "2"},
        '{"points": [{"x": 1}, {"x": "no", "z": [1, 2]}, {"tag": "t"}]}': {"points[1].x": "no", "points[1].z": "[1,2]"},
        '{"deep": {"in": {"n": "many", "o": {"p": 1}}, "out": true}}': {"deep.in.n": "many", "deep.in.o": '{"p":1}', "deep.out": "true"},
        '{"at": "here", "points": 7, "id": null}': {"at": "here", "points": "7"},
        '{"at": null, "points": [null, {"x": null}], "more": null}': None,
        '{"b": 1, "id": "x", "a": 2}': {"b": "1", "id": "x", "a": "2"},
        "not json": "not json", "": None, "{}": None,
    }
    lines = spark.createDataFrame([(k,) for k in cases], "value string")
    got = {r.line: r for r in rescue_json(lines.withColumn("line", F.col("value")), SCHEMA).collect()}
    for line, want in cases.items():
        rescued = got[line]._rescued_data
        assert (rescued if not isinstance(want, dict) else json.loads(rescued)) == want, line
    first = list(cases)[0]
    assert got[first].at.x == 1.5 and got[first].points[0].x == 2.0 and got[first].deep["in"].n == 3
    # the order of the line is kept
    assert list(json.loads(got['{"b": 1, "id": "x", "a": 2}']._rescued_data)) == ["b", "id", "a"]


def test_a_repeated_key(spark):
    lines = spark.createDataFrame([('{"u": 1, "u": 2}',)], "value string")
    assert json.loads(rescue_json(lines, SCHEMA).first()._rescued_data) in ({"u": "1"}, {"u": "2"})
