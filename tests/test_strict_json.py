"""Undeclared keys at every depth of a body."""

import json

import pytest
from pyspark.sql import types as T

from docmart.operators.strict_json import NOT_AN_OBJECT, declared_keys, unknown_keys
from docmart.schemas import film_document_schema

REF = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("title", T.StringType()), T.StructField("maker", REF),
    T.StructField("actors", T.ArrayType(REF)), T.StructField("grid", T.ArrayType(T.ArrayType(REF)))])

GOOD = {"id": 1, "title": "t", "maker": {"id": "m", "name": None}, "actors": [{"id": "a", "name": "n"}, {}], "grid": [[{"id": "x"}], []]}
CASES = {
    "good": (json.dumps(GOOD), set()),
    "empty": ("{}", set()),
    "top": (json.dumps({**GOOD, "extra": 1, "more": {"id": 1, "deep": 2}}), {"extra", "more"}),
    "object": (json.dumps({**GOOD, "maker": {"id": 1, "born": 2}}), {"maker.born"}),
    "element": (json.dumps({**GOOD, "actors": [{"id": 1}, {"id": 2, "role": "x"}, {"role": "y", "age": 1}]}), {"actors.role", "actors.age"}),
    "list in list": (json.dumps({**GOOD, "grid": [[{"id": 1}], [{"odd": 1}]]}), {"grid.odd"}),
    "scalar for object": (json.dumps({**GOOD, "maker": 5, "actors": None}), set()),
    "object for scalar": (json.dumps({**GOOD, "title": {"any": 1}}), set()),
    "not json": ("{not json", {NOT_AN_OBJECT}),
    "list": ("[1, 2]", {NOT_AN_OBJECT}),
    "number": ("7", {NOT_AN_OBJECT}),
    "null": (None, set()),
    "json null": ("null", {NOT_AN_OBJECT}),
    "dotted": (json.dumps({"maker.id": 1, "maker.born": 2}), {"maker.born"}),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(k, b, "clash", "clash") for k, (b, _) in CASES.items()]
    df = spark.createDataFrame(rows, "key string, body string, value string, path string").repartition(3)
    out = {k: set() for k in CASES}
    for r in unknown_keys(df, "key", "body", SCHEMA).collect():
        out[r[0]].add(r["path"])
    return out


@pytest.mark.parametrize("case", CASES)
def test_unknown_keys(found, case):
    assert found[case] == CASES[case][1]


def test_no_bodies(spark):
    assert unknown_keys(spark.createDataFrame([], "id int, body string"), "id", "body", SCHEMA).count() == 0


def test_declared_keys_of_the_film_document():
    declared = declared_keys(film_document_schema())
    assert declared["actors"] == ["id", "name"] and "actors_names" in declared[""] and set(declared) == {
        "", "actors", "writers", "directors", "genres"}
