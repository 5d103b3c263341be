import json

import pytest
from pyspark.sql import functions as F

from checks import compare
from loanshift.llm import tool_calls
from loanshift.llm.queries import QUERIES, SQL

CALL = "conv_id long, turn long, call_id string, name string, arguments string, after array<string>, extra string"
RESULT = "conv_id long, turn long, call_id string, content string"
SCHEMAS = {"f": {"x": ("integer", True), "y": ("number", False), "z": ("array", False)}, "g": {}}


def run(spark, calls, results):
    calls = spark.createDataFrame([(*c, "e") for c in calls], CALL)
    found = tool_calls.linked(calls, spark.createDataFrame(results, RESULT), SCHEMAS).collect()
    return {(r.conv_id, r.call_id): r for r in found}, found


def test_links_levels_and_faults(spark):
    calls = [
        (1, 0, "a", "f", '{"z": [1, {"b": 2, "a": 1}], "x": 1}', []),
        (1, 2, "b", "f", '{"x": "1", "y": 2}', ["a", "a"]),
        (1, 4, "c", "f", '{"y": 2.5, "x": 3, "w": null}', ["b", "a"]),
        (1, 6, "d", "g", "{}", ["e"]), (1, 8, "e", "g", "{}", ["d"]), (1, 10, "f", "g", "{}", ["e", "a"]),
        (1, 12, "s", "g", "{}", ["s"]), (1, 14, "u", "g", "{}", ["nowhere", None, "c"]),
        (2, 0, "a", "h", "[1]", None), (2, 2, "a", "g", None, ["a"]), (2, 3, "b", "f", "{", None), (2, 4, "k", "f", '{"y": true}', None),
        (None, 1, "a", "g", "{}", None), (1, 16, None, "g", '{"q": 1}', ["a"]),
    ]
    results = [(1, 3, "b", "late"), (1, 1, "a", 'quote " and\nline é'), (1, 2, "b", "first"), (3, 1, "a", "x"), (1, 9, None, "y"), (2, 9, "b", None)]
    by_id, found = run(spark, calls, results)
    assert len(found) == 13
    assert [by_id[1, k].level for k in "abcdefsu"] == [0, 1, 2, None, None, None, None, 3]
    assert {k: by_id[1, k].faults for k in "abcdefsu"} == {
        "a": [], "b": ["type:x"], "c": ["unknown:w"], "d": ["cycle"], "e": ["cycle"], "f": ["cycle"], "s": ["cycle"], "u": ["unknown_after"],
    }
    assert by_id[2, "a"].faults == ["no_object", "repeated_id"] and by_id[2, "a"].turn == 0
    assert by_id[2, "b"].faults == ["no_object"] and by_id[2, "b"].n_results == 1
    assert by_id[2, "k"].faults == ["missing:x", "type:y"]
    assert by_id[None, "a"].faults == ["no_id"] and by_id[1, None].faults == ["unknown:q", "no_id"]
    assert (by_id[1, "b"].result_turn, by_id[1, "b"].n_results) == (2, 2)
    expected = {"arguments": {"x": 1, "z": [1, {"a": 1, "b": 2}]}, "call_id": "a", "name": "f", "result": 'quote " and\nline é'}
    assert by_id[1, "a"].message == json.dumps(expected, ensure_ascii=False, separators=(",", ":"))
    assert by_id[2, "b"].message == '{"arguments":null,"call_id":"b","name":"f","result":null}'


def test_a_long_chain_and_its_order(spark):
    calls = [(1, 2 * k, f"c{k}", "g", "{}", [f"c{k + 1}"] if k < 12 else None) for k in range(13)]
    by_id, _ = run(spark, calls, [(1, 1, "c0", "x")])
    assert [by_id[1, f"c{k}"].level for k in range(13)] == list(reversed(range(13)))


def test_empty_tables_and_orphans(spark):
    calls, results = spark.createDataFrame([], CALL), spark.createDataFrame([(1, 1, "a", "x"), (1, 1, None, "y")], RESULT)
    assert tool_calls.linked(calls, results, SCHEMAS).count() == 0
    assert tool_calls.orphans(calls, results).count() == 2
    one = spark.createDataFrame([(1, 0, "a", "g", "{}", None, "e")], CALL)
    assert tool_calls.linked(one, results.where(F.lit(False)), SCHEMAS).first().n_results == 0
    assert [r.content for r in tool_calls.orphans(one, results).collect()] == ["y"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, sf, name):
    assert compare.compare(spark, compare.connect(sf), name, QUERIES[name], SQL[name], sf) == ""
