"""JSON artifacts, counts from footers, and records held against events."""

import json

import pytest

from rootline.operators import reconcile
from rootline.sources import artifacts


def test_tables_round_trip_as_json(spark, tmp_path):
    schema = "id long, name string, tags array<string>, at struct<x:double,y:map<string,int>>, none string"
    rows = [(1, "a\n\u00e4", ["x", None], (1.5, {"k": 2}), None), (2, None, None, None, None), (3, "", [], (None, {}), None)]
    df = spark.createDataFrame(rows, schema)
    artifacts.write(df, str(tmp_path / "t"))
    back = artifacts.typed(artifacts.read(spark, str(tmp_path / "t")), schema)
    assert back.dtypes == df.dtypes and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    other = artifacts.typed(artifacts.read(spark, str(tmp_path / "t")), "name long, id string").collect()
    assert sorted((r.name, r.id) for r in other if r.name is None) == [(None, "1"), (None, "2"), (None, "3")]


def test_files_of_one_value(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"c1": {"size": 3, "of": [1, {"x": None}]}, "c2": {"size": "many"}}, indent=2))
    (tmp_path / "b.json").write_text("[1, \"two\"]")
    found = artifacts.read_files(spark, str(tmp_path))
    got = {(r.name, r.pos, r.key): json.loads(r.value.toJson()) for r in artifacts.parts(found).collect()}
    assert got == {("a.json", 0, "c1"): {"size": 3, "of": [1, {"x": None}]}, ("a.json", 1, "c2"): {"size": "many"}, ("b.json", 0, None): 1, ("b.json", 1, None): "two"}
    (tmp_path / "c.json").write_text("{broken")
    with pytest.raises(Exception):
        artifacts.read_files(spark, str(tmp_path)).collect()
    assert {r.name: r.data is None for r in artifacts.read_files(spark, str(tmp_path), strict=False).collect()} == {"a.json": False, "b.json": False, "c.json": True}


def test_rows_counted_without_reading_them(spark, tmp_path):
    spark.range(1234).repartition(3).write.parquet(str(tmp_path / "t.parquet"))
    plan = artifacts.counted(spark, str(tmp_path / "t.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "COUNT(*)" in plan.split("PushedAggregation")[1][:40] and "ReadSchema" not in plan.replace("ReadSchema: struct<count(*)", "")
    assert artifacts.count_rows(spark, str(tmp_path / "t.parquet")) == 1234
    (tmp_path / "e.jsonl").write_text('{"a": 1}\n\n  \n{"a": 2}\n')
    assert artifacts.count_rows(spark, str(tmp_path / "e.jsonl")) == 2


def test_lost_doubled_and_changed_records_are_found(spark):
    rows = [("a", "x"), ("a", "y"), ("a", "y"), ("b", "z"), ("c", "lost"), ("d", "1"), ("d", "2"), ("e", None)]
    told = [("a", "y"), ("a", "x"), ("a", "y"), ("b", "z"), ("b", "z"), ("d", "2"), ("d", "3"), ("e", None), ("f", "new")]
    a, b = (spark.createDataFrame(x, "source_file string, raw string").repartition(3) for x in (rows, told))
    assert {r.source_file: (r.n_records, r.n_events, r.same) for r in reconcile.compared(a, b).collect()} == {"a": (3, 3, True), "b": (1, 2, False), "c": (1, 0, False), "d": (2, 2, False), "e": (1, 1, True), "f": (0, 1, False)}
    assert sorted(tuple(r) for r in reconcile.differences(a, b).collect()) == [("b", "z", 1, 2), ("c", "lost", 1, 0), ("d", "1", 1, 0), ("d", "3", 0, 1), ("f", "new", 0, 1)]
