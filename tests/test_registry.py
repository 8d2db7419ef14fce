import datetime as dt

import pytest

from kinelab.operators import registry

SCHEMA = "run_id string, run_name string, end_time timestamp"
T1 = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2024, 2, 1)


def reg(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_no_run_is_an_error(spark):
    with pytest.raises(RuntimeError):
        registry.get_latest_run_id(reg(spark, []), "x")


def test_multiple_unfinished_is_an_error(spark):
    with pytest.raises(RuntimeError):
        registry.get_latest_run_id(reg(spark, [("a", "x", None), ("b", "x", None)]), "x")


def test_unfinished_wins_then_latest_end(spark):
    r = reg(spark, [("a", "x", T2), ("b", "x", None), ("c", "y", T1), ("d", "y", T2), ("e", "z", T1)])
    assert registry.get_latest_run_id(r, "x") == "b"
    assert registry.get_latest_run_id(r, "y") == "d"
    got = {row.run_name: (row.run_id, row.status) for row in registry.latest_run_status(r).collect()}
    assert got == {"x": ("b", "unfinished"), "y": ("d", "finished"), "z": ("e", "finished")}
    newest = {row.run_name: row.run_id for row in registry.newest_run(r).collect()}
    assert newest == {"x": "b", "y": "d", "z": "e"}


def test_create_if_absent(spark):
    r = reg(spark, [("a", "x", T1)])
    wanted = spark.createDataFrame([("x",), ("new",)], "run_name string")
    rows = registry.create_if_absent(r, wanted).collect()
    assert [(row.run_name, row.end_time) for row in rows] == [("new", None)]


def test_last_end_time(spark):
    r = reg(spark, [("a", "x", T1), ("b", "x", T2), ("c", "y", None)])
    got = {row.run_name: row.last_end_s for row in registry.last_end_time(r).collect()}
    assert got == {"x": int(T2.replace(tzinfo=dt.timezone.utc).timestamp()), "y": None}
