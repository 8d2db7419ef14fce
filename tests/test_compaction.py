"""Sinks that fold: the rows before, during and after, and the number of folders."""

import pytest

from kinelab.streaming import compaction as c
from kinelab.streaming import jobs

SCHEMA = "batch long, v long"


def frame(spark, b, n=3):
    return spark.range(n).selectExpr(f"{b}L as batch", "id as v").coalesce(1)


def rows(spark, path):
    return sorted(map(tuple, c.read_batches(spark, path, SCHEMA).collect()))


@pytest.mark.parametrize("fan", [2, 3])
def test_every_batch_once_and_few_folders(spark, scratch, fan):
    path = scratch("sink")
    write, want = c.compacting_writer(path, fan=fan, grace_s=0), []
    for b in range(14):
        write(frame(spark, b), b)
        want += [(b, v) for v in range(3)]
        assert rows(spark, path) == want
        if b % 5 == 4:  # the newest batch comes again, after a restart, with other rows
            write(frame(spark, b, 2), b)
            want.pop()
            assert rows(spark, path) == want
    found = c.parts(spark, path)
    assert len(found) == len(c.current(found)) <= fan * 4
    write(frame(spark, 0, 9), 0)  # a batch that is folded already is not written again
    assert rows(spark, path) == want


def test_a_reader_during_the_fold(spark, scratch):
    path = scratch("sink")
    for b in range(5):
        frame(spark, b).write.parquet(f"{path}/batch_id={b}")
    want = rows(spark, path)
    planned = c.read_batches(spark, path, SCHEMA)  # planned before, read after
    frame(spark, 99).write.parquet(f"{path}/segments/from=0-to=3")
    marker = c._Folder(spark, f"{path}/segments/from=0-to=3")
    marker.delete("_SUCCESS")  # a segment that is still being written
    assert rows(spark, path) == want
    c.fold(spark, path, SCHEMA, fan=2)
    c.clean(spark, path)  # within the grace: nothing goes
    assert rows(spark, path) == want == sorted(map(tuple, planned.collect()))
    assert len(c.parts(spark, path)) > len(c.current(c.parts(spark, path)))
    c.clean(spark, path, grace_s=0)
    assert rows(spark, path) == want and len(c.parts(spark, path)) == len(c.current(c.parts(spark, path)))


def test_a_batch_that_has_not_ended_is_not_read(spark, scratch):
    path = scratch("sink")
    for b in range(2):
        frame(spark, b).write.parquet(f"{path}/batch_id={b}")
    c._Folder(spark, f"{path}/batch_id=1").delete("_SUCCESS")
    assert rows(spark, path) == [(0, v) for v in range(3)]
    assert c.read_batches(spark, scratch("none"), SCHEMA).count() == 0


def test_old_versions_go(spark, scratch):
    path = scratch("versions")
    write = jobs.version_writer(path)
    for b in range(5):
        write(frame(spark, b), b)
    c._Folder(spark, f"{path}/version=4").delete("_SUCCESS")
    c.clean_versions(spark, path)
    assert sorted(c._Folder(spark, path).names()) == ["version=2", "version=3", "version=4"]
    assert {r["batch"] for r in jobs.newest_version(spark, path).collect()} == {3}
