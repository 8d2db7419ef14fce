import math

from pyspark.sql import functions as F

from kinelab import schemas
from kinelab.operators.sampling import sample_rows
from kinelab.plans.labelling import StagePaths, labelled_windows, run_pipeline, write_labelled
from kinelab.sources import tables as tb
from kinelab.sources import telemetry as tel
from kinelab.sources.parquet_io import read_stage

SF = "/root/testdata/sf0.001"


def test_sample_full_adds_no_node(spark):
    df = spark.read.parquet(f"{SF}/events.parquet").where("event_type = 'purchase'")
    assert sample_rows(df, 1.0) is df
    s = sample_rows(df, 0.5, keys=["event_id"])
    a = sorted(r.event_id for r in s.collect())
    b = sorted(r.event_id for r in sample_rows(df.repartition(7), 0.5, keys=["event_id"]).collect())
    assert a == b and 0 < len(a) < df.count()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in \
        s._jdf.queryExecution().executedPlan().toString()


def test_request_parsing_ignores_extra_fields(spark):
    lines = spark.createDataFrame(
        [('{"time": 1000, "x": 1.0, "y": 2.0, "z": 3.0, "energy": 0, "magnitude": 0, "TAC_Reading": 0.2}',)],
        "value string")
    r = tel.parse_requests(lines).collect()[0]
    assert (r.time, r.x, r.y, r.z) == (1000, 1.0, 2.0, 3.0)


def test_full_stage_chain(spark, scratch):
    root = scratch("m9")
    paths = StagePaths(*(f"{root}/{n}" for n in ("labelled", "pre", "feat", "state", "model", "scores")))
    lab = labelled_windows(tb.sensor_events(spark, SF), tb.readings_events(spark, SF), 86400)
    write_labelled(lab, paths.labelled)
    out = run_pipeline(spark, paths, forest={"num_trees": 5, "max_depth": 3})
    feats = read_stage(spark, paths.features)
    assert feats.count() == lab.count()
    state = tel.load_state(spark, paths.state).collect()[0]
    want = feats.agg(F.avg("energy"), F.stddev_samp("magnitude")).collect()[0]
    assert math.isclose(state.energy.mean, want[0]) and math.isclose(state.magnitude.std, want[1])
    scores = read_stage(spark, paths.scores)
    assert scores.count() == 5 * 2 * 4
    assert out["model"].stages[-1].getNumTrees == 5


def test_stream_error_windows_equal_batch(spark, scratch):
    from kinelab.operators import opsmetrics
    from kinelab.streaming import jobs
    root = scratch("st6")
    http = tb.http_from_events(jobs.table_stream(spark, SF, "events"))
    jobs.run_available(jobs.error_windows(http, 3600, "0 seconds"), f"{root}/out", f"{root}/ck")
    streamed = {(r.instance, r.window_start_s): r.errors for r in spark.read.parquet(f"{root}/out").collect()}
    batch = {(r.instance, r.window_start_s): r.errors
             for r in opsmetrics.error_rate(tb.http_log(spark, SF), 3600).collect()}
    assert streamed and all(batch[k] == v for k, v in streamed.items())
    # The watermark follows all responses (not only errors): exactly the
    # error windows ending at or before the newest event are closed.
    newest = spark.read.parquet(f"{SF}/events.parquet").agg(
        F.max(F.unix_seconds(F.col("ts").cast("timestamp")))).first()[0]
    assert set(streamed) == {k for k in batch if k[1] + 3600 <= newest}
