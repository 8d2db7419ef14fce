"""Registered queries over the driver's tables, and their DuckDB oracle SQL.

Each query reads whole tables (bindings in ``kinelab.sources.tables``).
Doubles are rounded to 6 decimals on both sides, integers are BIGINT,
times are epoch numbers (no timestamp types cross the comparison).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelab import config as C
from kinelab.operators import counters, drift, features, folds, merged_state, opsmetrics, registry
from kinelab.operators.asof import asof_join
from kinelab.operators.model import binary_metrics
from kinelab.operators.sampling import sample_rows
from kinelab.operators.windows import tumbling_mean
from kinelab.plans.labelling import labelled_windows, read_labelled, write_labelled
from kinelab.session import scratch_path
from kinelab.sources import csv as csvsrc
from kinelab.sources import tables as tb
from kinelab.sources import telemetry as tel
from kinelab.sources.column_json import parse_column_documents, write_column_document
from kinelab.sources.parquet_io import read_partitioned, read_stage, write_partitioned
from kinelab import schemas

DAY = 86_400
MONTH = 30 * DAY
HOUR = 3_600


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _windows_out(df: DataFrame) -> DataFrame:
    return df.select(C.KEY, C.WINDOW_START, r6("x").alias("x"), r6("y").alias("y"), r6("z").alias("z"))


def _asof_out(df: DataFrame) -> DataFrame:
    return df.select(C.KEY, C.WINDOW_START, r6("x").alias("x"), r6("y").alias("y"),
                     r6("z").alias("z"), r6(C.READING).alias(C.READING))


# --------------------------------------------------------------------- A1
def q_a1_events(spark, d):
    return _windows_out(tumbling_mean(tb.sensor_events(spark, d), DAY))


def q_a1_lineitem(spark, d):
    return _windows_out(tumbling_mean(tb.sensor_lineitem(spark, d), MONTH))


# --------------------------------------------------------------------- J1
def _j1_events(plan):
    def q(spark, d):
        w = tumbling_mean(tb.sensor_events(spark, d), DAY)
        j = asof_join(w, tb.readings_events(spark, d), C.KEY, C.WINDOW_START, C.READING_TIME,
                      [C.READING], tiebreak="tiebreak", plan=plan)
        return _asof_out(j)
    return q


def _j1_orders(plan):
    def q(spark, d):
        w = tumbling_mean(tb.sensor_lineitem_by_customer(spark, d), MONTH)
        j = asof_join(w, tb.readings_orders(spark, d), C.KEY, C.WINDOW_START, C.READING_TIME,
                      [C.READING], tiebreak="tiebreak", plan=plan)
        return _asof_out(j)
    return q


# --------------------------------------------------------------- E1 / M1
def _labelled_events(spark, d, plan="auto", materialize=None):
    return labelled_windows(tb.sensor_events(spark, d), tb.readings_events(spark, d), DAY, plan=plan,
                            materialize=materialize)


def _labelled_out(df):
    return df.select("time", r6("x").alias("x"), r6("y").alias("y"), r6("z").alias("z"),
                     r6(C.READING).alias(C.READING), C.KEY)


def q_e1_labelled_roundtrip(spark, d):
    """E1 end to end: A1 -> J1 -> P6 -> S3 (clustered write) -> S4 (read)."""
    path = scratch_path(spark, "labelled")
    # The window table is written first: the range partitioner of the
    # partitioned write samples its input, and that pass then re-reads a
    # small table instead of re-aggregating the raw samples.
    write_labelled(_labelled_events(spark, d, materialize=True), path)
    return _labelled_out(read_labelled(spark, path))


def q_s3_key_folders(spark, d):
    """S3 and S4 in the layout of one folder per key."""
    path = scratch_path(spark, "labelled_folders")
    write_partitioned(_labelled_events(spark, d, materialize=True), path)
    return _labelled_out(read_partitioned(spark, path, schemas.LABELLED))


def q_s4_rewritten_day(spark, d):
    """One day of the labelled table written again with x + 1: the other days stay."""
    path = scratch_path(spark, "labelled_days")
    write_labelled(_labelled_events(spark, d, materialize=True), path)
    first = read_labelled(spark, path).agg(F.min("time")).first()[0]
    if first is not None:
        day = read_labelled(spark, path).where((F.col("time") >= first // DAY * DAY) & (F.col("time") < (first // DAY + 1) * DAY))
        again = scratch_path(spark, "labelled_day")
        day.withColumn("x", F.col("x") + 1).withColumn(C.KEY, F.col(C.KEY).cast("long")).write.parquet(again)
        write_labelled(spark.read.parquet(again), path)
    return _labelled_out(read_labelled(spark, path))


def q_r1_sample_full(spark, d):
    return _labelled_out(sample_rows(_labelled_events(spark, d), C.SAMPLE_RATE, C.SEED))


def _features_out(df):
    return df.select("time", r6("x").alias("x"), r6("y").alias("y"), r6("z").alias("z"),
                     r6(C.READING).alias(C.READING), C.KEY, r6("energy").alias("energy"),
                     r6("magnitude").alias("magnitude"), C.LABEL)


def q_m1_training_features(spark, d):
    return _features_out(features.training_features(_labelled_events(spark, d)))


def q_m9_pipeline_stages(spark, d):
    """M9 preprocess + features stages through stage tables (S5), then read back."""
    from kinelab.plans.labelling import StagePaths, run_pipeline
    root = scratch_path(spark, "stages")
    paths = StagePaths(*(f"{root}/{n}" for n in ("labelled", "pre", "feat", "state", "model", "scores")))
    write_labelled(_labelled_events(spark, d, materialize=True), paths.labelled)
    run_pipeline(spark, paths, stages=("preprocess", "features"))
    return _features_out(read_stage(spark, paths.features).withColumn(C.KEY, F.col(C.KEY)))


def _stats_out(state):
    return state.select(F.round("energy.mean", 4).alias("energy_mean"),
                        F.round("energy.std", 4).alias("energy_std"),
                        F.round("magnitude.mean", 6).alias("magnitude_mean"),
                        F.round("magnitude.std", 6).alias("magnitude_std"))


def q_a2_fitted_stats(spark, d):
    _, state = features.fit(_labelled_events(spark, d))
    return _stats_out(state)


def q_s10_state_roundtrip(spark, d):
    _, state = features.fit(_labelled_events(spark, d))
    path = scratch_path(spark, "state")
    tel.save_state(state, path)
    return _stats_out(tel.load_state(spark, path))


def q_a3_class_counts(spark, d):
    feats = features.training_features(_labelled_events(spark, d))
    return drift.class_counts(feats).select("target", "category", F.col("cnt").cast("bigint"))


def _merged_state(spark, d) -> DataFrame:
    """Batch states of the labelled features, one batch written with half of its rows first and then replaced."""
    path = scratch_path(spark, "batch_states")
    feats = features.training_features(_labelled_events(spark, d, materialize=True))
    stage = scratch_path(spark, "batch_features")
    feats.withColumn("batch", F.pmod(F.xxhash64(C.KEY), F.lit(7))).write.partitionBy("batch").parquet(stage)
    feats = spark.read.parquet(stage)
    merged_state.write_batch_state(feats.where((F.col("batch") == 3) & (F.col("time") % 2 == 0)), path, 3)
    for b in range(7):
        merged_state.write_batch_state(feats.where(F.col("batch") == b), path, b)
    return merged_state.merged(merged_state.read_batch_states(spark, path))


def q_a2_merged_stats(spark, d):
    return _stats_out(merged_state.fitted(_merged_state(spark, d)))


def q_a3_merged_counts(spark, d):
    return merged_state.counts(_merged_state(spark, d)).select("target", "category", F.col("cnt").cast("bigint"))


def q_s6_s7_class_distribution(spark, d):
    feats = features.training_features(_labelled_events(spark, d))
    path = scratch_path(spark, "classdist")
    tel.write_class_distribution(drift.class_counts(feats), path)
    return tel.read_class_distribution(spark, path).select(
        "target", "category", F.col("cnt").cast("bigint"))


# ----------------------------------------------------------- scoring (M2)
def _requests(spark, d):
    s = tb.sensor_events(spark, d)
    rows = s.select(F.col(C.TIME_MS).alias("time"), "x", "y", "z",
                    F.lit(0.0).alias("energy"), F.lit(0.0).alias("magnitude"))
    return tel.requests_as_json(rows)


def q_s9_request_features(spark, d):
    """S9 + F9 + M2 + P7: JSON requests -> typed rows -> scoring features in model order."""
    req = tel.parse_requests(_requests(spark, d))
    f = features.scoring_features(req)
    return f.select("time", "x", "y", "z", r6("energy").alias("energy"), r6("magnitude").alias("magnitude"))


# ----------------------------------------------------------------- drift
def _median_split_us(log: DataFrame) -> int:
    """Median event time in micros (quantile_disc: exact, bounded memory)."""
    return drift.quantile_disc(log.select(F.unix_micros(F.col("ts")).alias("us")), "us", 0.5)


def _reference_counts(spark, d):
    log = tb.scored_log(spark, d)
    m = _median_split_us(log)
    return drift.class_counts(log.where(F.unix_micros(F.col("ts")) < F.lit(m)))


def q_t3_latest_n(spark, d):
    return drift.latest_n(tb.scored_log(spark, d), C.LIVE_ROWS).select("timestamp", C.LABEL, "event_id")


def q_a4_live_shares(spark, d):
    latest = drift.latest_n(tb.scored_log(spark, d), C.LIVE_ROWS)
    return drift.live_shares(latest).select("target", "category", r6("q").alias("q"))


def q_a5_psi(spark, d):
    latest = drift.latest_n(tb.scored_log(spark, d), C.LIVE_ROWS)
    return drift.psi(_reference_counts(spark, d), latest).select("target", r6("psi").alias("psi"))


def q_s8_column_log(spark, d):
    """Scored log -> column-oriented JSON documents -> rows again."""
    path = scratch_path(spark, "columnlog")
    tel.write_column_log(tb.scored_log(spark, d), path)
    return tel.read_column_log(spark, path)


def q_s8_single_document(spark, d):
    """The whole scored log as one document, read back by many tasks (one for each 64 KiB)."""
    path = scratch_path(spark, "columndoc")
    write_column_document(tb.scored_log(spark, d), path, "event_id")
    return parse_column_documents(spark, path, split_bytes=64 << 10).rows


# ----------------------------------------------------------------- folds
def q_w2_stratified_folds(spark, d):
    s = tb.sensor_events(spark, d).withColumn(
        C.LABEL, (F.col("x") / F.lit(500.0)) >= F.lit(C.LABEL_THRESHOLD))
    f = folds.stratified_folds(s, C.LABEL, C.KEY, C.TIME_MS, tiebreak=("event_id",),
                               time_per_s=1000.0)
    return f.select(C.KEY, C.TIME_MS, "event_id", C.LABEL, "fold")


def q_w2_null_key(spark, d):
    """Every seventh row without a key: such rows get a fold like any other."""
    s = (tb.sensor_events(spark, d).withColumn(C.KEY, F.when(F.col("event_id") % 7 != 0, F.col(C.KEY)))
         .withColumn(C.LABEL, (F.col("x") / F.lit(500.0)) >= F.lit(C.LABEL_THRESHOLD)))
    f = folds.stratified_folds(s, C.LABEL, C.KEY, C.TIME_MS, tiebreak=("event_id",), time_per_s=1000.0)
    return f.select(C.KEY, C.TIME_MS, "event_id", C.LABEL, "fold")


def q_a8_binary_metrics(spark, d):
    m = binary_metrics(tb.truth_and_prediction(spark, d), "y_true", "y_pred")
    return m.select(*[F.col(c).cast("bigint") for c in ("tp", "fp", "fn", "tn")],
                    *[r6(c).alias(c) for c in C.SCORE_METRICS])


# -------------------------------------------------------------- registry
def q_t5_latest_run(spark, d):
    return registry.latest_run_status(tb.run_registry(spark, d))


def q_w3_newest_run(spark, d):
    n = registry.newest_run(tb.run_registry(spark, d))
    return n.select("run_name", "run_id", F.unix_seconds("end_time").alias("end_s"))


def q_t6_create_if_absent(spark, d):
    wanted = tb.table(spark, d, "customer").select(F.col("c_custkey").alias("run_name"))
    return registry.create_if_absent(tb.run_registry(spark, d), wanted).select("run_id", "run_name")


def q_t6_absent_and_repeated(spark, d):
    """Names that the registry has, names it lacks, and names asked for twice: one new run per absent name."""
    have = tb.table(spark, d, "orders").select(F.col("o_custkey").alias("run_name"))
    lack = tb.table(spark, d, "customer").select((-F.col("c_custkey") - 1).alias("run_name"))
    wanted = have.unionByName(lack).unionByName(lack)
    return registry.create_if_absent(tb.run_registry(spark, d), wanted).select("run_id", "run_name")


def q_p11_unfinished(spark, d):
    return registry.unfinished(tb.run_registry(spark, d)).select("run_id", "run_name")


def q_a14_last_end(spark, d):
    return registry.last_end_time(tb.run_registry(spark, d))


# ------------------------------------------------------------ ops metrics
def q_a9_prediction_counts(spark, d):
    return opsmetrics.prediction_counts(tb.scored_log(spark, d))


def q_a10_latency_histogram(spark, d):
    return opsmetrics.latency_histogram(tb.scored_log(spark, d))


def q_a10_latency_summary(spark, d):
    s = opsmetrics.latency_summary(tb.scored_log(spark, d))
    return s.select(r6("sum_s").alias("sum_s"), "count")


def q_a11_reload_count(spark, d):
    return opsmetrics.count_kind(tb.scored_log(spark, d), "signup")


def _rates(spark, d):
    return opsmetrics.error_rate(tb.http_log(spark, d), window_s=HOUR)


def q_a12_error_rate(spark, d):
    r = _rates(spark, d)
    return r.select("job", "instance", "window_start_s", "errors", r6("rate").alias("rate"))


SCRAPE, STEP = 900, 600


def counter_samples(spark, d) -> DataFrame:
    """Counters of the HTTP log: scraped every 15 minutes, some scrapes missed, restarted every 97 scrapes."""
    http = tb.http_log(spark, d).withColumn("i", F.floor((F.unix_seconds("ts") - F.col("instance").cast("long") * 7) / SCRAPE) + 1)
    counts = http.groupBy("job", "instance", "code", "i").agg(F.count(F.lit(1)).alias("n"))
    span = counts.agg(F.min("i"), F.max("i")).first()
    if span[0] is None:
        span = (0, 0)
    grid = counts.select("job", "instance", "code").distinct().withColumn("i", F.explode(F.sequence(F.lit(span[0]), F.lit(span[1] + 3))))
    life = F.floor((F.col("i") - 13 - 5 * F.col("instance").cast("long")) / 97)
    upto = Window.partitionBy("job", "instance", "code", "life").orderBy("i")
    return (grid.join(counts, ["job", "instance", "code", "i"], "left").withColumn("life", life)
            .withColumn("value", F.sum(F.coalesce("n", F.lit(0))).over(upto).cast("double"))
            .where(F.pmod("i", F.lit(31)) != 7)
            .select("job", "instance", "code", (F.col("i") * SCRAPE + F.col("instance").cast("long") * 7).alias("at_s"), "value"))


def q_a12_counter_rates(spark, d):
    """Rates of every series at every evaluation time."""
    return counters.rates(counter_samples(spark, d), HOUR, STEP).select("job", "instance", "code", "t_s", "n", r6("rate").alias("rate"))


def q_a12_counter_error_rates(spark, d):
    return counters.error_rates(counter_samples(spark, d), HOUR, STEP).select("job", "instance", "window_start_s", r6("rate").alias("rate"))


def q_a13_counter_alert(spark, d):
    """A13 over evaluation times: the condition held for half an hour."""
    return opsmetrics.sustained(counters.error_rates(counter_samples(spark, d), HOUR, STEP), STEP, 1800)


def q_a13_sustained(spark, d):
    return opsmetrics.sustained(_rates(spark, d), HOUR, HOUR)


def q_s12_metrics_table(spark, d):
    """Metric rows appended to a metrics table and read back."""
    path = scratch_path(spark, "metrics")
    scored = tb.scored_log(spark, d)
    tel.append_metrics(tel.metric_rows(opsmetrics.prediction_counts(scored), "predictions", "cnt",
                                       "pred", "pred"), path, "predictions")
    tel.append_metrics(tel.metric_rows(opsmetrics.latency_summary(scored), "request_count", "count"),
                       path, "latency")
    return tel.read_metrics(spark, path).select("metric", "label_key", "label_value", r6("value").alias("value"))


def _two_targets(spark, d):
    return tb.scored_log(spark, d).withColumn("is_slow", F.col("latency_s") > F.lit(5.0))


def _psi_two_targets(spark, d):
    targets = (C.LABEL, "is_slow")
    log = _two_targets(spark, d)
    m = _median_split_us(log)
    counts = drift.class_counts(log.where(F.unix_micros(F.col("ts")) < F.lit(m)), targets)
    return drift.psi(counts, drift.latest_n(log, C.LIVE_ROWS), targets)


def q_a6_psi_two_targets(spark, d):
    return _psi_two_targets(spark, d).select("target", r6("psi").alias("psi"))


def q_s12_psi_metrics(spark, d):
    """PSI per target as rows of the metrics table; a second write of the run replaces the first."""
    path = scratch_path(spark, "psi_metrics")
    rows = tel.metric_rows(_psi_two_targets(spark, d), "psi", "psi", "target", "target")
    for _ in range(2):
        tel.append_metrics(rows, path, "drift")
    return tel.read_metrics(spark, path).select("metric", "label_key", "label_value", r6("value").alias("value"))


def q_t4_live_guard(spark, d):
    """Live shares of the newest rows: none while there are fewer than asked for."""
    log = tb.scored_log(spark, d)
    short = drift.latest_n(drift.latest_n(log, C.LIVE_ROWS - 1), C.LIVE_ROWS)
    full = drift.latest_n(log, C.LIVE_ROWS)
    parts = [drift.live_shares(x).select(F.lit(n).alias("log"), "target", "category", r6("q").alias("q"))
             for n, x in (("short", short), ("full", full))]
    return parts[0].unionByName(parts[1])


def q_p4_p5_training_columns(spark, d):
    """P4 + P5: features in model order and the label; key and raw reading are gone."""
    xy = features.split_xy(features.training_features(_labelled_events(spark, d)))
    return xy.select("time", *[r6(c).alias(c) for c in ("x", "y", "z", "energy", "magnitude")], C.LABEL)


def q_f6_reading_datetime(spark, d):
    r = csvsrc.readings_with_datetime(tb.readings_events(spark, d))
    return r.select(C.KEY, C.READING_TIME, F.date_format("reading_ts", "yyyy-MM-dd HH:mm:ss").alias("reading_at"))


def q_r1_sample_half(spark, d):
    """R1 below 1.0: half of the windows, by a hash of their key and time."""
    return _labelled_out(sample_rows(_labelled_events(spark, d), 0.5, C.SEED, keys=[C.KEY, "time"]))


def _j1_fractional(plan):
    """BIGINT times on the left, readings half a second later: none may attach to its own second."""
    def q(spark, d):
        r = tb.readings_events(spark, d)
        left = r.select(C.KEY, F.col(C.READING_TIME).alias(C.WINDOW_START)).distinct()
        late = r.withColumn(C.READING_TIME, F.col(C.READING_TIME) + F.lit(0.5))
        j = asof_join(left, late, C.KEY, C.WINDOW_START, C.READING_TIME, [C.READING], tiebreak="tiebreak", plan=plan)
        return j.select(C.KEY, C.WINDOW_START, r6(C.READING).alias(C.READING))
    return q


# ------------------------------------------------------------ T1, U2
def q_t1_sorted_readings(spark, d):
    from kinelab.operators.windows import sort_readings
    r = tb.readings_events(spark, d).select(C.KEY, C.READING_TIME, r6(C.READING).alias(C.READING))
    return sort_readings(r)


def q_u2_union_aligned(spark, d):
    """Readings of both sources in one table; each source's own id column is NULL for the other."""
    from kinelab.operators.windows import union_aligned
    ev = tb.readings_events(spark, d).select(C.KEY, C.READING_TIME, r6(C.READING).alias(C.READING),
                                             F.col("tiebreak").alias("event_id"))
    od = tb.readings_orders(spark, d).select(C.KEY, C.READING_TIME, r6(C.READING).alias(C.READING),
                                             F.col("tiebreak").alias("order_key"))
    return union_aligned([ev, od])


# ------------------------------------------------------------ file names
def q_f7_f8_file_keys(spark, d):
    pages = tb.table(spark, d, "pages").select("page_id", "url")
    return csvsrc.file_keys(pages).select("page_id", "base_name", C.KEY)


#: Two letters and at least four digits: names stay unique beyond 9,999.
LONG_KEY = r"([A-Z]{2}\d{4,})"


def _label_file(key) -> F.Column:
    return F.format_string(f"AB%04d{C.LABEL_FILE_SUFFIX}", key)


def _s1_roundtrip(spark, d, key):
    r = tb.readings_events(spark, d).select(C.READING_TIME, C.READING, _label_file(key).alias("label_file"))
    path = scratch_path(spark, "readings_csv")
    csvsrc.write_readings_folder(r, path)
    return csvsrc.read_readings_folder(spark, path, pattern=LONG_KEY, key_from="parent_dir").select(
        C.READING_TIME, C.READING, C.KEY)


def q_s1_readings_folder(spark, d):
    """Readings written as one folder per key file, read back with keys from names."""
    return _s1_roundtrip(spark, d, F.col(C.KEY))


def q_s1_long_keys(spark, d):
    """Keys on both sides of 9,999 stay apart."""
    return _s1_roundtrip(spark, d, F.col(C.KEY) * 10 + 9_000)


def _mixed_files(spark, d) -> str:
    """Reading files in two header layouts, some under a name without a key (P9), some lines without a number."""
    r = tb.readings_events(spark, d)
    path = scratch_path(spark, "mixed_csv")
    named = F.when(F.col("tiebreak") % 10 != 0, _label_file(F.col(C.KEY))).otherwise(F.lit("unknown.csv"))
    t = F.when(F.col("tiebreak") % 13 == 0, F.lit("bad"))
    a = r.where("tiebreak % 2 = 0").select(F.coalesce(t, F.col(C.READING_TIME).cast("string")).alias(C.READING_TIME),
                                           C.READING, named.alias("label_file"))
    b = r.where("tiebreak % 2 <> 0").select(C.READING, F.lit("a,b").alias("note"),
                                            F.coalesce(t, F.col(C.READING_TIME).cast("double").cast("string")).alias(C.READING_TIME),
                                            named.alias("label_file"))
    csvsrc.write_readings_folder(a, path)
    csvsrc.write_readings_folder(b, path, mode="append")
    return path


def q_s1_mixed_headers(spark, d):
    """Both layouts by name, nameless files skipped, an absent folder adds nothing."""
    found = csvsrc.read_readings_folder(spark, _mixed_files(spark, d), pattern=LONG_KEY, key_from="parent_dir")
    none = csvsrc.read_readings_folder(spark, scratch_path(spark, "absent"), pattern=LONG_KEY)
    return found.unionByName(none).select(C.READING_TIME, C.READING, C.KEY)


def q_s1_rejected_lines(spark, d):
    """Lines without a numeric time are returned and counted, not lost."""
    parsed = csvsrc.parse_readings_folder(spark, _mixed_files(spark, d), pattern=LONG_KEY, key_from="parent_dir")
    return (parsed.rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows").alias("kind"), "n")
            .unionByName(parsed.rejected.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejected").alias("kind"), "n")))


def _note(n):
    """Notes with quotes, commas and line feeds, among them one that looks like a reading of its own."""
    return (F.when(n % 4 == 0, F.concat(F.lit("a\nb "), n.cast("string")))
            .when(n % 4 == 1, F.concat(n.cast("string"), F.lit(",0.9\n"), n.cast("string"), F.lit(",y,0.9")))
            .when(n % 4 == 2, F.concat(F.lit('say "x",\n\n"'), n.cast("string"), F.lit('"')))
            .otherwise(F.lit("plain")))


def q_s1_quoted_line_feeds(spark, d):
    """Reading files with a note column that holds quoted line feeds, in two column orders: the notes come back, no reading is invented."""
    r = tb.readings_events(spark, d).withColumn("note", _note(F.col("tiebreak"))).withColumn("label_file", _label_file(F.col(C.KEY)))
    path = scratch_path(spark, "quoted_csv")
    csvsrc.write_readings_folder(r.where("tiebreak % 3 <> 0").select("note", C.READING_TIME, C.READING, "label_file"), path)
    csvsrc.write_readings_folder(r.where("tiebreak % 3 = 0").select(C.READING_TIME, C.READING, "note", "label_file"), path, mode="append")
    return csvsrc.read_readings_folder(spark, path, pattern=LONG_KEY, key_from="parent_dir", columns=(C.READING_TIME, C.READING, "note"))


def q_s2_quoted_line_feeds(spark, d):
    """Sensor files with quoted line feeds in a column that is not read."""
    path = scratch_path(spark, "quoted_sensor_csv")
    s = tb.sensor_events(spark, d)
    (s.select(_note(F.col("event_id")).alias("note"), F.col(C.KEY).cast("string").alias("pid"), F.col(C.TIME_MS).alias("time"), "x", "y", "z")
     .write.options(header=True, **csvsrc.QUOTES).csv(path))
    return _windows_out(tumbling_mean(csvsrc.read_sensor_csv(spark, path), DAY))


def q_s2_sensor_csv(spark, d):
    """Sensor samples written as CSV, read back with an explicit schema, windowed."""
    path = scratch_path(spark, "sensor_csv")
    csvsrc.write_sensor_csv(tb.sensor_events(spark, d), path)
    return _windows_out(tumbling_mean(csvsrc.read_sensor_csv(spark, path), DAY))


def q_s2_sensor_csv_header_order(spark, d):
    """Files of one folder that order their columns differently."""
    path = scratch_path(spark, "sensor_csv")
    s = tb.sensor_events(spark, d)
    csvsrc.write_sensor_csv(s.where("event_id % 2 = 0"), path, ("time", "pid", "x", "y", "z"))
    csvsrc.write_sensor_csv(s.where("event_id % 2 <> 0"), path, ("z", "y", "x", "pid", "time"), mode="append")
    return _windows_out(tumbling_mean(csvsrc.read_sensor_csv(spark, path), DAY))


# ------------------------------------------------------------------ SQL
SENSOR_A = """SELECT user_id AS pid, CAST(floor(epoch_us(ts) / 1000.0) AS BIGINT) AS time_ms, value AS x,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y,
  CAST(event_id % 100 AS DOUBLE) / 10 AS z, event_id FROM events"""
SENSOR_B = """SELECT l_suppkey AS pid, CAST(floor(epoch_us(l_shipdate) / 1000.0) AS BIGINT) AS time_ms, l_quantity AS x,
  l_discount AS y, l_tax AS z FROM lineitem"""
SENSOR_BC = """SELECT o.o_custkey AS pid, CAST(floor(epoch_us(l.l_shipdate) / 1000.0) AS BIGINT) AS time_ms, l.l_quantity AS x,
  l.l_discount AS y, l.l_tax AS z FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
READ_A = """SELECT user_id AS pid, CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS rts,
  arg_max(value / 500.0, event_id) AS TAC_Reading FROM events
  WHERE event_type = 'purchase' AND user_id IS NOT NULL GROUP BY 1, 2"""
READ_O = """SELECT o_custkey AS pid, CAST(floor(epoch_us(o_orderdate) / 1000000.0) AS BIGINT) AS rts,
  arg_max(o_totalprice / 1e6, o_orderkey) AS TAC_Reading FROM orders
  WHERE o_custkey IS NOT NULL GROUP BY 1, 2"""


def _win_sql(sensor: str, size: int) -> str:
    return f"""SELECT pid, CAST(floor(time_ms / {1000.0 * size!r}) * {size} AS BIGINT) AS window_start_s,
  avg(x) AS x, avg(y) AS y, avg(z) AS z FROM ({sensor}) s
  WHERE pid IS NOT NULL AND time_ms IS NOT NULL GROUP BY 1, 2"""


WIN_A = _win_sql(SENSOR_A, DAY)
WIN_B = _win_sql(SENSOR_B, MONTH)
WIN_BC = _win_sql(SENSOR_BC, MONTH)

SQL_WINDOWS = "SELECT pid, window_start_s, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM ({w})"


def _asof_sql(win: str, read: str) -> str:
    return f"""WITH w AS ({win}), r AS ({read})
SELECT w.pid, w.window_start_s, round(w.x, 6) AS x, round(w.y, 6) AS y, round(w.z, 6) AS z,
  round(r.TAC_Reading, 6) AS TAC_Reading
FROM w ASOF LEFT JOIN r ON w.pid = r.pid AND w.window_start_s >= r.rts"""


LABELLED_A = f"""SELECT w.window_start_s AS time, w.x, w.y, w.z, r.TAC_Reading, w.pid
FROM ({WIN_A}) w ASOF LEFT JOIN ({READ_A}) r ON w.pid = r.pid AND w.window_start_s >= r.rts"""

SQL_LABELLED = f"""SELECT time, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z,
  round(TAC_Reading, 6) AS TAC_Reading, CAST(pid AS VARCHAR) AS pid FROM ({LABELLED_A})"""

SQL_S4_REWRITTEN = f"""WITH l AS ({LABELLED_A})
SELECT time, round(x + CASE WHEN floor(time / {DAY}) = (SELECT floor(min(time) / {DAY}) FROM l) THEN 1 ELSE 0 END, 6) AS x, round(y, 6) AS y,
  round(z, 6) AS z, round(TAC_Reading, 6) AS TAC_Reading, CAST(pid AS VARCHAR) AS pid FROM l"""

SQL_LABELLED_NATIVE = f"""SELECT time, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z,
  round(TAC_Reading, 6) AS TAC_Reading, pid FROM ({LABELLED_A})"""

FEATS_A = f"""SELECT *, x * x + y * y + z * z AS energy, sqrt(x * x + y * y + z * z) AS magnitude,
  TAC_Reading >= 0.08 AS is_intoxicated FROM ({LABELLED_A})"""


def _features_sql(pid_expr: str) -> str:
    return f"""SELECT time, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z,
  round(TAC_Reading, 6) AS TAC_Reading, {pid_expr} AS pid, round(energy, 6) AS energy,
  round(magnitude, 6) AS magnitude, is_intoxicated FROM ({FEATS_A})"""


SQL_STATS = f"""SELECT round(avg(energy), 4) AS energy_mean, round(stddev_samp(energy), 4) AS energy_std,
  round(avg(magnitude), 6) AS magnitude_mean, round(stddev_samp(magnitude), 6) AS magnitude_std
FROM ({FEATS_A})"""

SQL_CLASS_COUNTS = f"""SELECT 'is_intoxicated' AS target, 'false' AS category,
  CAST(count(*) FILTER (WHERE NOT is_intoxicated) AS BIGINT) AS cnt FROM ({FEATS_A})
UNION ALL SELECT 'is_intoxicated', 'true',
  CAST(count(*) FILTER (WHERE is_intoxicated) AS BIGINT) FROM ({FEATS_A})"""

LOG = """SELECT ts, CAST(floor(epoch_us(ts) / 1000.0) AS BIGINT) AS timestamp, value / 500.0 >= 0.08 AS is_intoxicated, event_id,
  value / 50.0 AS latency_s, event_type AS kind FROM events"""

LATEST = f"SELECT * FROM ({LOG}) ORDER BY timestamp DESC, event_id DESC LIMIT {C.LIVE_ROWS}"

SQL_PSI = f"""WITH log AS ({LOG}),
med AS (SELECT quantile_disc(ts, 0.5) AS m FROM log),
ref AS (SELECT count(*) FILTER (WHERE NOT is_intoxicated) AS f,
               count(*) FILTER (WHERE is_intoxicated) AS t FROM log, med WHERE log.ts < med.m),
q AS (SELECT count(*) AS n, count(*) FILTER (WHERE NOT is_intoxicated) AS f,
             count(*) FILTER (WHERE is_intoxicated) AS t FROM ({LATEST})),
sh AS (SELECT ref.f / (ref.f + ref.t) + 1e-100 AS pf, ref.t / (ref.f + ref.t) + 1e-100 AS pt,
              q.f / q.n + 1e-100 AS qf, q.t / q.n + 1e-100 AS qt FROM ref, q WHERE q.n >= {C.LIVE_ROWS})
SELECT 'is_intoxicated' AS target,
  round((qf - pf) * ln(qf / pf) + (qt - pt) * ln(qt / pt), 6) AS psi FROM sh"""

SLOW = "latency_s > 5.0"
_PSI_TARGET = f"""SELECT '@T' AS target, round((qf - pf) * ln(qf / pf) + (qt - pt) * ln(qt / pt), 6) AS psi FROM (
  SELECT ref.f / (ref.f + ref.t) + 1e-100 AS pf, ref.t / (ref.f + ref.t) + 1e-100 AS pt, q.f / q.n + 1e-100 AS qf, q.t / q.n + 1e-100 AS qt
  FROM (SELECT count(*) FILTER (WHERE NOT (@C)) AS f, count(*) FILTER (WHERE @C) AS t FROM ({LOG}) l
        WHERE l.ts < (SELECT quantile_disc(ts, 0.5) FROM ({LOG}))) ref,
       (SELECT count(*) AS n, count(*) FILTER (WHERE NOT (@C)) AS f, count(*) FILTER (WHERE @C) AS t FROM ({LATEST})) q WHERE q.n >= {C.LIVE_ROWS})"""
SQL_A6 = (_PSI_TARGET.replace("@T", "is_intoxicated").replace("@C", "is_intoxicated") + " UNION ALL "
          + _PSI_TARGET.replace("@T", "is_slow").replace("@C", SLOW))
SQL_S12_PSI = f"SELECT 'psi' AS metric, 'target' AS label_key, target AS label_value, psi AS value FROM ({SQL_A6})"

SQL_LIVE_SHARES = f"""WITH q AS (SELECT count(*) AS n, count(*) FILTER (WHERE NOT is_intoxicated) AS f,
  count(*) FILTER (WHERE is_intoxicated) AS t FROM ({LATEST}))
SELECT 'is_intoxicated' AS target, 'false' AS category, round(f / n + 1e-100, 6) AS q FROM q WHERE n >= {C.LIVE_ROWS}
UNION ALL
SELECT 'is_intoxicated', 'true', round(t / n + 1e-100, 6) FROM q WHERE n >= {C.LIVE_ROWS}"""

_FOLDS_SQL = f"""WITH s AS (SELECT @KEY AS pid, time_ms, event_id, x / 500.0 >= 0.08 AS is_intoxicated
  FROM ({SENSOR_A}) WHERE x IS NOT NULL),
o AS (SELECT *, row_number() OVER (ORDER BY pid NULLS FIRST, time_ms, event_id) AS pos FROM s),
cls AS (SELECT is_intoxicated, min(pos) AS first_pos, count(*) AS n FROM o GROUP BY 1),
cls2 AS (SELECT is_intoxicated, n, coalesce(sum(n) OVER (ORDER BY first_pos
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM cls),
alloc AS (SELECT c.is_intoxicated, f.fold,
  floor((c.st + c.n - f.fold + {C.NUM_FOLDS - 1}) / {C.NUM_FOLDS})
  - floor((c.st - f.fold + {C.NUM_FOLDS - 1}) / {C.NUM_FOLDS}) AS a
  FROM cls2 c CROSS JOIN (SELECT range AS fold FROM range({C.NUM_FOLDS})) f),
b AS (SELECT is_intoxicated, fold, coalesce(sum(a) OVER (PARTITION BY is_intoxicated ORDER BY fold
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo, a FROM alloc),
r AS (SELECT *, row_number() OVER (PARTITION BY is_intoxicated ORDER BY pid NULLS FIRST, time_ms, event_id) - 1 AS rnk FROM s)
SELECT r.pid, r.time_ms, r.event_id, r.is_intoxicated, CAST(b.fold AS INTEGER) AS fold
FROM r JOIN b ON r.is_intoxicated = b.is_intoxicated AND r.rnk >= b.lo AND r.rnk < b.lo + b.a"""
SQL_FOLDS = _FOLDS_SQL.replace("@KEY", "pid")
SQL_FOLDS_NULL = _FOLDS_SQL.replace("@KEY", "CASE WHEN event_id % 7 <> 0 THEN pid END")

SQL_R1_HALF = f"""SELECT time, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, round(TAC_Reading, 6) AS TAC_Reading, pid
FROM ({LABELLED_A}) WHERE substr(md5('{C.SEED}|' || pid || '|' || time), 1, 8) < '80000000'"""

SQL_P4 = f"""SELECT time, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, round(energy, 6) AS energy,
  round(magnitude, 6) AS magnitude, is_intoxicated FROM ({FEATS_A})"""

SQL_F6 = """SELECT user_id AS pid, CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS timestamp,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS reading_at FROM events WHERE event_type = 'purchase'"""

SQL_J1_FRACTIONAL = f"""WITH r AS ({READ_A}), w AS (SELECT DISTINCT pid, rts AS window_start_s FROM r),
h AS (SELECT pid, rts + 0.5::DOUBLE AS rts, TAC_Reading FROM r)
SELECT w.pid, w.window_start_s, round(h.TAC_Reading, 6) AS TAC_Reading FROM w ASOF LEFT JOIN h ON w.pid = h.pid AND w.window_start_s >= h.rts"""

SQL_A8 = """WITH c AS (SELECT count(*) FILTER (WHERE toxic = 1 AND quality = 0) AS tp,
  count(*) FILTER (WHERE toxic <> 1 AND quality = 0) AS fp,
  count(*) FILTER (WHERE toxic = 1 AND quality <> 0) AS fn,
  count(*) FILTER (WHERE toxic <> 1 AND quality <> 0) AS tn FROM labels)
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1,
  round(CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / (tp + fp + fn + tn) ELSE 0.0 END, 6) AS accuracy
FROM c"""

REG = """SELECT o_orderkey AS run_id, o_custkey AS run_name,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS end_time FROM orders"""

SQL_T5 = f"""WITH reg AS ({REG}),
g AS (SELECT run_name, count(*) FILTER (WHERE end_time IS NULL) AS nu,
  max(run_id) FILTER (WHERE end_time IS NULL) AS open_run FROM reg GROUP BY 1),
f AS (SELECT run_name, run_id FROM (SELECT run_name, run_id, row_number() OVER (
  PARTITION BY run_name ORDER BY end_time DESC, run_id DESC) AS rn FROM reg WHERE end_time IS NOT NULL) WHERE rn = 1)
SELECT g.run_name, CASE WHEN nu > 1 THEN NULL WHEN nu = 1 THEN open_run ELSE f.run_id END AS run_id,
  CASE WHEN nu > 1 THEN 'multiple_unfinished' WHEN nu = 1 THEN 'unfinished' ELSE 'finished' END AS status
FROM g LEFT JOIN f ON g.run_name = f.run_name"""

SQL_W3 = f"""SELECT run_name, run_id, CAST(floor(epoch_us(end_time) / 1000000.0) AS BIGINT) AS end_s FROM (
  SELECT *, row_number() OVER (PARTITION BY run_name ORDER BY end_time DESC NULLS FIRST, run_id DESC) AS rn
  FROM ({REG})) WHERE rn = 1"""

SQL_T6 = """SELECT 'run-' || CAST(c_custkey AS VARCHAR) AS run_id, c_custkey AS run_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)"""

SQL_T6_ABSENT = "SELECT 'run-' || CAST(-c_custkey - 1 AS VARCHAR) AS run_id, -c_custkey - 1 AS run_name FROM customer"

SQL_P11 = f"SELECT run_id, run_name FROM ({REG}) WHERE end_time IS NULL"

SQL_A14 = f"""SELECT run_name, CAST(floor(epoch_us(max(end_time)) / 1000000.0) AS BIGINT) AS last_end_s
FROM ({REG}) GROUP BY 1"""

SQL_A9 = f"""SELECT CASE WHEN is_intoxicated THEN 'true' WHEN NOT is_intoxicated THEN 'false' END AS pred,
  count(*) AS cnt FROM ({LOG}) GROUP BY 1"""

SQL_A10 = "\nUNION ALL\n".join(
    [f"SELECT '{b:g}' AS le, count(*) FILTER (WHERE latency_s <= {float(b)!r}) AS cnt FROM ({LOG})"
     for b in C.LATENCY_BUCKETS]
    + [f"SELECT '+Inf' AS le, count(latency_s) AS cnt FROM ({LOG})"])

SQL_A10_SUMMARY = f"SELECT round(sum(latency_s), 6) AS sum_s, count(latency_s) AS count FROM ({LOG})"

SQL_A11 = "SELECT count(*) FILTER (WHERE event_type = 'signup') AS cnt FROM events"

HTTP = """SELECT ts, CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS code,
  'scoring-api' AS job, CAST(user_id % 4 AS VARCHAR) AS instance FROM events"""

RATES = f"""SELECT job, instance, CAST(floor(floor(epoch_us(ts) / 1000000.0) / {HOUR}) * {HOUR} AS BIGINT) AS window_start_s,
  count(*) AS errors, count(*) / {float(HOUR)!r} AS rate
FROM ({HTTP}) WHERE NOT regexp_full_match(code, '200') GROUP BY 1, 2, 3"""

SQL_A12 = f"SELECT job, instance, window_start_s, errors, round(rate, 6) AS rate FROM ({RATES}) WHERE rate > 0"

SQL_A13 = f"""WITH r AS (SELECT *, CAST(window_start_s / {HOUR} AS BIGINT)
  - row_number() OVER (PARTITION BY job, instance ORDER BY window_start_s) AS g FROM ({RATES}) WHERE rate > 0)
SELECT job, instance, min(window_start_s) AS start_s, max(window_start_s) + {HOUR} AS end_s,
  count(*) AS n_windows FROM r GROUP BY job, instance, g HAVING (count(*) - 1) * {HOUR} >= {HOUR}"""

COUNTERS = f"""WITH h AS (SELECT CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS code, user_id % 4 AS inst,
    CAST(floor((floor(epoch_us(ts) / 1000000.0) - user_id % 4 * 7) / {SCRAPE}) AS BIGINT) + 1 AS i FROM events),
c AS (SELECT code, inst, i, count(*) AS n FROM h GROUP BY ALL),
g AS (SELECT code, inst, unnest(range((SELECT min(i) FROM c), (SELECT max(i) FROM c) + 4)) AS i FROM (SELECT DISTINCT code, inst FROM c)),
v AS (SELECT code, inst, i, sum(coalesce(n, 0)) OVER (PARTITION BY code, inst, CAST(floor((i - 13 - 5 * inst) / 97.0) AS BIGINT) ORDER BY i) AS value
      FROM g LEFT JOIN c USING (code, inst, i))
SELECT 'scoring-api' AS job, CAST(inst AS VARCHAR) AS instance, code, i * {SCRAPE} + inst * 7 AS at_s, CAST(value AS DOUBLE) AS value
FROM v WHERE ((i % 31) + 31) % 31 <> 7"""

COUNTER_RATES = f"""WITH s AS ({COUNTERS}),
t AS (SELECT unnest(range(CAST(floor((SELECT min(at_s) FROM s) / {STEP}) AS BIGINT), CAST(ceil(((SELECT max(at_s) FROM s) + {HOUR}) / {STEP}) AS BIGINT) + 1)) * {STEP} AS t_s),
j AS (SELECT job, instance, code, t_s, at_s, value, lag(value) OVER w AS before FROM s JOIN t ON at_s > t_s - {HOUR} AND at_s <= t_s
      WINDOW w AS (PARTITION BY job, instance, code, t_s ORDER BY at_s)),
a AS (SELECT job, instance, code, t_s, count(*) AS n, min(at_s) AS t0, max(at_s) AS t1, arg_min(value, at_s) AS v0,
        arg_max(value, at_s) - arg_min(value, at_s) + sum(CASE WHEN value < before THEN before ELSE 0 END) AS inc FROM j GROUP BY ALL HAVING count(*) >= 2),
x AS (SELECT *, (t1 - t0)::DOUBLE AS span, (t1 - t0)::DOUBLE / (n - 1) AS gap, t0 - (t_s - {HOUR}) AS lo, t_s - t1 AS hi FROM a),
y AS (SELECT *, CASE WHEN lo >= gap * 1.1 THEN gap / 2 ELSE lo END AS e0, CASE WHEN hi >= gap * 1.1 THEN gap / 2 ELSE hi END AS e1 FROM x)
SELECT job, instance, code, t_s, n, inc * ((span + CASE WHEN inc > 0 AND v0 >= 0 AND span * v0 / inc < e0 THEN span * v0 / inc ELSE e0 END + e1) / span) / {HOUR} AS rate FROM y"""

COUNTER_ERRORS = f"SELECT job, instance, t_s AS window_start_s, sum(rate) AS rate FROM ({COUNTER_RATES}) WHERE code <> '200' GROUP BY ALL HAVING sum(rate) > 0"

SQL_A13_COUNTERS = f"""WITH r AS (SELECT *, CAST(window_start_s / {STEP} AS BIGINT)
  - row_number() OVER (PARTITION BY job, instance ORDER BY window_start_s) AS g FROM ({COUNTER_ERRORS}))
SELECT job, instance, min(window_start_s) AS start_s, max(window_start_s) + {STEP} AS end_s,
  count(*) AS n_windows FROM r GROUP BY job, instance, g HAVING (count(*) - 1) * {STEP} >= 1800"""

SQL_S12 = f"""SELECT 'predictions' AS metric, 'pred' AS label_key, pred AS label_value,
  round(CAST(cnt AS DOUBLE), 6) AS value FROM ({SQL_A9})
UNION ALL SELECT 'request_count', NULL, NULL, round(CAST(count(latency_s) AS DOUBLE), 6) FROM ({LOG})"""

SQL_F7 = f"""SELECT page_id, string_split(url, '/')[-1] AS base_name,
  regexp_extract(string_split(url, '/')[-1], '{C.KEY_PATTERN}', 1) AS pid FROM pages"""

def _s1_sql(key: str, where: str = "") -> str:
    return f"""SELECT CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS timestamp, value / 500.0 AS TAC_Reading,
  'AB' || printf('%04d', {key}) AS pid FROM events WHERE event_type = 'purchase' {where}"""


SQL_S1 = _s1_sql("user_id")
SQL_S1_QUOTED = SQL_S1.replace("FROM events", """, CASE event_id % 4
  WHEN 0 THEN 'a' || chr(10) || 'b ' || event_id
  WHEN 1 THEN event_id || ',0.9' || chr(10) || event_id || ',y,0.9'
  WHEN 2 THEN 'say "x",' || chr(10) || chr(10) || '"' || event_id || '"'
  ELSE 'plain' END AS note
FROM events""")
SQL_S1_MIXED = _s1_sql("user_id", "AND event_id % 10 <> 0 AND event_id % 13 <> 0")
SQL_S1_REJECTED = """SELECT 'rows' AS kind, count(*) FILTER (WHERE event_id % 13 <> 0) AS n FROM events WHERE event_type = 'purchase' AND event_id % 10 <> 0
UNION ALL SELECT 'rejected', count(*) FILTER (WHERE event_id % 13 = 0) FROM events WHERE event_type = 'purchase' AND event_id % 10 <> 0"""

SQL_S2 = f"""SELECT CAST(pid AS VARCHAR) AS pid, window_start_s, round(x, 6) AS x, round(y, 6) AS y,
  round(z, 6) AS z FROM ({WIN_A})"""

SQL_S8 = "SELECT CAST(event_id AS VARCHAR) AS row, CAST(floor(epoch_us(ts) / 1000.0) AS BIGINT) AS timestamp, value / 500.0 >= 0.08 AS is_intoxicated FROM events"

SQL_T1 = """SELECT user_id AS pid, CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS timestamp,
  round(value / 500.0, 6) AS TAC_Reading FROM events WHERE event_type = 'purchase' ORDER BY 1, 2"""

SQL_U2 = """SELECT user_id AS pid, CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS timestamp,
  round(value / 500.0, 6) AS TAC_Reading, event_id, CAST(NULL AS BIGINT) AS order_key
FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT o_custkey, CAST(floor(epoch_us(o_orderdate) / 1000000.0) AS BIGINT), round(o_totalprice / 1e6, 6),
  CAST(NULL AS BIGINT), o_orderkey FROM orders"""

SQL_S9 = f"""SELECT time_ms / 1000.0::DOUBLE AS time, x, y, z, round(x * x + y * y + z * z, 6) AS energy,
  round(sqrt(x * x + y * y + z * z), 6) AS magnitude FROM ({SENSOR_A})"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "a1_window_mean_events": q_a1_events,
    "a1_window_mean_lineitem": q_a1_lineitem,
    "j1_asof_events_auto": _j1_events("auto"),
    "j1_asof_events_broadcast": _j1_events("broadcast"),
    "j1_asof_events_union": _j1_events("union"),
    "j1_asof_events_bucketed": _j1_events("bucketed"),
    "j1_asof_orders_broadcast": _j1_orders("broadcast"),
    "j1_asof_orders_union": _j1_orders("union"),
    "j1_asof_orders_bucketed": _j1_orders("bucketed"),
    "e1_labelled_roundtrip": q_e1_labelled_roundtrip,
    "s3_key_folders": q_s3_key_folders,
    "s4_rewritten_day": q_s4_rewritten_day,
    "r1_sample_full": q_r1_sample_full,
    "m1_training_features": q_m1_training_features,
    "m9_pipeline_stages": q_m9_pipeline_stages,
    "a2_fitted_stats": q_a2_fitted_stats,
    "a2_merged_stats": q_a2_merged_stats,
    "a3_merged_counts": q_a3_merged_counts,
    "s10_state_roundtrip": q_s10_state_roundtrip,
    "a3_class_counts": q_a3_class_counts,
    "s6_s7_class_distribution": q_s6_s7_class_distribution,
    "s9_request_features": q_s9_request_features,
    "t3_latest_n": q_t3_latest_n,
    "a4_live_shares": q_a4_live_shares,
    "a5_psi": q_a5_psi,
    "s8_column_log": q_s8_column_log,
    "s8_single_document": q_s8_single_document,
    "w2_stratified_folds": q_w2_stratified_folds,
    "a8_binary_metrics": q_a8_binary_metrics,
    "t5_latest_run": q_t5_latest_run,
    "w3_newest_run": q_w3_newest_run,
    "t6_create_if_absent": q_t6_create_if_absent,
    "p11_unfinished_runs": q_p11_unfinished,
    "a14_last_end_time": q_a14_last_end,
    "a9_prediction_counts": q_a9_prediction_counts,
    "a10_latency_histogram": q_a10_latency_histogram,
    "a10_latency_summary": q_a10_latency_summary,
    "a11_reload_count": q_a11_reload_count,
    "a12_error_rate": q_a12_error_rate,
    "a13_sustained_errors": q_a13_sustained,
    "counter_rates_a12": q_a12_counter_rates,
    "counter_error_rates_a12": q_a12_counter_error_rates,
    "counter_alert_a13": q_a13_counter_alert,
    "s12_metrics_table": q_s12_metrics_table,
    "f7_f8_file_keys": q_f7_f8_file_keys,
    "t1_sorted_readings": q_t1_sorted_readings,
    "u2_union_aligned": q_u2_union_aligned,
    "s1_readings_folder": q_s1_readings_folder,
    "s2_sensor_csv": q_s2_sensor_csv,
    "s2_sensor_csv_header_order": q_s2_sensor_csv_header_order,
    "s1_long_keys": q_s1_long_keys,
    "s1_mixed_headers": q_s1_mixed_headers,
    "s1_rejected_lines": q_s1_rejected_lines,
    "s1_quoted_line_feeds": q_s1_quoted_line_feeds,
    "s2_quoted_line_feeds": q_s2_quoted_line_feeds,
    "w2_null_key": q_w2_null_key,
    "j1_fractional_times_broadcast": _j1_fractional("broadcast"),
    "j1_fractional_times_bucketed": _j1_fractional("bucketed"),
    "j1_fractional_times_union": _j1_fractional("union"),
    "r1_sample_half": q_r1_sample_half,
    "t6_absent_and_repeated": q_t6_absent_and_repeated,
    "t4_live_guard": q_t4_live_guard,
    "a6_psi_two_targets": q_a6_psi_two_targets,
    "s12_psi_metrics": q_s12_psi_metrics,
    "p4_p5_training_columns": q_p4_p5_training_columns,
    "f6_reading_datetime": q_f6_reading_datetime,
}

SQL: dict[str, str] = {
    "a1_window_mean_events": SQL_WINDOWS.format(w=WIN_A),
    "a1_window_mean_lineitem": SQL_WINDOWS.format(w=WIN_B),
    "j1_asof_events_auto": _asof_sql(WIN_A, READ_A),
    "j1_asof_events_broadcast": _asof_sql(WIN_A, READ_A),
    "j1_asof_events_union": _asof_sql(WIN_A, READ_A),
    "j1_asof_events_bucketed": _asof_sql(WIN_A, READ_A),
    "j1_asof_orders_broadcast": _asof_sql(WIN_BC, READ_O),
    "j1_asof_orders_union": _asof_sql(WIN_BC, READ_O),
    "j1_asof_orders_bucketed": _asof_sql(WIN_BC, READ_O),
    "e1_labelled_roundtrip": SQL_LABELLED,
    "s3_key_folders": SQL_LABELLED,
    "s4_rewritten_day": SQL_S4_REWRITTEN,
    "r1_sample_full": SQL_LABELLED_NATIVE,
    "m1_training_features": _features_sql("pid"),
    "m9_pipeline_stages": _features_sql("CAST(pid AS VARCHAR)"),
    "a2_fitted_stats": SQL_STATS,
    "a2_merged_stats": SQL_STATS,
    "a3_merged_counts": SQL_CLASS_COUNTS,
    "s10_state_roundtrip": SQL_STATS,
    "a3_class_counts": SQL_CLASS_COUNTS,
    "s6_s7_class_distribution": SQL_CLASS_COUNTS,
    "s9_request_features": SQL_S9,
    "t3_latest_n": f"SELECT timestamp, is_intoxicated, event_id FROM ({LATEST})",
    "a4_live_shares": SQL_LIVE_SHARES,
    "a5_psi": SQL_PSI,
    "s8_column_log": SQL_S8,
    "s8_single_document": SQL_S8,
    "w2_stratified_folds": SQL_FOLDS,
    "a8_binary_metrics": SQL_A8,
    "t5_latest_run": SQL_T5,
    "w3_newest_run": SQL_W3,
    "t6_create_if_absent": SQL_T6,
    "p11_unfinished_runs": SQL_P11,
    "a14_last_end_time": SQL_A14,
    "a9_prediction_counts": SQL_A9,
    "a10_latency_histogram": SQL_A10,
    "a10_latency_summary": SQL_A10_SUMMARY,
    "a11_reload_count": SQL_A11,
    "a12_error_rate": SQL_A12,
    "a13_sustained_errors": SQL_A13,
    "counter_rates_a12": f"SELECT job, instance, code, t_s, n, round(rate, 6) AS rate FROM ({COUNTER_RATES})",
    "counter_error_rates_a12": f"SELECT job, instance, window_start_s, round(rate, 6) AS rate FROM ({COUNTER_ERRORS})",
    "counter_alert_a13": SQL_A13_COUNTERS,
    "s12_metrics_table": SQL_S12,
    "f7_f8_file_keys": SQL_F7,
    "t1_sorted_readings": SQL_T1,
    "u2_union_aligned": SQL_U2,
    "s1_readings_folder": SQL_S1,
    "s2_sensor_csv": SQL_S2,
    "s2_sensor_csv_header_order": SQL_S2,
    "s1_long_keys": _s1_sql("user_id * 10 + 9000"),
    "s1_mixed_headers": SQL_S1_MIXED,
    "s1_rejected_lines": SQL_S1_REJECTED,
    "s1_quoted_line_feeds": SQL_S1_QUOTED,
    "s2_quoted_line_feeds": SQL_S2,
    "w2_null_key": SQL_FOLDS_NULL,
    "j1_fractional_times_broadcast": SQL_J1_FRACTIONAL,
    "j1_fractional_times_bucketed": SQL_J1_FRACTIONAL,
    "j1_fractional_times_union": SQL_J1_FRACTIONAL,
    "r1_sample_half": SQL_R1_HALF,
    "t6_absent_and_repeated": SQL_T6_ABSENT,
    "t4_live_guard": f"SELECT 'full' AS log, target, category, q FROM ({SQL_LIVE_SHARES})",
    "a6_psi_two_targets": SQL_A6,
    "s12_psi_metrics": SQL_S12_PSI,
    "p4_p5_training_columns": SQL_P4,
    "f6_reading_datetime": SQL_F6,
}
