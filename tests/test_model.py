from pyspark.sql import functions as F

from kinelab import config as C
from kinelab.operators import model


def _frame(spark, n=40):
    rows = [(float(i), float(i % 7), float(i % 3), float(i % 5), float(i % 11), float(i % 13),
             float(i % 2), i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "time double, x double, y double, z double, energy double, "
                                       "magnitude double, label double, fold int")


def test_fit_predict_range(spark):
    df = _frame(spark)
    m = model.fit_forest(df.drop("fold"), num_trees=5, max_depth=3)
    preds = model.predict(m, df, keep=["time"])
    assert preds.count() == 40
    assert {r.prediction for r in preds.collect()} <= {0, 1}


def test_cross_validate_two_folds(spark):
    scores = model.cross_validate(_frame(spark), k=2, num_trees=5, max_depth=3)
    rows = scores.collect()
    assert len(rows) == 2 * 2 * 4
    assert {r.metric for r in rows} == {"precision", "recall", "f1", "accuracy"}
    assert all(0.0 <= r.value <= 1.0 for r in rows)


def test_pipeline_params():
    p = model.forest_pipeline()
    rf = p.getStages()[-1]
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getSeed()) == (100, 10, 42)


def test_save_and_load(spark, scratch):
    df = _frame(spark)
    m = model.fit_forest(df.drop("fold"), num_trees=3, max_depth=2)
    path = scratch("model")
    model.save_model(m, path)
    a = model.predict(m, df, keep=["time"]).orderBy("time").collect()
    b = model.predict(model.load_model(path), df, keep=["time"]).orderBy("time").collect()
    assert a == b


def test_four_rows_two_stratified_folds(spark):
    from kinelab import config as C
    from kinelab.operators import features, folds, opsmetrics
    rows = [("A", 0, 1.0, 2.0, 3.0, 0.01), ("A", 10, 4.0, 5.0, 6.0, 0.09),
            ("B", 0, 1.5, 2.5, 3.5, 0.02), ("B", 10, 4.5, 5.5, 6.5, 0.10)]
    df = spark.createDataFrame(rows, "pid string, time bigint, x double, y double, z double, TAC_Reading double")
    feats = features.training_features(df)
    framed = model.training_frame(folds.stratified_folds(feats, time_col="time", k=2))
    assert sorted((r.label, r.fold) for r in framed.collect()) == [(0.0, 0), (0.0, 1), (1.0, 0), (1.0, 1)]
    scores = model.cross_validate(framed, k=2, num_trees=3, max_depth=2)
    names = {r.name for r in opsmetrics.fold_metric_means(scores).collect()}
    assert names == set(C.METRICS_TO_LOG)
    preds = model.predict(model.fit_forest(framed.drop("fold"), num_trees=3, max_depth=2), framed)
    assert preds.count() == 4 and {r.prediction for r in preds.collect()} <= {0, 1}


def test_training_frame_drops_key_reading_and_null_labels(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 2.0, 3.0, 0.1, "A", 14.0, 3.7, True), (2, 1.0, 2.0, 3.0, None, "A", 14.0, 3.7, None)],
        "time bigint, x double, y double, z double, TAC_Reading double, pid string, energy double, "
        "magnitude double, is_intoxicated boolean")
    out = model.training_frame(df)
    assert out.columns == ["time", "x", "y", "z", "energy", "magnitude", "label"]
    assert out.count() == 1


def test_fits_bound_the_rows_of_a_task(spark, scratch, monkeypatch):
    """A reader packs a small training table into one task per core; MLlib keeps much more of each row than the file does."""
    from pyspark.ml import Pipeline
    seen, fit = [], Pipeline.fit
    monkeypatch.setattr(model, "FIT_ROWS", 40, raising=False)
    monkeypatch.setattr(Pipeline, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    path = scratch("fit-rows")
    (spark.range(400).select(*[((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(C.FEATURE_ORDER)],
                             (F.col("id") % 3 == 0).cast("double").alias("label"), (F.col("id") % 2).cast("int").alias("fold")).write.parquet(path))
    table = spark.read.parquet(path)
    model.fit_forest(table.drop("fold"), num_trees=2, max_depth=2)
    model.fit_folds(table, 2, num_trees=2, max_depth=2)
    assert seen == [10, 10, 10]


def test_folds_start_from_written_features(spark, scratch, monkeypatch):
    """Fold assignment reads its input several times; the as-of join behind it runs once."""
    from kinelab.operators import folds
    from kinelab.plans import ml_catalog
    d, seen, assign = scratch("tables"), [], folds.stratified_folds
    spark.range(600).selectExpr("id as event_id", "cast(timestamp_seconds(1704067200 + id * 3600) as timestamp_ntz) as ts", "id % 7 as user_id",
                                "if(id % 3 = 0, 'purchase', 'view') as event_type", "double(id % 90) as value",
                                "concat('{\"k\": ', id % 50, '}') as props").write.parquet(f"{d}/events.parquet")
    monkeypatch.setattr(folds, "stratified_folds", lambda df, **kw: seen.append(df) or assign(df, **kw))
    train = ml_catalog.training_table(spark, d)
    assert "Join" not in seen[0]._jdf.queryExecution().executedPlan().toString()
    labelled = seen[0].where(F.col(C.LABEL).isNotNull())
    assert train.count() == labelled.count() > 100
    assert {r["fold"] for r in train.select("fold").distinct().collect()} == set(range(C.NUM_FOLDS))
