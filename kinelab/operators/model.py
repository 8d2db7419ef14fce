"""Random forest training, cross-validation, scoring.

MLlib grows all trees of the forest level by level over the distributed
data; nothing is collected to the driver but the fitted trees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelab import config as C
from kinelab.functions import nan_to_null

#: Training rows in one task of a fit: MLlib keeps about 1.3 KB of each (bagging counts and nodes of 100 trees).
FIT_ROWS = 250_000
#: Value of a feature that a request or window does not have.
MISSING = 0.0


def binary_metrics(df: DataFrame, y_true: str, y_pred: str,
                   group_cols: Sequence[str] = ()) -> DataFrame:
    """Tp, fp, fn, tn, precision, recall, f1, accuracy per group.

    One aggregate pass with conditional counts; 0 on zero division.
    """
    t, p = F.col(y_true).cast("boolean"), F.col(y_pred).cast("boolean")
    g = df.groupBy(*group_cols).agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))

    def ratio(num, den):
        return F.when(den > 0, num / den).otherwise(F.lit(0.0))

    return g.select(
        *group_cols, "tp", "fp", "fn", "tn",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"))


def metrics_long(wide: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., metric, value) from binary_metrics."""
    args = ", ".join(f"'{m}', {m}" for m in C.SCORE_METRICS)
    return wide.selectExpr(*group_cols, f"stack({len(C.SCORE_METRICS)}, {args}) as (metric, value)")


def forest_pipeline(features: Sequence[str] = C.FEATURE_ORDER, num_trees: int = C.NUM_TREES,
                    max_depth: int = C.MAX_DEPTH, seed: int = C.SEED,
                    max_memory_mb: int = 256) -> Pipeline:
    """M4: assembler + forest (gini, bootstrap, sqrt features, maxBins 32).

    ``max_memory_mb`` only sets how many nodes are split per pass over the
    data (more memory, fewer passes); the trees do not change.
    """
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"),
        RandomForestClassifier(featuresCol="features", labelCol="label",
                               numTrees=num_trees, maxDepth=max_depth, seed=seed,
                               cacheNodeIds=True, maxMemoryInMB=max_memory_mb),
    ])


def fill_missing(df: DataFrame, features: Sequence[str] = C.FEATURE_ORDER) -> DataFrame:
    """NULL and NaN features become ``MISSING``, in training and scoring alike: no row is dropped."""
    return df.withColumns({c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(MISSING)) for c in features})


def training_frame(df: DataFrame, label: str = C.LABEL,
                   features: Sequence[str] = C.FEATURE_ORDER) -> DataFrame:
    """P4 + P5: features + double label; rows with NULL label are dropped."""
    extra = [c for c in ("fold",) if c in df.columns]
    return (fill_missing(df.where(F.col(label).isNotNull()), features)
            .select(*[F.col(c).cast("double").alias(c) for c in features],
                    F.col(label).cast("double").alias("label"), *extra))


def in_tasks(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A written training frame in tasks of about ``FIT_ROWS`` rows; a reader packs small files into one task per core."""
    tasks = -(-df.count() // (rows or FIT_ROWS))
    return df if tasks <= df.rdd.getNumPartitions() else df.repartition(tasks)


def fit_forest(df: DataFrame, **kw) -> PipelineModel:
    """M6: fit on all rows of a training frame."""
    return forest_pipeline(**kw).fit(in_tasks(df))


def cross_validate(df: DataFrame, k: int = C.NUM_FOLDS, parallelism: int = 2,
                   **kw) -> DataFrame:
    """M5: per fold, fit on the other folds; score train and test splits.

    ``df`` is a training frame with a ``fold`` column (W2). Returns the long
    table (fold, split, metric, value). All models score the frame in one
    pass over one scan; fold and split are columns of the aggregate.
    Fits are submitted ``parallelism`` at a time (as MLlib's CrossValidator
    does): each fit is a sequence of per-level jobs with a serial driver
    step, so two side by side keep the executors busy; more only contend
    (measured at sf0.1: 2 -> 45 s, 5 -> 59 s, 1 -> 51 s).
    """
    models = fit_folds(df, k, parallelism, **kw)
    return metrics_long(fold_confusions(df, models), ["fold", "split"])


def fit_folds(df: DataFrame, k: int = C.NUM_FOLDS, parallelism: int = 2, **kw) -> list[PipelineModel]:
    """One forest per fold, fitted on the other folds."""
    from concurrent.futures import ThreadPoolExecutor
    df = in_tasks(df)
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, k))) as pool:
        return list(pool.map(lambda f: forest_pipeline(**kw).fit(df.where(F.col("fold") != f)), range(k)))


def fold_confusions(df: DataFrame, models: Sequence[PipelineModel]) -> DataFrame:
    """Binary metrics (A8) per (fold, split): all models score the frame in one pass."""
    cols = ["label", "fold"]
    scored = df
    for f, model in enumerate(models):
        done = [f"_p{i}" for i in range(f)]
        scored = (model.transform(scored)
                  .select(*cols, *C.FEATURE_ORDER, *done, F.col("prediction").alias(f"_p{f}")))
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("model"), F.col(f"_p{f}").alias("prediction"))
                               for f in range(len(models))]))
    long = scored.select("label", F.col("fold").alias("_fold"), each.alias("m")).select(
        "label", "m.prediction", F.col("m.model").alias("fold"),
        F.when(F.col("_fold") == F.col("m.model"), F.lit("test")).otherwise(F.lit("train")).alias("split"))
    return binary_metrics(long, "label", "prediction", ["fold", "split"])


def predict(model: PipelineModel, features: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """M7: prediction (0/1) per row."""
    return model.transform(fill_missing(features)).select(*keep, F.col("prediction").cast("int").alias("prediction"))


def save_model(model: PipelineModel, path: str) -> None:
    """MLlib persistence (no pickle)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_latest_model(registry: DataFrame, run_name, root: str) -> PipelineModel:
    """M8: resolve the newest run (T5) and load the model saved under it."""
    from kinelab.operators.registry import get_latest_run_id
    run_id = get_latest_run_id(registry, run_name)
    return load_model(f"{root}/{run_id}/model")
