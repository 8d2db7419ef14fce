"""The run registry as a table.

Registry rows: run_id, run_name, end_time (NULL = unfinished).
Every pick is a hash aggregate keyed by run_name, so a run name with a
very large share of the rows is pre-aggregated map-side instead of sorted
in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def runs_named(registry: DataFrame, run_name) -> DataFrame:
    """P10: equality filter on run name (pushed down to the scan)."""
    return registry.where(F.col("run_name") == F.lit(run_name))


def unfinished(registry: DataFrame) -> DataFrame:
    """Runs without end_time."""
    return registry.where(F.col("end_time").isNull())


def _per_name(registry: DataFrame) -> DataFrame:
    """Per run name: unfinished count, newest unfinished id, newest finished run.

    Two hash aggregates, no sort: the largest run id per (name, end time),
    then per name the one at the latest end time (unique by then, so
    ``max_by`` is exact; ties on end time go to the larger run id).
    """
    open_ = registry.groupBy("run_name").agg(
        F.count_if(F.col("end_time").isNull()).alias("n_unfinished"),
        F.max(F.when(F.col("end_time").isNull(), F.col("run_id"))).alias("open_run"))
    fin = (registry.where(F.col("end_time").isNotNull())
           .groupBy("run_name", "end_time").agg(F.max("run_id").alias("run_id"))
           .groupBy("run_name").agg(F.max_by("run_id", "end_time").alias("fin_run"),
                                    F.max("end_time").alias("fin_end")))
    return open_.join(fin, on="run_name", how="left")


def newest_run(registry: DataFrame) -> DataFrame:
    """Per run name, the unfinished run first, else the newest end_time.

    Same row as ``row_number() over (partition by run_name order by
    end_time desc nulls first, run_id desc) = 1``, built from hash
    aggregates (a name with a very large share of rows is pre-aggregated
    map-side, never sorted in one task).
    """
    g = _per_name(registry)
    has_open = F.col("n_unfinished") > 0
    return g.select("run_name",
                    F.when(has_open, F.col("open_run")).otherwise(F.col("fin_run")).alias("run_id"),
                    F.when(has_open, F.lit(None)).otherwise(F.col("fin_end")).alias("end_time"))


def latest_run_status(registry: DataFrame) -> DataFrame:
    """T5 for every run name: (run_name, run_id, status).

    status: 'unfinished' (exactly one unfinished run, returned),
    'finished' (no unfinished run; the newest end_time, ties -> larger
    run_id), 'multiple_unfinished' (error: run_id NULL).
    """
    g = _per_name(registry)
    status = (F.when(F.col("n_unfinished") > 1, F.lit("multiple_unfinished"))
              .when(F.col("n_unfinished") == 1, F.lit("unfinished"))
              .otherwise(F.lit("finished")))
    run_id = (F.when(F.col("n_unfinished") > 1, F.lit(None))
              .when(F.col("n_unfinished") == 1, F.col("open_run"))
              .otherwise(F.col("fin_run")))
    return g.select("run_name", run_id.alias("run_id"), status.alias("status"))


def get_latest_run_id(registry: DataFrame, run_name):
    """T5 for one name, as the reference's function: returns the id or raises.

    Only the single result row reaches the driver.
    """
    rows = latest_run_status(runs_named(registry, run_name)).collect()
    if not rows:
        raise RuntimeError(f"Run with name {run_name} is not found.")
    row = rows[0]
    if row["status"] == "multiple_unfinished":
        raise RuntimeError("Registry has multiple unfinished runs. Expected one or none.")
    return row["run_id"]


def create_if_absent(registry: DataFrame, wanted: DataFrame) -> DataFrame:
    """New registry rows for wanted run names that have no run yet.

    ``wanted`` has run_name (and optionally run_id). Left-anti join: a
    shuffle on run_name of the distinct wanted names and registry names.
    """
    names = registry.select("run_name").distinct()
    new = wanted.dropDuplicates(["run_name"]).join(names, on="run_name", how="left_anti")
    if "run_id" not in new.columns:
        new = new.withColumn("run_id", F.concat(F.lit("run-"), F.col("run_name").cast("string")))
    return new.select("run_id", "run_name", F.lit(None).cast("timestamp").alias("end_time"))


def last_end_time(registry: DataFrame) -> DataFrame:
    """Newest end_time per run name (epoch seconds); NULL if none finished."""
    return registry.groupBy("run_name").agg(
        F.unix_seconds(F.max("end_time")).alias("last_end_s"))
