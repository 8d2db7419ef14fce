import json
import math
import os

import pytest

from kinelab.operators import drift
from kinelab.sources import telemetry as tel

# The reference's shipped telemetry documents.
TRAIN_DOC = {"is_intoxicated": {"false": 29420, "true": 9456}}
LIVE_DOC = {"timestamp": {"0": 1735737600000, "1": 1735740720000, "2": 1735753500000,
                          "3": 1735808460000, "4": 1735780260000},
            "is_intoxicated": {"0": True, "1": False, "2": False, "3": False, "4": True}}


def test_psi_pairs(spark):
    pairs = spark.createDataFrame([("a", .5, .6), ("a", .5, .4), ("b", .7, .7), ("b", .3, .3)],
                                  "group string, p double, q double")
    got = {r.group: r.psi for r in drift.psi_pairs(pairs).collect()}
    assert math.isclose(got["a"], 0.04054651, rel_tol=1e-6)
    assert got["b"] == 0.0


def test_psi_golden_from_documents(spark, tmp_path):
    d = tmp_path / "tel"
    os.makedirs(d / "train")
    os.makedirs(d / "live")
    (d / "train" / "data_dist.json").write_text(json.dumps(TRAIN_DOC))
    (d / "live" / "live_data_dist.json").write_text(json.dumps(LIVE_DOC))
    counts = tel.read_class_distribution(spark, str(d / "train"))
    live = tel.read_column_log(spark, str(d / "live")).withColumn("event_id", tel.F.col("row").cast("int"))
    latest = drift.latest_n(live, 3)
    assert sorted(r.is_intoxicated for r in latest.collect()) == [False, False, True]
    psi = drift.psi(counts, latest).collect()
    assert len(psi) == 1 and psi[0].target == "is_intoxicated"
    assert math.isclose(psi[0].psi, 0.03981252187349896, rel_tol=1e-12)


def test_guard_fewer_than_n_rows(spark):
    log = spark.createDataFrame([(1, True, 1), (2, False, 2)], "timestamp bigint, is_intoxicated boolean, event_id int")
    assert drift.latest_n(log, 3).count() == 0
    counts = spark.createDataFrame([("is_intoxicated", "false", 5), ("is_intoxicated", "true", 5)],
                                   "target string, category string, cnt bigint")
    assert drift.psi(counts, drift.latest_n(log, 3)).count() == 0


def test_zero_count_class(spark):
    log = spark.createDataFrame([(i, False, i) for i in range(3)], "timestamp bigint, is_intoxicated boolean, event_id int")
    counts = drift.class_counts(log)
    assert sorted((r.category, r.cnt) for r in counts.collect()) == [("false", 3), ("true", 0)]
    train = spark.createDataFrame([("is_intoxicated", "false", 1), ("is_intoxicated", "true", 1)],
                                  "target string, category string, cnt bigint")
    psi = drift.psi(train, drift.latest_n(log, 3)).collect()[0].psi
    eps = 1e-100
    pf, pt, qf, qt = 0.5 + eps, 0.5 + eps, 1.0 + eps, 0.0 + eps
    want = (qf - pf) * math.log(qf / pf) + (qt - pt) * math.log(qt / pt)
    assert math.isclose(psi, want, rel_tol=1e-9) and psi > 100


def test_class_distribution_roundtrip(spark, scratch):
    df = spark.createDataFrame([(True,), (False,), (False,), (None,)], "is_intoxicated boolean")
    path = scratch("dist")
    tel.write_class_distribution(drift.class_counts(df), path)
    back = sorted((r.target, r.category, r.cnt) for r in tel.read_class_distribution(spark, path).collect())
    assert back == [("is_intoxicated", "false", 2), ("is_intoxicated", "true", 1)]
    text = spark.read.text(path).collect()[0].value
    assert json.loads(text) == {"is_intoxicated": {"false": 2, "true": 1}}


def test_column_log_roundtrip(spark, scratch):
    log = spark.createDataFrame([(i, 1000 * i, i % 2 == 0) for i in range(25)],
                                "event_id bigint, timestamp bigint, is_intoxicated boolean")
    path = scratch("collog")
    tel.write_column_log(log, path, rows_per_doc=10)
    assert spark.read.text(path).count() == 3
    back = sorted((int(r.row), r.timestamp, r.is_intoxicated) for r in tel.read_column_log(spark, path).collect())
    assert back == [(i, 1000 * i, i % 2 == 0) for i in range(25)]


def test_quantile_disc_matches_sorting(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    vals = [int(v) for v in rng.integers(-10**15, 10**15, 3001)] + [7] * 2000  # a hot value
    df = spark.createDataFrame([(v,) for v in vals], "v bigint")
    s = sorted(vals)
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        assert drift.quantile_disc(df, "v", q) == s[int((len(s) - 1) * q)]
    dbl = spark.createDataFrame([(float(x) / 7,) for x in range(1000)], "v double")
    assert drift.quantile_disc(dbl, "v", 0.5) == sorted(float(x) / 7 for x in range(1000))[499]


def test_column_log_aligns_row_labels(spark, tmp_path):
    d = tmp_path / "log"
    os.makedirs(d)
    doc = {"timestamp": {"0": 10, "1": 20}, "is_intoxicated": {"1": True, "2": False}}
    (d / "doc.json").write_text(json.dumps(doc))
    got = sorted((r.row, r.timestamp, r.is_intoxicated) for r in tel.read_column_log(spark, str(d)).collect())
    assert got == [("0", 10, None), ("1", 20, True), ("2", None, False)]
