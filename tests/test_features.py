import math

from kinelab.operators import features


def test_training_features_golden(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 0.03), (4.0, 5.0, 6.0, 0.09)],
                               "x double, y double, z double, TAC_Reading double")
    feats, state = features.fit(df)
    rows = feats.orderBy("x").collect()
    assert [r.energy for r in rows] == [14.0, 77.0]
    assert math.isclose(rows[0].magnitude, 3.7416573868, rel_tol=1e-9)
    assert math.isclose(rows[1].magnitude, 8.7749643874, rel_tol=1e-9)
    assert [r.is_intoxicated for r in rows] == [False, True]
    st = state.collect()[0]
    assert st.energy.mean == 45.5 and math.isclose(st.energy.std, math.sqrt(((14 - 45.5) ** 2 + (77 - 45.5) ** 2)))


def test_scoring_features_only_energy_magnitude(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (4.0, 5.0, 6.0)], "x double, y double, z double")
    out = features.transform(df)
    assert out.columns == ["x", "y", "z", "energy", "magnitude"]


def test_label_thresholds(spark):
    for vals, want in [([0.03, 0.09, 0.05], [False, True, False]), ([0.0, 0.02, 0.01], [False] * 3)]:
        df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, TAC_Reading double")
        got = [r.is_intoxicated for r in features.with_label(df).orderBy("i").collect()]
        assert got == want


def test_unmatched_policy(spark):
    df = spark.createDataFrame([(0, None), (1, float("nan")), (2, 0.1)], "i int, TAC_Reading double")
    assert [r.is_intoxicated for r in features.with_label(df).orderBy("i").collect()] == [None, None, True]
    pos = features.with_label(df, unmatched="positive").orderBy("i").collect()
    assert [r.is_intoxicated for r in pos] == [True, True, True]


def test_energy_magnitude_edges(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0), (3.0, 4.0, 0.0)], "x double, y double, z double")
    rows = features.transform(df).orderBy("x").collect()
    assert [(r.energy, r.magnitude) for r in rows] == [(0.0, 0.0), (25.0, 5.0)]


def test_client_energy_is_overwritten_and_order_fixed(spark):
    df = spark.createDataFrame([(7, 1.0, 2.0, 3.0, 999.0)], "time bigint, x double, y double, z double, energy double")
    out = features.scoring_features(df)
    assert out.columns == ["time", "x", "y", "z", "energy", "magnitude"]
    assert out.collect()[0].energy == 14.0


def test_single_row_std_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 0.1)], "x double, y double, z double, TAC_Reading double")
    _, state = features.fit(df)
    st = state.collect()[0]
    assert st.energy.std is None and st.energy.mean == 14.0


def test_split_xy_drops_key_and_reading(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 0.1, "A", 14.0, 3.7, 1)],
                               "time bigint, x double, y double, z double, TAC_Reading double, pid string, "
                               "energy double, magnitude double, is_intoxicated int")
    out = features.split_xy(df)
    assert out.columns == ["time", "x", "y", "z", "energy", "magnitude", "is_intoxicated"]
    assert out.collect()[0].is_intoxicated is True
