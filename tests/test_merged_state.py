"""Merged batch states against one pass over all rows."""

import random

import pytest

from kinelab.operators import drift, features, merged_state

SCHEMA = "energy double, magnitude double, is_intoxicated boolean"


def states(spark, path, parts):
    for b, part in enumerate(parts):
        merged_state.write_batch_state(spark.createDataFrame(part, SCHEMA), path, b)
    return merged_state.read_batch_states(spark, path)


@pytest.mark.parametrize("groups", [1, 4])
def test_any_split_gives_the_fitted_state(spark, scratch, monkeypatch, groups):
    monkeypatch.setattr(merged_state, "GROUPS", groups)
    rng = random.Random(groups)
    rows = [(1e6 + rng.random() if rng.random() < 0.9 else None, rng.random(), rng.choice([True, False, None])) for _ in range(120)]
    cuts = sorted(rng.sample(range(120), 5))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 120])] + [[], [(None, None, None)]]
    path = scratch("states")
    state = merged_state.merged(states(spark, path, parts))
    whole = spark.createDataFrame(rows, SCHEMA)
    got, want = merged_state.fitted(state).first(), features.fit_stats(whole).first()
    for c in ("energy", "magnitude"):
        assert got[c]["mean"] == pytest.approx(want[c]["mean"], rel=1e-14) and got[c]["std"] == pytest.approx(want[c]["std"], rel=1e-9)
    assert sorted(map(tuple, merged_state.counts(state).collect())) == sorted(map(tuple, drift.class_counts(whole).collect()))


def test_a_replaced_batch_replaces_its_part(spark, scratch):
    path = scratch("states")
    states(spark, path, [[(1.0, 1.0, True)], [(100.0, 5.0, False)]])
    merged_state.state_writer(path)(spark.createDataFrame([(3.0, 2.0, True)], SCHEMA), 1)
    state = merged_state.merged(merged_state.read_batch_states(spark, path))
    assert merged_state.fitted(state).first()["energy"]["mean"] == 2.0
    assert {r["category"]: r["cnt"] for r in merged_state.counts(state).collect()} == {"false": 0, "true": 2}


def test_one_value_and_none(spark, scratch):
    state = merged_state.fitted(merged_state.merged(states(spark, scratch("one"), [[(2.0, None, None)]]))).first()
    assert tuple(state["energy"]) == (2.0, None) and tuple(state["magnitude"]) == (None, None)
