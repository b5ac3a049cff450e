"""Properties on generated tables; few examples, as each one runs Spark jobs."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridseries.operators import duplicates, missing, outliers, profile, scaling
from gridseries.operators.quantiles import order_statistics

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
NUMBER = st.floats(-1e6, 1e6, allow_nan=False).map(lambda v: round(v, 3))
GAPPY = st.lists(st.one_of(st.none(), NUMBER), min_size=1, max_size=30)


def table_of(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, y double").coalesce(2)


@FEW
@given(GAPPY)
def test_interpolated_values_lie_between_known_ones(spark, values):
    known = [v for v in values if v is not None]
    filled = missing.fill_missing(table_of(spark, values), "interpolate", ["i"], block_rows=4).orderBy("i").collect()
    got = [r["y"] for r in filled]
    assert len(got) == len(values)
    if not known:
        assert got == values
    else:
        slack = 1e-9 * max(1.0, max(abs(v) for v in known))
        assert all(min(known) - slack <= v <= max(known) + slack for v in got)
        assert all(g == v for g, v in zip(got, values) if v is not None)


@FEW
@given(st.lists(NUMBER, min_size=1, max_size=30), st.data())
def test_order_statistics_are_the_sorted_values(spark, values, data):
    rank = data.draw(st.integers(0, len(values) - 1))
    table = table_of(spark, values)
    got = order_statistics(table, {"y": [rank]}, {"y": len(values)}, gather_rows=3)
    assert got["y"][rank] == sorted(values)[rank]


@FEW
@given(st.lists(st.integers(0, 5), min_size=1, max_size=30))
def test_duplicates_add_up(spark, values):
    table = spark.createDataFrame([(v,) for v in values], "v long")
    kept = duplicates.remove_duplicates(table).count()
    assert kept == len(set(values))
    assert profile.duplicate_profile(table).first()["count"] == len(values) - kept


@FEW
@given(st.lists(NUMBER, min_size=4, max_size=30))
def test_clipped_values_have_no_outliers_left(spark, values):
    table = table_of(spark, values).select("y")
    found = outliers.detect_outliers(table, "iqr", 1.5)
    clipped = outliers.treat_outliers(table, "clip", found)
    for o in found:
        assert clipped.where(f"y < {o.lower!r}D or y > {o.upper!r}D").count() == 0
    assert clipped.count() == len(values)


@FEW
@given(st.lists(NUMBER, min_size=2, max_size=30))
def test_standard_scaling_has_mean_zero_and_unit_deviation(spark, values):
    scaled, _ = scaling.scale_features(table_of(spark, values), "standard", ["y"])
    got = [r["y"] for r in scaled.collect()]
    assert math.isclose(sum(got) / len(got), 0.0, abs_tol=1e-6)
    spread = math.sqrt(sum(v * v for v in got) / len(got))
    assert math.isclose(spread, 1.0, rel_tol=1e-6) or all(abs(v) < 1e-6 for v in got)
