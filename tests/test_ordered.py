"""Order-dependent operators against pandas, plain and with groups cut into ranges."""

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException

from gridseries.functions.columns import nan_to_null
from gridseries.operators import ordered

ROWS = 1500


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({
        "k": rng.choice([1, 2, 3, 4], ROWS, p=[0.6, 0.25, 0.14, 0.01]),
        "t": rng.integers(0, 30, ROWS), "i": np.arange(ROWS), "y": rng.normal(size=ROWS)})
    pdf.loc[rng.random(ROWS) < 0.5, "y"] = np.nan
    pdf.loc[rng.random(ROWS) < 0.03, "y"] = np.inf
    pdf.loc[rng.random(ROWS) < 0.03, "y"] = -np.inf
    pdf.loc[pdf.k == 4, "y"] = np.nan
    pdf["s"] = np.where(rng.random(ROWS) < 0.8, None, pdf.i.astype(str))
    return pdf


@pytest.fixture(scope="module")
def table(spark, frame):
    return nan_to_null(spark.createDataFrame(frame)).cache()


def by_row(result, column):
    return result.toPandas().set_index("i")[column].sort_index()


def placed(values, order):
    values = values.copy()
    values.index = order
    return values.sort_index()


# None: plain windows; 10,000: checked, nothing hot; 9: ranges inside equal values of the first column.
@pytest.mark.parametrize("block", [None, 10_000, 60, 9])
def test_grouped(table, frame, block):
    ordered_rows = frame.sort_values(["k", "t", "i"])
    groups = ordered_rows.groupby("k")
    expected = groups.y.transform(lambda x: x.interpolate(method="linear", limit_direction="both"))
    got = by_row(ordered.interpolate(table, ["y"], ["k"], ["t", "i"], block), "y")
    pd.testing.assert_series_equal(got, placed(expected, ordered_rows.i), check_exact=True, check_names=False)

    got = by_row(ordered.forward_fill(table, ["s"], ["k"], ["t", "i"], block), "s")
    assert got.fillna("-").tolist() == placed(groups.s.ffill(), ordered_rows.i).fillna("-").tolist()

    lagged = ordered.lag_columns(table, {"a": ("i", 1), "b": ("i", 12)}, ["k"], ["t", "i"], block)
    for name, n in (("a", 1), ("b", 12)):
        expected = placed(groups.i.shift(n), ordered_rows.i)
        pd.testing.assert_series_equal(by_row(lagged, name).astype(float), expected, check_names=False)

    got = by_row(ordered.add_positions(table, "rn", ["k"], ["t", "i"], block), "rn")
    assert got.tolist() == placed(groups.cumcount() + 1, ordered_rows.i).tolist()


@pytest.mark.parametrize("block", [10_000, 60])
def test_whole_table(table, frame, block):
    ordered_rows = frame.sort_values(["t", "i"])
    expected = ordered_rows.y.interpolate(method="linear", limit_direction="both")
    got = by_row(ordered.interpolate(table, ["y"], [], ["t", "i"], block), "y")
    pd.testing.assert_series_equal(got, placed(expected, ordered_rows.i), check_exact=True, check_names=False)
    got = by_row(ordered.forward_fill(table, ["s"], [], ["t", "i"], block), "s")
    assert got.fillna("-").tolist() == placed(ordered_rows.s.ffill(), ordered_rows.i).fillna("-").tolist()


def test_positions_by_text(table):
    got = ordered.add_positions(table.where("s is not null"), "rn", [], ["s", "i"], 20).toPandas()
    assert got.sort_values("s").rn.tolist() == list(range(1, len(got) + 1))


def test_null_keys_and_null_order_values_stay(spark):
    rows = [(None, 1, 5.0), (None, 2, None), (1, None, 1.0), (1, 3, None), (1, 4, 3.0)]
    table = spark.createDataFrame(rows, "k int, t int, y double")
    for block in (None, 1):
        got = ordered.forward_fill(table, ["y"], ["k"], ["t"], block).collect()
        assert sorted(r["y"] for r in got) == [1.0, 1.0, 3.0, 5.0, 5.0]


def largest_range(ranges, keys):
    assert ranges.blocks
    return ranges.df.groupBy(*keys, *ranges.blocks).count().agg({"count": "max"}).first()[0]


def test_no_task_gets_a_hot_group(spark):
    """Half of the rows share one key; after the cuts no window partition holds more than a few blocks."""
    table = spark.range(4000).selectExpr("case when id % 2 = 0 then 0 else id end as k", "id as t")
    assert largest_range(ordered.split_hot(table, ["k"], ["t"], 100), ["k"]) < 200


def test_every_hot_group_is_cut(spark):
    table = spark.range(60 * 700).selectExpr("id % 700 as k", "id as t")
    assert largest_range(ordered.split_hot(table, ["k"], ["t"], 50), ["k"]) <= 100


def test_ranges_do_not_grow_with_the_table(spark):
    table = spark.range(40_000).selectExpr("id as t")
    assert largest_range(ordered.split_hot(table, [], ["t"], 80), []) <= 160


@pytest.mark.parametrize("order", [["s"], ["d"], ["same"], ["same", "s"]])
def test_any_order_column_is_cut(spark, order):
    """Texts with a long common start, decimals, equal values."""
    table = spark.range(6000).selectExpr(
        "concat('a long common start of all texts ', lpad(id, 9, '0')) as s", "cast(id as decimal(30,4)) as d", "1 as same")
    assert largest_range(ordered.split_hot(table, [], order, 100), []) <= 200


def test_categories_with_a_common_start_are_cut(spark, small):
    names = spark.read.parquet(f"{small}/customer.parquet").selectExpr("'c_name' as column", "c_name as category")
    ranges = ordered.split_hot(names, ["column"], ["category"], 30)
    assert largest_range(ranges, ["column"]) <= 60


def test_what_cannot_be_cut_is_refused(spark):
    table = spark.range(10).selectExpr("id as k", "map(id, id) as m")
    with pytest.raises(AnalysisException):
        ordered.split_hot(table, [], ["m"], 5)
    with pytest.raises(ValueError, match="whole table"):
        ordered.split_hot(table, [], ["k"], None)


def test_edges_by_hand(spark):
    rows = [(1, i, v) for i, v in enumerate([None, 1.0, None, 3.0, None])] + [(2, i, None) for i in range(3)]
    table = spark.createDataFrame(rows, "k int, t int, y double")
    got = ordered.interpolate(table, ["y"], ["k"], ["t"], None).orderBy("k", "t").collect()
    assert [r["y"] for r in got] == [1, 1, 2, 3, 3, None, None, None]


def test_large_whole_numbers_keep_their_order(spark):
    """Numbers beyond 2**53 share doubles; the cuts must still follow the numbers themselves."""
    start = 2 ** 60
    table = spark.range(600).selectExpr(f"id % 300 + {start} as t", "id as i")
    got = ordered.add_positions(table, "rn", [], ["t", "i"], 20).toPandas().sort_values(["t", "i"])
    assert got.rn.tolist() == list(range(1, 601))


def test_null_order_values_form_ranges_of_their_own(spark):
    table = spark.range(400).selectExpr("case when id % 2 = 0 then id end as t", "id as i")
    got = ordered.add_positions(table, "rn", [], ["t", "i"], 20).toPandas().sort_values("rn")
    assert got.t.isna().tolist() == [True] * 200 + [False] * 200
    assert got.i.tolist()[:200] == list(range(1, 400, 2))
