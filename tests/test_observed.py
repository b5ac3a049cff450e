"""What is observed while a table is written, and one-pass profiles, against passes of their own."""

from pyspark.sql import functions as F

from gridseries.operators import profile as P
from gridseries.operators.evaluate import error_histogram, error_metrics
from gridseries.operators.infinite import handle_infinite, infinity_metrics
from gridseries.operators.quantiles import brackets, quantiles
from gridseries.plans import views
from gridseries.session import materialize_observed


def test_quality_profile_is_the_three_profiles(spark, small):
    frame = views.dirty(spark, small)
    found = P.quality_profile(frame)
    assert found["missing_values"] == {
        r["column"]: {"count": r["count"], "percent": r["percent"]} for r in P.missing_profile(frame).collect()}
    assert found["inf_values"] == {r["column"]: r["count"] for r in P.infinity_profile(frame).collect()}
    assert found["duplicates"] == P.duplicate_profile(frame).first().asDict()
    assert all(found.values())


def test_quality_profile_of_nothing(spark, small):
    found = P.quality_profile(views.dirty(spark, small).limit(0))
    assert found == {"missing_values": {}, "inf_values": {}, "duplicates": {"count": 0, "percent": None}}


def test_observed_brackets(spark):
    frame = spark.range(30_000).select((F.col("id") * 7919 % 30_011).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    stored, seen = materialize_observed(frame, "observed", brackets(["x", "y"], [0.25, 0.75]))
    assert seen["count of x"] == 30_000 and seen["count of y"] == 0
    assert quantiles(stored, ["x", "y"], [0.25, 0.75], gather_rows=10, seen=seen) == quantiles(
        frame, ["x", "y"], [0.25, 0.75], gather_rows=10)


def test_observed_infinities(spark, small):
    frame = views.dirty(spark, small)
    stored, seen = materialize_observed(frame, "observed", infinity_metrics(frame))
    mine, other = (handle_infinite(f, "replace", seen=s).agg(F.sum("T2M"), F.count("T2M")).first()
                   for f, s in ((stored, seen), (frame, None)))
    assert mine[1] == other[1] and abs(mine[0] - other[0]) < 1e-6


def test_observed_errors(spark):
    frame = spark.createDataFrame([(x,) for x in (-1.0, 0.5, 3.0, float("nan"), None)], "e double")
    stored, seen = materialize_observed(frame, "observed", error_metrics(["e"]))
    assert abs(seen["mean of e"] - 2.5 / 3) < 1e-12
    assert error_histogram(stored, "e", 4, seen).collect() == error_histogram(frame, "e", 4).collect()
