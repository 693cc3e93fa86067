"""Property tests (hypothesis): the distributed order statistics and ranks
equal their single-machine definitions on arbitrary small inputs."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators.stats import exact_quantiles, range_row_number

values = st.lists(st.tuples(st.integers(0, 2), st.one_of(st.integers(-1000, 1000).map(float),
                                                          st.floats(-1e6, 1e6, allow_nan=False, width=32))),
                  min_size=1, max_size=60)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(values, st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_exact_quantile_property(spark, data, p):
    df = spark.createDataFrame([(g, float(v)) for g, v in data], "g int, v double")
    got = {r.g: r.q for r in exact_quantiles(df, "v", {"q": p}, keys=["g"]).collect()}
    for g in {g for g, _ in data}:
        vals = np.array([float(v) for gg, v in data if gg == g])
        exp = np.percentile(vals, p * 100)
        assert abs(got[g] - exp) <= 1e-9 * max(1.0, abs(exp)), (g, got[g], exp)


@SETTINGS
@given(values)
def test_range_row_number_property(spark, data):
    df = spark.createDataFrame([(i, g, float(v)) for i, (g, v) in enumerate(data)], "id int, g int, v double")
    ours = range_row_number(df, [F.col("g").asc(), F.col("v").asc(), F.col("id").asc()])
    ref = df.withColumn("rn2", F.row_number().over(Window.orderBy("g", "v", "id")))
    assert ours.join(ref, ["id", "g", "v"]).where(F.col("rn") != F.col("rn2")).count() == 0
