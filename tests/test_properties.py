"""Property tests: the range-partitioned running sum equals a plain window
for random keys, weights, ties in time and partition counts."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from vidpulse.operators.prefix import running_sum

rows = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 20), st.integers(-2, 3)),  # key (skewed range), time, weight
    min_size=1,
    max_size=120,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, parts=st.integers(1, 9), keyed=st.booleans())
def test_running_sum_matches_window(spark, data, parts, keyed):
    df = spark.createDataFrame([(i, k, t, w) for i, (k, t, w) in enumerate(data)], "event_id long, k long, t long, w long")
    keys = ["k"] if keyed else []
    got = running_sum(df, ["t", "event_id"], keys, F.col("w"), num_partitions=parts)
    frame = Window.partitionBy(*keys).orderBy("t", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("want", F.sum("w").over(frame))
    res = {r.event_id: r.running for r in got.collect()}
    exp = {r.event_id: r.want for r in want.collect()}
    assert res == exp
