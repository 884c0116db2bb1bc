"""Run two queries with injected task failures (first attempt of every task
of the marked stages raises); print a digest of the results as JSON."""

import hashlib
import json
import sys

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from vidpulse.operators.viewers import running_count  # noqa: E402
from vidpulse.plans import dashboard  # noqa: E402
from vidpulse.schema import STOP_WORDS  # noqa: E402
from vidpulse.sources.fixtures import lv_comments, lv_events  # noqa: E402

inject = sys.argv[3] == "1"
spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
         .config("spark.checkpoint.dir", sys.argv[4]).getOrCreate())
spark.sparkContext.setLogLevel("OFF")


@F.udf(T.BooleanType())
def flaky(x):
    ctx = TaskContext.get()
    if inject and ctx is not None and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return True


def digest(df):
    cols = sorted(df.columns)
    rows = sorted("|".join(str(r[c]) for c in cols) for r in df.collect())
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


sf = sys.argv[2]
ev = lv_events(spark, sf).where(flaky(F.col("event_id")))           # fails in the scan stage
rc = running_count(ev, "play")
rc = rc.where(flaky(F.col("running")))                                # fails after the range/window shuffles
cm = lv_comments(spark, sf).where(flaky(F.col("video_id")))
mf = dashboard.map_features(dashboard.dashboard_inputs(ev, cm, STOP_WORDS, None, "6 hours"))
mf = mf.where(flaky(F.col("video_id")))
print(json.dumps({"running": digest(rc), "map": digest(mf), "n": rc.count()}))
