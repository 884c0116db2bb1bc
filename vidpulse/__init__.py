"""vidpulse: live-video audience analytics on Spark.

Every transform is a function ``DataFrame -> DataFrame`` that works on a
batch frame (``spark.read``) and, where Spark allows it, on a streaming
frame (``spark.readStream``).  Sub-packages:

* ``sources``   - event files, Kafka, envelope decode, fixture views, serving tables
* ``functions`` - column expressions (text cleaning, colour ramp, draws, labels)
* ``operators`` - counts, running totals, viewers, text, sentiment, sampling, routing
* ``plans``     - composed queries (dashboard) and the query registry
* ``streaming`` - sinks and Structured Streaming jobs
"""

__all__ = ["session", "schema"]
