"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

MEASURED_BROADCAST = "10MB"
ARROW_BATCH_BYTES = 8 << 20  # a batch for Python ends here: rows may be long texts or whole shards


def tune(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` that broadcasts join sides by their measured size, never by an estimate.

    Before a query runs, Spark guesses sizes from compressed files and would
    send a side that unfolds to many times that, such as coded texts, to every
    task. Adaptive execution knows the true size once a side is shuffled. The
    caller's settings are taken over and left as they are; tables read with the
    returned session run with its own.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.adaptive.enabled", "true")
    own.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    own.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", MEASURED_BROADCAST)
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    return own
