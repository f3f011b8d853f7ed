"""Session settings and input spreading that wide, expression-heavy tables want."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The JVM never compiles a method above 8,000 bytes of bytecode. A stage over many columns
# passes that easily and would run interpreted; below this limit Spark falls back to
# per-operator projections, which it splits into small methods.
_METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def tune(spark: SparkSession) -> SparkSession:
    """Set the code-size limit unless the session has its own."""
    if spark.conf.get(_METHOD_LIMIT[0], None) in (None, "65535"):
        spark.conf.set(*_METHOD_LIMIT)
    return spark


# An input of this many splits or more is read as it is, however many cores there are.
_SMALL_INPUT = 64


def spread(scan: DataFrame) -> DataFrame:
    """Give a small scan one partition per core; a no-op when there are enough splits already.

    Text work per row is heavy next to reading it, so a file with a single row group would
    keep all but one core idle. For plain scans only: asking a frame with shuffles for its
    partitions would run them.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < min(cores, _SMALL_INPUT) else scan
