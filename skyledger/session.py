"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


#: The JVM does not compile methods above this many bytes of bytecode; wide rows
#: reach it, and Spark then generates split methods instead.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")
#: Shuffle files go when the action that wrote them ends. Else they stay until the driver collects
#: garbage, which it hardly does while executors do the work: those of all steps of a run pile up.
SHUFFLE_FILES = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def tune(spark: SparkSession) -> SparkSession:
    """Settings that can still be changed in a session someone else opened."""
    for setting in (METHOD_LIMIT, SHUFFLE_FILES):
        spark.conf.set(*setting)
    return spark


#: Bytes of input that one shuffle partition should get before adaptive merging.
PARTITION_BYTES = 192 << 20


def settings(builder: SparkSession.Builder, input_bytes: int | None = None) -> SparkSession.Builder:
    """Adaptive plans (skew splits, partition sizes chosen at run time) and UTC dates.

    Adaptive execution only merges partitions, so a job over a large input has to
    start with enough of them: give ``input_bytes``.
    """
    if input_bytes:
        first = max(200, -(-input_bytes // PARTITION_BYTES))
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(first))
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(*METHOD_LIMIT)
        .config(*SHUFFLE_FILES)
    )


def local_session(cores: int | str = "*", name: str = "skyledger", memory: str = "8g") -> SparkSession:
    return (
        settings(SparkSession.builder.master(f"local[{cores}]").appName(name))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
