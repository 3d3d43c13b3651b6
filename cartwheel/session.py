"""SparkSession settings the operators rely on.

The operators only *read* session state; they never reconfigure a session
they were handed. ``get_session`` adds them to the submitter's session, whose
master and shuffle sizing stay as submitted; ``local_session`` is for tests,
tools and the bench.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every session must carry for the results to be right.
REQUIRED_CONF = {
    # Unzoned timestamp strings load as UTC; DATE(ts) is taken in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Spark 4 default; the cleaners use try_* / get so ANSI never throws on data.
    "spark.sql.ansi.enabled": "true",
}
# The JVM never compiles a method of more than 8,000 bytes of bytecode: such generated
# code is interpreted for every row. Beyond this limit Spark runs the operators by
# themselves, whose generated code it splits into small methods.
COMPILED_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Settings that make the plans scale (AQE re-plans joins from runtime sizes,
# splits skewed join partitions and coalesces small shuffle partitions).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let AQE split a hot join key even where that costs one more shuffle
    # (the fact's group-by otherwise reuses the join's partitioning).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A join side is broadcast only when its measured size is under this
    # bound (AQE checks it at runtime and keeps the sort-merge join beyond
    # it). A broadcast is copied to every executor, so the bound stays small;
    # the calendar, bounded by its day count, is broadcast explicitly.
    "spark.sql.autoBroadcastJoinThreshold": "4m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "4m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}


# What a session that was built elsewhere needs on top of REQUIRED_CONF for a
# hot order_id to be split before the fact's group-by.
SKEW_CONF = {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}

# For bucketed orders and items: a join on order_id and more columns may use a
# partitioning by order_id alone. Off by default, as fewer keys may be more skewed.
BUCKET_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "cartwheel",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session with the required and scale settings.

    The master and the number of shuffle partitions are the submitter's
    (``spark-submit`` options, ``spark-defaults.conf``); they are set here only
    when passed.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = {**REQUIRED_CONF, **COMPILED_CONF, **SCALE_CONF}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app_name: str = "cartwheel") -> SparkSession:
    """A session on this machine alone, for tests, tools and the bench."""
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    memory = {"spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "16g")}
    spark = get_session(f"local[{cores}]", shuffle_partitions, app_name, quiet | memory)
    spark.sparkContext.setLogLevel("ERROR")
    return spark
