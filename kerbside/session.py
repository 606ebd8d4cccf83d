"""Spark session settings shared by the library, the tests and the bench.

The library itself never creates a session: every operator takes and
returns a DataFrame.  These helpers only exist so that tests, the bench
and ad-hoc runs get the same, cluster-shaped configuration.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  Wall-clock/instant conversions assume a UTC
# session zone; ANSI keeps the reference's "raise on bad cast / divide by
# zero" behaviour unless an operator asks for the try_* form explicitly.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # dimension/lookup tables are broadcast by size; anything larger than
    # this is shuffled.  Operators that force a broadcast check a bound first.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "kerbside", extra: dict | None = None) -> SparkSession:
    """Local session with the library's settings (tests, bench)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(CORE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("KERBSIDE_DRIVER_MEM", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    return spark


#: Settings that results depend on; everything else is the caller's choice.
SEMANTIC = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")


def apply_core_conf(spark: SparkSession) -> None:
    """Set what the queries' results depend on (UTC zone, ANSI); sizes, thresholds
    and adaptive execution stay as the session has them."""
    for k in SEMANTIC:
        spark.conf.set(k, CORE_CONF[k])


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    filesystem).  Only when it is unset in a local session -- tests -- do
    we pick a scratch folder ourselves; a cluster session without the
    setting is an error, since a machine-local folder would not survive the
    loss of that machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
        d = tempfile.mkdtemp(prefix="kerbside-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of Parquet.

    * scan splits of ``target_partition_bytes`` (fewer, larger tasks than
      the 128 MB default at 100 TB: ~400k instead of ~800k);
    * initial shuffle partitions = input / target, at least 2 x cores -- AQE
      then coalesces small partitions to the advisory size and splits skewed ones;
    * broadcast only under 10 MB (the default), so executor memory never
      holds a side that grows with the data.
    """
    parts = max(2 * cores, input_bytes // target_partition_bytes + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    }


def apply_cluster_conf(spark: SparkSession, input_bytes: int, cores: int | None = None) -> None:
    """Set :func:`cluster_conf` on a running session (runtime SQL settings only)."""
    cores = cores or spark.sparkContext.defaultParallelism
    for k, v in cluster_conf(input_bytes, cores).items():
        spark.conf.set(k, v)
