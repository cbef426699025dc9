"""Session helpers.

The library never builds its own session inside an operator: every
operator takes a DataFrame and returns a DataFrame.  These helpers only
exist for scripts, tests and the benchmark, plus the one thing operators
do need from the session -- a reliable checkpoint directory.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Configuration a production job would also set.  AQE re-plans joins from
# runtime sizes, coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete reliable checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tillwise", extra: dict | None = None) -> SparkSession:
    """A local session for tests, scripts and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TILLWISE_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the reliable checkpoint directory of this session.

    On a cluster the directory is named by ``spark.checkpoint.dir`` (a shared
    file system); we read it and use it as is.  Only a local master may go
    without: it gets a fresh scratch directory.  On a cluster executors could
    not share that, so a missing setting is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect client: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tillwise-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def cluster_conf(input_bytes: int, total_cores: int,
                 scan_split_bytes: int = 512 << 20,
                 shuffle_bytes_per_partition: int = 1 << 30) -> dict[str, str]:
    """Session settings for a cluster run, sized from the input instead of fixed.

    * scans are split at ``scan_split_bytes`` (512 MB: ~200k tasks for 100 TB);
    * shuffles start with one partition per GB of input, which AQE
      then coalesces -- after column pruning and map-side partial aggregation
      the shuffled bytes are a fraction of the input, so partitions stay far
      below executor memory -- and skewed partitions are split;
    * the rank operators size their range partitions from the rows they rank;
    * checkpoint files are deleted with their DataFrames.

    ``spark.checkpoint.dir`` is not set here: it must name the cluster's
    shared file system and comes from the deployment.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // shuffle_bytes_per_partition))
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.session.timeZone": "UTC",
    }
