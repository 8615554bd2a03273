"""Spark session defaults and lineage cuts.

On a cluster the session is created by the platform; ``get_session`` only fills in what
is unset. Checkpoints go to the shared folder named by ``spark.checkpoint.dir``; a local
folder is chosen only when that setting is absent (tests, laptops).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keep the range-join bins as equi-joins; never fall back to a cartesian plan
    "spark.sql.crossJoin.enabled": "false",
}


def sizing(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a given input volume: enough initial shuffle partitions that
    each holds about ``target_partition_bytes`` (AQE coalesces the small ones and splits
    skewed ones), scan splits of the same size. 100 TB -> ~400k shuffle partitions."""
    n = max(200, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
    }


def get_session(app: str = "fieldstack", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only if the cluster named none."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: no SparkContext, the server's setting applies)
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: lineage cuts and stream "
                               "checkpoints must survive the loss of any executor")
        # local mode only (tests, laptops): a private folder is as durable as the driver
        configured = tempfile.mkdtemp(prefix="fieldstack-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
