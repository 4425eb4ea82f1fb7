"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster job should run with. AQE re-plans joins from runtime sizes
# (a side is broadcast only when its measured size is under the threshold),
# coalesces small shuffle partitions and splits skewed join partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Streaming session windows merge sessions inside each input partition
    # before the shuffle: a hot customer ships sessions, not raw events.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


MB = 1 << 20


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * MB) -> dict[str, str]:
    """Settings for a large cluster, sized from the input volume.

    Scan splits and shuffle partitions aim at ``target_partition_bytes`` each
    (fits executor memory with room for sort buffers, spills otherwise); the
    initial shuffle partition count is at least three waves of the cluster's
    cores and is coalesced by AQE toward the advisory size, not toward
    parallelism. Example: 100 TB on 1000 executors x 8 cores gives about
    400 000 initial shuffle partitions, coalesced at run time.
    """
    partitions = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    size = f"{target_partition_bytes // MB}m"
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * target_partition_bytes // MB}m",
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "goldvein", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with ``RECOMMENDED_CONF``; used by tests and bench."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is only read here.
    Where it is unset a fresh folder is created and registered, but only for a
    local master: on a cluster a folder of one machine would lose data.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:  # named only in the runtime conf: let DataFrame.checkpoint() use it too
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="goldvein-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in whatever store ``path`` names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
