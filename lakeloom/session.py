"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting points for ~100 TB inputs on a large cluster (AQE coalesces the
# initial shuffle partitions down to ~256 MB each and splits skewed ones;
# parallelismFirst would ignore that size). Streaming state is never
# coalesced: see STREAM_CONF.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# For sessions that run stateful streams: every shuffle partition holds a
# state store of each stateful operator, fixed for the query's life.
STREAM_CONF = {"spark.sql.shuffle.partitions": "1000"}


def build_session(
    app_name: str = "lakeloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    hive: bool = False,
    extra_conf: dict[str, str] | None = None,
    cluster: bool = False,
    streaming: bool = False,
) -> SparkSession:
    """Builder with UTC session time, AQE (coalesce + skew join) and no UI.

    ``master`` and ``shuffle_partitions`` are left to the cluster when None.
    ``hive=True`` enables the Hive catalog (metastore URIs come from
    ``extra_conf``, e.g. ``{"hive.metastore.uris": "thrift://..."}``).
    ``cluster=True`` applies ``CLUSTER_CONF`` (large-input partition sizing
    and RocksDB state for streaming); ``streaming=True`` lowers its shuffle
    partitions to what stateful streams can keep open.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if streaming:
        conf.update(STREAM_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the cluster's checkpoint directory (``spark.checkpoint.dir``, or one
    set on the context), a shared file system such as HDFS or S3. Only when
    nothing is configured (local runs and tests) is a private folder created
    and registered on the context (``spark.checkpoint.dir`` itself is a
    static setting and cannot be changed at run time).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (sessions without a context handle)
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current.rstrip("/")
    configured = None
    try:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001
        configured = None
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...): "
                             "a driver-local folder is not visible to executors")
    current = configured or tempfile.mkdtemp(prefix="lakeloom-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


def default_parallelism(spark: SparkSession) -> int | None:
    """Total task slots of the cluster (None when the session cannot tell)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return None


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/lakeloom-scratch/{label}-{uuid.uuid4().hex[:12]}"
