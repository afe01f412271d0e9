"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewatch") -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcast only measured sizes: never from static estimates, only
        # explicit hints after a measurement or AQE's runtime shuffle sizes.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (`spark.checkpoint.dir`).

    On a cluster this must be set by the deployment; a machine-local folder
    would vanish with the executor that wrote it. Only a local-mode session
    (tests, bench) without the setting gets a fresh scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running jobs")
        return root
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running jobs")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidewatch-"))
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder under the shared root for one run of one job."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tidewatch/{purpose}/{uuid.uuid4().hex}"


def with_object_store(
    builder: SparkSession.Builder,
    endpoint: str,
    access_key: str,
    secret_key: str,
    path_style: bool = True,
    ssl: bool = False,
) -> SparkSession.Builder:
    """Bind `s3a://` paths to an S3-compatible object store (needs the
    hadoop-aws jar on the classpath). Configuration only: every reader and
    writer then takes `s3a://bucket/...` paths unchanged."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder


def cluster_conf(executors: int = 1000, cores_per_executor: int = 4, state_partitions: int | None = None) -> dict[str, str]:
    """Settings the jobs are designed for on a large cluster.

    - 512 MB file splits keep a 100 TB scan near 200k tasks, ~50 waves on
      4,000 cores, with each task's partial aggregates well inside memory.
    - Shuffle partitions start at 4 per core and AQE coalesces them to
      ~256 MB each; skewed partitions above 5x the median (and 512 MB) are
      split, which covers a hot join key the salting option does not.
    - Broadcasts happen only from measured sizes (explicit hints after
      `broadcast_if_small`, or AQE's runtime shuffle sizes), never from
      static estimates.
    - Streaming state lives in RocksDB (off-heap, spills to local disk,
      checkpointed as changelogs); its partition count is fixed when a
      checkpoint is created, so it is set here, before the first start.
    """
    cores = executors * cores_per_executor
    return {
        "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(state_partitions or 4 * cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.tidewatch.broadcastLimitBytes": str(64 * 1024 * 1024),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # Files of a checkpointed frame go when the frame does.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def parallelism(spark: SparkSession) -> int:
    """Cores available to the session (SparkContext default parallelism, or
    `spark.default.parallelism` where there is no SparkContext)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.default.parallelism", "200"))
