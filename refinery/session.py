"""Session helpers: a local session for tests/bench and the shared scratch root."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Settings for a large cluster (~100 TB inputs). Chunked operators (carry,
# assign_keys) let AQE size their range chunks to the advisory partition size.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.files.maxPartitionBytes": str(512 << 20),
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.session.timeZone": "UTC",
}


# Settings that only take effect when the application starts (pass them to the
# session builder / spark-submit): remove checkpoint files once nothing
# references them, so chunked operators do not leave full copies behind.
STARTUP_CONF = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply :data:`CLUSTER_CONF` (plus overrides) to a running session."""
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session used by tests and the bench; a cluster passes its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("refinery")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for k, v in STARTUP_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Where it is unset, a local
    master gets a temporary one; a cluster has to name it, since a folder of one
    machine would be invisible to the others."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="refinery-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/refinery/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh folder of this application under the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back. Lineage is
    cut, what a task drew (such as its partition number) is fixed, and later
    passes read only the columns they need. Runs the job when called."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its Hadoop filesystem; any other error is raised."""
    fs, p = _path(spark, path)
    return fs.exists(p)


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (one listing call), hidden ones
    left out; none where ``path`` does not exist. Any other error is raised."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    names = (st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())
    return sorted(n for n in names if not n.startswith(("_", ".")))


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` with what is under it; False where there is none."""
    fs, p = _path(spark, path)
    return fs.delete(p, True)


def remove_scratch(spark: SparkSession) -> bool:
    """Delete this application's scratch folders, once no DataFrame over them is needed."""
    fs, p = _path(spark, _scratch_root(spark))
    return fs.delete(p, True)
