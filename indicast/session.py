"""Session construction and the shared checkpoint location.

On a cluster the checkpoint folder is named by ``spark.checkpoint.dir`` and
must be a shared (distributed) file system; we only pick our own folder when
the setting is absent, which happens in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; every one can be overridden by the caller.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go when the last reference to their table does.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the pipeline expects."""
    b = SparkSession.builder.master(master).appName("indicast")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``. A
    local session without the setting gets a folder of its own; on a cluster
    the setting is required, since a driver-local folder is lost on executors."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="indicast-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting it on first use."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(spark))
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder of this session's own within the shared folder. It is removed
    when the session's JVM ends, so that runs do not pile up in the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder
    (never a local checkpoint: a lost executor must not lose the stage)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
