"""Session helpers: one place for the configuration the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every session of the library wants. AQE re-plans shuffles at run time
# (coalescing small partitions, splitting skewed join partitions); the UI stays off.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of materialized intermediates go away with their DataFrame
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app: str = "eddyline",
    driver_memory: str = "8g",
    extra: dict | None = None,
) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own session."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured checkpoint folder. Without one, a local session (driver and tasks
    on one machine) gets a temporary folder; a cluster session is refused, as its executors
    could not see a folder of the driver's."""
    root = checkpoint_root(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="eddyline-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (stream checkpoints, written tables)."""
    root = ensure_checkpoint_dir(spark)
    return "/".join([root.rstrip("/"), *parts])


def target_parallelism(spark: SparkSession) -> int:
    """Shuffle width the plans are sized for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def materialize(df):
    """Cut the lineage of a frame that several branches reuse: a reliable
    checkpoint into the shared checkpoint folder (survives executor loss,
    unlike a local checkpoint), computed once instead of once per branch."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
