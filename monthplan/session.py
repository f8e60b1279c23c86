"""Session helpers: a local session for tests and the bench, and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "monthplan",
                  event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks (no web UI; stage and task times go to an event log if asked)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # broadcast only what was measured: no broadcast from planner estimates, AQE broadcasts a join side
        # whose finished shuffle stage is small (explicit hints remain for the bounded calendar tables)
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can reach, and it is used as is.
    Only when nothing is configured (local tests) a fresh folder under the system temp dir is set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext: the configured folder is all there is
        if configured:
            return configured
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running the month loops")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running the month loops")
    folder = tempfile.mkdtemp(prefix="monthplan-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def _shared_root(spark: SparkSession) -> str:
    """The checkpoint folder as it was named: Spark keeps each application's own files in a folder below it."""
    current = ensure_checkpoint_dir(spark).rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return configured.rstrip("/") if configured else current.rsplit("/", 1)[0]


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/monthplan/{spark.sparkContext.applicationId}"


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh folder for an intermediate table under the session's (shared) checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def run_folder(spark: SparkSession, run: str) -> str:
    """The folder of a named run under the checkpoint folder: another application finds it again by its name."""
    if not run or "/" in run or run.startswith((".", "_")):
        raise ValueError(f"not a name for a run: {run!r}")
    return f"{_shared_root(spark)}/monthplan-runs/{run}"


def drop_run(spark: SparkSession, run: str) -> None:
    """Delete a named run's tables and ledger."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark, run))
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table of this application; results that were not written before can't be read again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
