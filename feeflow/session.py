"""Spark session and cluster-wide settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock for the zone-less capture
# times and AQE for runtime coalescing / skew splitting / join demotion.  An
# overwrite replaces the whole table; only the upsert asks for dynamic
# partition overwrite, on its own write.
#
# Broadcast policy: no broadcast from planner *estimates* (static threshold
# off); AQE may still turn a join into a broadcast once the shuffle has
# *measured* a side below 32 MB - a checked bound, with the sort-merge join
# as the path beyond it.  Data-derived sides never ride a guess.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # the marts' exact averages hold several sums per column: keep their wide
    # aggregates inside whole-stage codegen
    "spark.sql.codegen.maxFields": "400",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # streaming state (dedup keys within the watermark, open windows) lives
    # in RocksDB off the JVM heap, checkpointed incrementally as changelogs
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    master: str | None = None,
    app_name: str = "feeflow",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    ``master`` is left to ``spark-submit`` when not given.  On a cluster
    ``shuffle_partitions`` should be sized so one partition is roughly
    128-256 MB of shuffle data; AQE coalesces the excess at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the platform (a shared file system) and
    is only read here.  Where it is unset on a local master - tests - a
    fresh scratch folder is created and registered; any other master is an
    error, as executors would write to their own disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(
                "spark.checkpoint.dir is not set: a cluster needs a folder that "
                f"all executors share (master {sc.master})")
        conf_dir = tempfile.mkdtemp(prefix="feeflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_root(spark)


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique folder below the shared checkpoint root for staged writes;
    :func:`drop_scratch` removes this application's folders."""
    path = f"{checkpoint_root(spark).rstrip('/')}/feeflow-{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path): any store that Spark reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def forget_scratch(spark: SparkSession, path: str) -> None:
    """Remove one staged copy that nothing reads any more."""
    fs, hadoop = file_system(spark, path)
    fs.delete(hadoop, True)
    _SCRATCH[spark.sparkContext.applicationId].remove(path)


def drop_scratch(spark: SparkSession) -> int:
    """Remove the staged copies that this application wrote; the number gone.
    Call it when a job's outputs are written: frames read from the copies
    cannot be used afterwards."""
    gone = 0
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        fs, hadoop = file_system(spark, path)
        gone += bool(fs.delete(hadoop, True))
    return gone


def materialize_shared(df, name: str):
    """Write ``df`` once as a Parquet table in the shared checkpoint folder
    and return a scan of it.

    Cuts lineage like ``checkpoint()`` (a lost executor re-reads the table,
    never the raw input) but computes ``df`` only once and lets every later
    pass prune columns and push filters into the scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
