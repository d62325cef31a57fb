"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings that results depend on (time zone) or that the plans assume (AQE).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ui.retainedExecutions": "5",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Setting under which a query's shuffle files are removed at its end.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _submitted() -> SparkConf:
    """The settings that spark-submit has started this process with; none in a plain Python process."""
    if "PYSPARK_GATEWAY_PORT" in os.environ:
        SparkContext._ensure_initialized()
    conf = SparkConf()
    if "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        conf.setIfMissing("spark.master", "as submitted")
    return conf


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerly", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    What spark-submit or a configuration file has set for the master and the
    shuffle width stays; only where neither names a master does it become
    ``local[*]`` with 8 partitions.
    """
    b = SparkSession.builder.appName(app_name)
    given = _submitted()
    alone = not master and not given.contains("spark.master") and SparkSession.getActiveSession() is None
    if master or alone:
        b = b.master(master or "local[*]")
    conf = {k: v for k, v in BASE_CONF.items() if not given.contains(k)}
    if shuffle_partitions or ((alone or master) and not given.contains("spark.sql.shuffle.partitions")):
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 bytes_per_shuffle_partition: int = 1 << 30, max_shuffle_partitions: int = 50_000) -> dict:
    """Settings for a cluster run sized from the input volume.

    Shuffle width starts near one partition per ``bytes_per_shuffle_partition``
    of input (shuffled data is smaller than the scan after pruning and partial
    aggregation), at least two waves of the cluster's cores and at most
    ``max_shuffle_partitions`` so map x reduce block counts stay manageable;
    AQE then coalesces small partitions and splits skewed ones. Scan splits
    are 512 MB so a 100 TB scan is ~200k tasks.
    """
    cores = executors * cores_per_executor
    parts = min(max(2 * cores, input_bytes // bytes_per_shuffle_partition), max_shuffle_partitions)
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(512 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        # broadcast only what Spark has measured below this size
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Only when ``spark.checkpoint.dir`` is unset in a local run (tests) a
    folder of our own is created and registered; on a cluster such a folder
    would be the driver's alone, so the setting is asked for.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="ledgerly-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a local one)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame) -> DataFrame:
    """A stage table: the rows written once, as Parquet, into the shared checkpoint folder, and read from there.

    Cuts the lineage like :func:`cut_lineage`; where several branches read a
    wide table, each reads only its columns, and the files are compressed. The
    shuffle files of its making go as soon as it is written: until the driver
    happens to collect its garbage, a job's disk would hold those of all steps.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stage-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def let_workers_import(spark: SparkSession) -> None:
    """Put the folder that holds this package on the Python path of workers started from now on.

    For sessions made by a process that found the package through ``sys.path``
    alone. Where executors do not see that folder, ship the package with
    ``--py-files``; the path is harmless then.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
