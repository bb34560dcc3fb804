"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf, StorageLevel
from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session_conf(preset: dict, master: str | None = None, shuffle_partitions: int | None = None,
                 extra: dict | None = None) -> dict:
    """What to set on top of ``preset``, the settings the environment already gives.

    Preset values stay, the master and the number of shuffle partitions above
    all: a value set in code would win over the submit option. Only a plain
    local run, with no master given anywhere, gets local defaults.
    """
    conf = {k: v for k, v in _DEFAULTS.items() if k not in preset}
    if master is not None:
        conf["spark.master"] = master
    elif "spark.master" not in preset:
        conf["spark.master"] = "local[8]"
    local = conf.get("spark.master", preset.get("spark.master", "")).startswith("local")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    elif local and "spark.sql.shuffle.partitions" not in preset:
        conf["spark.sql.shuffle.partitions"] = "8"
    return conf | (extra or {})


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes.

    ``master`` and ``shuffle_partitions`` are set only if given (see
    :func:`session_conf`), so a submitted job keeps those of its submission.
    """
    preset = dict(SparkConf().getAll())
    running = SparkSession.getActiveSession()
    if running is not None:
        preset |= dict(running.sparkContext.getConf().getAll())
    builder = SparkSession.builder
    if app_name is not None or "spark.app.name" not in preset:
        builder = builder.appName(app_name or "edgefilter")
    for key, value in session_conf(preset, master, shuffle_partitions, extra).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must point at shared
    storage. Only when it is unset (local runs, tests) do we pick a fresh
    folder of our own and register it, so that ``DataFrame.checkpoint()``
    and our written intermediate tables land in the same place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="edgefilter-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def warehouse_root(spark: SparkSession) -> str:
    """The warehouse folder; on a cluster it must be a shared one, as for checkpoints."""
    root = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
    preset = dict(spark.sparkContext.getConf().getAll())
    if not (spark.sparkContext.master or "").startswith("local") and "spark.sql.warehouse.dir" not in preset:
        raise RuntimeError("spark.sql.warehouse.dir must name a shared folder on a cluster")
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the checkpoint root for one written table."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written table of ours through the file system that holds it."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df):
    """Materialise ``df`` in the checkpoint folder and return the re-read copy.

    Reliable checkpoint (never ``localCheckpoint``): the data lives in the
    shared folder, so losing an executor does not lose it, and later jobs
    start from it instead of recomputing the plan.
    """
    checkpoint_root(df.sparkSession)
    # Persist first: otherwise the eager checkpoint computes the plan once to
    # count and again to write the files. The cache is released once the
    # checkpoint files back the returned DataFrame.
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def materialize(df, name: str):
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Unlike ``checkpoint()``, the re-read table reports no partitioning, so a
    later join shuffles it as an ordinary (adaptive) stage: AQE can then
    broadcast it from its real size or split a skewed partition of the
    other side. The table also survives executor loss.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
