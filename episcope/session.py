"""Session helpers: building a session for tests/bench and the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  AQE re-plans joins at run time (size-checked
# broadcast conversion, skew-join splitting of hot keys, partition coalescing).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE may turn a sort-merge join into a shuffled hash join when every
    # post-shuffle partition of the build side is below this size (a run-time
    # size check; larger partitions keep the spillable sort-merge join).
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "episcope", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Tables written by ``materialize`` and ``scratch_path`` that are not released yet.
_WRITTEN: list[str] = []


def _is_local(master: str) -> bool:
    """One JVM holds driver and executors (``local-cluster`` starts several)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, where intermediate tables are written.

    On a cluster ``spark.checkpoint.dir`` names a folder that driver and
    executors share; without one this raises, as a driver's own folder would
    leave every executor with its own part files.  Only a local session without
    the setting (tests) gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        current = sc.getConf().get("spark.checkpoint.dir", None)
        if not current:
            if not _is_local(sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            current = tempfile.mkdtemp(prefix="episcope-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the checkpoint folder, released by ``release_scratch``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    It cuts the lineage: what follows runs once from the written table, and a
    lost executor recomputes from there, not from the raw facts.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of queries that nothing refers to any more.

    It does so when the driver's garbage is collected, which a large heap may not see during a whole run of many steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_mark() -> int:
    """The state to give to ``release_scratch``: it then leaves what was written before."""
    return len(_WRITTEN)


def release_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete the intermediate tables written so far (after the mark ``since``); call it once a run's outputs are written."""
    sc = spark.sparkContext
    released = 0
    while len(_WRITTEN) > since:
        path = sc._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        released += bool(path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True))
    return released
