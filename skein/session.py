"""Session construction and the shared scratch / checkpoint folder.

On a cluster the operator of the cluster names a shared folder in
``spark.checkpoint.dir``; every lineage cut and every streaming checkpoint of
this library lives below it.  Only when that setting is missing (tests, a
laptop with ``local[*]``) do we create a private folder under the system temp
directory, and we refuse to do so for a non-local master.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app_name: str = "skein",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings every plan in this package assumes.

    AQE is on (partition coalescing, skew-join splitting), the time zone is
    UTC, the UI is off and streaming state lives in RocksDB.  Leave
    ``shuffle_partitions`` unset on a cluster (its configuration and AQE
    coalescing decide); set it to the core count for a local master.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Checkpoint files go when the DataFrame that wrote them is gone.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Running counts keep every key forever: keep that state off the JVM heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session.  When it is unset and the
    master is local, a private temp folder is created and registered as the
    checkpoint directory; on a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get(_CKPT_KEY, None)
    if root is None:
        try:
            root = spark.conf.get(_CKPT_KEY)
        except Exception:  # noqa: BLE001 - unset in runtime conf
            root = None
    if not root:
        current = sc.getCheckpointDir()
        if current:
            # The reliable checkpoint dir gets a uuid child; its parent is ours.
            root = os.path.dirname(current.rstrip("/"))
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for the cluster"
            )
        root = tempfile.mkdtemp(prefix="skein-")
        spark.conf.set(_CKPT_KEY, root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A new, unused folder below :func:`scratch_root` (never reused, never wiped)."""
    return os.path.join(scratch_root(spark), f"{tag}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table below :func:`scratch_root` and read it back: a lineage
    cut, and one evaluation for a plan that needs its rows more than once."""
    path = fresh_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
