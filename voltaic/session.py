"""Session helpers for tests and the bench.

Library code never sets masters, paths or shuffle sizes; these helpers are for
entry points only.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured like the bench and the tests."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voltaic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_CKPT: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder for this session.

    ``spark.checkpoint.dir`` (the cluster's shared folder) is used as is; else
    a folder already given to the context with ``setCheckpointDir``. Only when
    neither exists and the master is local (tests) is a fresh scratch folder chosen
    (on a cluster that raises); it is set on
    the context, because ``spark.checkpoint.dir`` cannot be changed at runtime.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        sc = None
    if not path and sc is not None:
        path = sc.getCheckpointDir() or _LOCAL_CKPT.get(sc.applicationId)
    if not path:
        if sc is not None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all hosts of the cluster share")
        path = tempfile.mkdtemp(prefix="voltaic-ckpt-")
        if sc is not None:
            _LOCAL_CKPT[sc.applicationId] = path
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)

