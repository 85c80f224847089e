"""Session helpers: a local session for tests/bench and the shared scratch root.

Library functions never invent storage locations of their own. Anything they
must materialise (stream inputs, checkpoints, table snapshots) goes under the
folder the cluster names in ``spark.checkpoint.dir``; only when that setting is
missing on a local master (as in tests) is a temporary folder chosen and
written back to the session so every later call agrees on it. On a cluster a missing
setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, extra_conf: dict[str, str] | None = None
) -> SparkSession:
    """A local session configured the way the tests and bench expect."""
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName("silverline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SILVERLINE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None where there is none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # Connect sessions raise instead of exposing a context
        return None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for materialised state (``spark.checkpoint.dir``).

    Set here only when the session has none, which happens in local tests.
    """
    sc = _context(spark)
    root = spark.conf.get(_CHECKPOINT_CONF, None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root and (sc is None or not (sc.master == "local" or sc.master.startswith("local["))):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="silverline-")
        spark.conf.set(_CHECKPOINT_CONF, root)
    if sc is not None and sc.getCheckpointDir() is None:  # a Connect session has none to set
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the scratch root (nothing is created)."""
    return "/".join([scratch_root(spark), "silverline", *parts, uuid.uuid4().hex])
