"""Session helpers.

Library operators never create a session; callers pass one.  ``local_session``
is for tests and the benchmark only.  ``checkpoint_dir`` reads the shared
folder the cluster names in ``spark.checkpoint.dir`` and only falls back to a
caller-supplied folder when that setting is unset (tests).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "marquee", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the reliable checkpoint folder, registering it with the context.

    The cluster's ``spark.checkpoint.dir`` wins.  ``fallback`` is used only
    when that is unset (local tests); without either this raises, because a
    machine-local temporary folder is not safe on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    path = conf or fallback
    if not path:
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; set it to a shared folder or pass a fallback")
    if not conf:
        os.makedirs(path, exist_ok=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
