"""Session helpers: a local session for tests and the bench, and the shared
folder where intermediate tables (levels, checkpoints) are written."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "basketry") -> SparkSession:
    """A local[N] session for tests and benchmarks.

    On a cluster the caller builds its own session; nothing in the library
    depends on these settings except that AQE is expected to be on.
    """
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # small level tables would otherwise be coalesced into ~1 MB
        # partitions, leaving cores idle in the next level's join
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BASKETRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the SparkContext's
    checkpoint dir).  Only when it is unset *and* the master is local (tests,
    the bench) a fresh temporary folder is taken; on a cluster an unset
    value is an error, because a machine-local folder would not survive the
    loss of an executor and is not visible to the other nodes.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        opt = sc._jsc.sc().getCheckpointDir()
        if opt.isDefined():
            root = opt.get()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="basketry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(root)
    return root
