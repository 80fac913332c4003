"""Session-level helpers: scratch/checkpoint locations and a local session.

Library code never creates, configures or stops the caller's session, except
for :func:`ensure_checkpoint_dir`, which fills in a checkpoint directory for
sessions within one machine that have named none.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which all executors share.

    Where it is unset, a session that runs within one machine gets a temporary folder of
    that machine, once; on a cluster such a folder would differ from executor to executor,
    so there it is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quaystat-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root or sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory name under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/quaystat-scratch/{name}-{uuid.uuid4().hex[:12]}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI with its scheme, as Spark resolves it, for file systems opened by Python workers."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return re.sub(r"^file:/(?!/)", "file:///", uri)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench (UI off, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quaystat")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
