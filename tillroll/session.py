"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every tillroll job relies on: UTC dates, adaptive execution (partition coalescing,
# runtime broadcast of small join sides, skew-join splitting) and no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "tillroll",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the tillroll defaults.

    ``master`` is only set when given, so that a cluster submission keeps the master chosen by
    ``spark-submit``. ``shuffle_partitions`` should follow the data size: about one partition per
    128-256 MB of shuffled data on a cluster, about the core count on a laptop.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate files.

    On a cluster this is ``spark.checkpoint.dir`` as configured for the cluster (a shared file
    system); without it the call fails, as executors would not see a folder of the driver's. Only
    in local mode, as in tests, a private folder is created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no context; the setting is all there is
        sc = None
    configured = configured or (sc.getCheckpointDir() if sc is not None else None)
    if configured:
        return configured
    if not (sc is not None and sc.master.startswith("local") and "cluster" not in sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(local)
    # The context may append a random subfolder; report what it actually uses.
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root for one intermediate data set."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in Python workers that don't have it installed.

    Operators whose per-batch code runs in Python workers need it there. The package's sources are
    sent once per application as a small zip file through Spark's own file distribution.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tillroll_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tillroll-package-")  # read by the driver's file server only
    path = os.path.join(folder, "tillroll.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for here, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(here, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._tillroll_shipped = True


def local_master(cpus: int | None = None) -> str:
    return f"local[{cpus or os.cpu_count() or 8}]"


# Bounds of the shuffle partition count: beyond the upper one the blocks between map and reduce
# tasks get too many and too small.
MAX_SHUFFLE_PARTITIONS = 8000


def sizing_conf(input_bytes: int, total_cores: int, split_bytes: int = 512 << 20,
                open_cost_bytes: int = 1 << 20, shuffled_share: float = 0.02,
                partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a job over ``input_bytes``.

    File splits are ``split_bytes``; many small receipt documents are packed per task with an
    open cost of ``open_cost_bytes`` each (the default 4 MB packs only 128 MB / 4 MB = 32 tiny
    files per task). The load itself doesn't shuffle, and the models shuffle one small row per
    receipt or per group and task, about ``shuffled_share`` of the input: the initial shuffle
    partition count follows these bytes, at least two per core, at most
    ``MAX_SHUFFLE_PARTITIONS``; adaptive execution then coalesces small partitions to the
    advisory size and splits skewed ones.
    """
    wanted = -(-int(input_bytes * shuffled_share) // partition_bytes)
    partitions = min(MAX_SHUFFLE_PARTITIONS, max(min(2 * total_cores, MAX_SHUFFLE_PARTITIONS), wanted))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.files.openCostInBytes": str(open_cost_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
    }
