"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Adaptive execution does the run-time work the library relies on: it merges small shuffle partitions,
# splits skewed ones in joins and in rebalanced writes, and turns a join into a broadcast join once the
# measured size of a side allows it.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python call site of every Column costs more than the rest of building a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_LOCAL_SCRATCH: dict[str, str] = {}

# Shuffle partitions are planned for this much input each.
PARTITION_BYTES = 256 * 1024 * 1024


def sized_for(input_bytes: int, cores: int, max_partitions: int = 400_000) -> dict[str, str]:
    """Settings for an input of a given size on a cluster with a given number of cores.

    The number of shuffle partitions is where AQE starts; it merges small ones afterwards, so planning for
    the largest table costs little on the small ones. `max_partitions` is what the driver can manage; it bounds
    parallelism and drops nothing. 100 TB give some 373 000 partitions of 256 MB; a driver that can only manage
    50 000 gets partitions of 2 GB, which spill. A partition far above the others is split by the skew rules.
    """
    wanted = math.ceil(input_bytes / PARTITION_BYTES)
    partitions = min(max(wanted, 2 * cores), max_partitions)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES // 2),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def build_session(
    app: str = "estratos", master: str | None = None, settings: Mapping[str, str] | None = None, **conf: str
) -> SparkSession:
    """A session with the library's defaults, then `settings`, then `conf`, whose keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | dict(settings or {}) | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    Where that is unset, a session whose executors are threads of this process gets a temporary folder, set as its
    checkpoint directory; on a cluster executors would not see each other's files there, so an error is raised.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    root = root or _LOCAL_SCRATCH.get(context.applicationId)
    if not root:
        if not re.fullmatch(r"local(\[[^-]*\])?", context.master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {context.master} share")
        root = _LOCAL_SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="estratos-")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared scratch folder."""
    return f"{scratch_root(spark)}/estratos/{label}-{uuid.uuid4().hex}"
