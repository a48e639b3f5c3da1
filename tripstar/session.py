"""Session settings the semantics depend on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job needs. Times are kept in UTC, a reload replaces
# only the partitions it writes, and stage sizes are left to adaptive execution.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def new_session(app: str = "tripstar", master: str | None = None, **conf: str) -> SparkSession:
    """Start a session; keyword names use ``__`` for dots (``spark__ui__enabled``)."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for tables a job writes on its way.

    On a cluster it lies in the shared folder named by ``spark.checkpoint.dir``;
    only a local session may fall back to this machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tripstar-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def splits(n_rows: int, per_split: int) -> int:
    """Partitions for so many rows; at least one, and no upper limit."""
    return max(1, -(-n_rows // per_split))
