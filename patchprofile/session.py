"""Session helpers: a tuned local session for tests/bench and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every entry point relies on. AQE re-plans joins and coalesces
# shuffle partitions at run time; UTC keeps zoneless timestamps stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "patchprofile",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is always read from the
    session. Only when it is unset (a bare local test session) do we pick a
    scratch folder of our own and set it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder is not visible to the other executors
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="patchprofile-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/patchprofile/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, partition_bytes: int = 1024 ** 3,
               max_partitions: int = 100_000) -> dict[str, str]:
    """Settings sized for an input of ``input_bytes`` (e.g. a 100 TB feed).

    Shuffle partitions are chosen so that one holds about ``partition_bytes``
    (capped, as map x reduce shuffle blocks grow with the square); AQE then
    coalesces small ones and splits skewed ones. The same number is a good
    bucket count for the profile store. Scans split at a quarter of that.
    """
    parts = min(max_partitions, max(1, -(-int(input_bytes) // partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes // 4),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 4),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }
