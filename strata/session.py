"""Session helpers: a configured local session for tests and the shared work folder.

On a cluster the session is built by the caller; these helpers only read its
settings.  ``shared_dir`` places intermediate tables under the folder named by
``spark.checkpoint.dir`` (a shared file system on a cluster) and sets its own
folder only when the session has none, as in tests.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from measured shuffle
# sizes, splits skewed join partitions and coalesces small ones.  The static
# planner never broadcasts on estimated sizes; AQE broadcasts a side only
# after its shuffle stage has measured it below the adaptive threshold, and
# operators broadcast dimensions only behind a bounded count.
SCALE_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 input_bytes_per_partition: int = 1024**3) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of Parquet input.

    Shuffle partitions start at about one per GB of input (shuffled data is
    far smaller after column pruning and partial aggregation), at least
    twice the task slots; AQE then coalesces them to ~128 MB after
    each stage, so one plan serves small and large runs.  Skewed join
    partitions above 4x the median and 256 MB are split.  Scan splits stay
    at 256 MB so a task's input fits comfortably in executor memory.
    """
    slots = executors * cores_per_executor
    partitions = max(2 * slots, input_bytes // input_bytes_per_partition)
    conf = dict(SCALE_CONF)
    conf.update(
        {
            "spark.sql.shuffle.partitions": str(partitions),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
            "spark.sql.files.maxPartitionBytes": "256MB",
        }
    )
    return conf


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; one is made only for a local master without the setting.

    Staged tables stay there until the folder's owner expires them, or a
    ``staging`` block ends: results are lazy and may still read them when a
    function returns.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/strata/{name}-{uuid.uuid4().hex[:12]}"
    for made in _SCOPES:
        made.append(path)
    return path


#: Folders made inside each open ``staging`` block.
_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Folders that ``shared_dir`` hands out inside the block are deleted at its end.

    For steps that finish what they read before they return, as a write does;
    a DataFrame that leaves the block must not read them.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.pop()
        for path in made:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
