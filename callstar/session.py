"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library assumes. AQE re-plans joins at run time (broadcast
# conversion, skew split, partition coalescing); UTC keeps date/hour
# derivation independent of the machine running the job.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime broadcast only for join sides measured under this size
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}
#: Largest join side that a load broadcasts by its measured size. The driver builds every broadcast, several at once while
#: tables are loaded side by side, and the table it builds of a side of bare ids is about four times the side.
LOAD_BROADCAST = 4 << 20
#: The same for a size that is estimated before the run, by compressed files.
LOAD_BROADCAST_FILES = 256 << 10
#: Stored and staged files: many columns are hex digests, which zstd shrinks and snappy keeps as they are.
CODEC = "zstd"


def build_session(master: str | None = None, app: str = "callstar",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's base settings.

    ``master`` and ``shuffle_partitions`` are meant for local runs and
    tests; on a cluster leave them unset so the deployment decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256,
                 shuffle_fraction: float = 0.25, max_shuffle_partitions: int = 400_000) -> dict:
    """Partition sizing for a cluster run over ``input_bytes`` of parquet.

    * scans are split at ``target_partition_mb`` (fewer, larger read tasks);
    * shuffles carry only the projected columns, estimated as
      ``shuffle_fraction`` of the input; they start with one partition per
      ``target_partition_mb`` of that (at least 2x the cores, at most
      ``max_shuffle_partitions`` to bound map-status metadata) and AQE
      coalesces small ones towards the same advisory size, so a shuffle
      partition holds a few hundred MB, not the whole key range;
    * skewed partitions above 4x the advisory size are split by AQE.
    """
    mb = 1024 * 1024
    wanted = -(-int(input_bytes * shuffle_fraction) // (target_partition_mb * mb))
    initial = min(max_shuffle_partitions, max(2 * total_cores, wanted))
    return {
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k, v in BASE_CONF.items():
        if k == "spark.ui.enabled":
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave as is
            pass


@contextmanager
def load_conf(spark: SparkSession) -> Iterator[None]:
    """Lower broadcast bounds for the time of a load: the key sets that it joins grow with the batch and stay off the driver."""
    sql = spark._jvm.org.apache.spark.sql.internal.SQLConf
    now = spark._jsparkSession.sessionState().conf()
    measured = now.getConf(sql.ADAPTIVE_AUTO_BROADCASTJOIN_THRESHOLD())
    conf = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": min(LOAD_BROADCAST, measured.get() if measured.isDefined() else LOAD_BROADCAST),
        "spark.sql.autoBroadcastJoinThreshold": min(LOAD_BROADCAST_FILES, now.autoBroadcastJoinThreshold()),
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system
    every executor sees). Only a local master may fall back to a fresh
    private folder, as tests do.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a cluster run needs a shared folder")
    root = tempfile.mkdtemp(prefix="callstar-ckpt-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point ``SparkContext`` checkpoints at the shared folder."""
    root = checkpoint_root(spark)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def side_by_side(tasks: dict[str, Callable[[], object]], spark: SparkSession) -> dict[str, object]:
    """Run independent jobs at the same time (``callstar.parallel_tables`` of them, 4 by default): name to result, or to its exception.

    Spark schedules their stages together, so small tables fill the cores that
    the tail of a large one leaves idle.
    """
    def attempt(work: Callable[[], object]) -> object:
        try:
            return work()
        except Exception as e:
            return e
    width = int(spark.conf.get("callstar.parallel_tables", "4"))
    with ThreadPoolExecutor(max_workers=max(1, width)) as pool:
        futures = {name: pool.submit(attempt, work) for name, work in tasks.items()}
        return {name: f.result() for name, f in futures.items()}
