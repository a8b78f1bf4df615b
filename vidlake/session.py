"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import warnings
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str = "*", app: str = "vidlake", **settings: str) -> SparkSession:
    """A session on this machine, for tests and the bench. On a cluster the
    session comes from spark-submit and its settings are left alone."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="vidlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path in the folder all executors share. Only a local session may
    go without one, and then gets a temporary folder."""
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/vidlake-{uuid.uuid4().hex}"


# One shuffle partition per so many stored bytes; compressed columns grow a few
# times in memory, which an executor core can hold or spill. Beyond the cap the
# cost of tracking shuffle blocks would outgrow that of larger partitions.
BYTES_PER_PARTITION = 256 * 1024 * 1024
MAX_PARTITIONS = 50_000
ACCURATE_BLOCKS = "spark.shuffle.accurateBlockSkewedFactor"


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files below the paths."""
    conf = spark._jsc.hadoopConfiguration()
    targets = [spark._jvm.org.apache.hadoop.fs.Path(path) for path in paths]
    return sum(t.getFileSystem(conf).getContentSummary(t).getLength() for t in targets)


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the number of shuffle partitions to what the input needs. Adaptive
    execution can merge partitions but not make more of them for a window or an
    aggregate, so the start must be high enough; it is never lowered.

    Above some 2,000 partitions Spark keeps only an average size for all but the
    largest blocks of a map task, and a hot day spread over many map tasks then
    looks no larger than any other. A core setting, given at submit, keeps the
    sizes of those too; without it this warns.
    """
    key = "spark.sql.shuffle.partitions"
    needed = min(-(-input_bytes // BYTES_PER_PARTITION), MAX_PARTITIONS)
    partitions = max(needed, int(spark.conf.get(key)))
    spark.conf.set(key, partitions)
    settings = spark.sparkContext.getConf()
    averaged_above = int(settings.get("spark.shuffle.minNumPartitionsToHighlyCompress", "2000"))
    if partitions > averaged_above and float(settings.get(ACCURATE_BLOCKS, "-1")) < 0:
        warnings.warn(f"submit with --conf {ACCURATE_BLOCKS}=5 so that hot partitions are split")
    return partitions
