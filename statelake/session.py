"""Session settings, table-catalog settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from statelake.sources.paths import child_names, delete, size_in_bytes

# One reduce task should hold about this much; it is also the target file size of the state tables.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
# Beyond this a driver spends longer on scheduling than it saves; 100 TB of Parquet then is 300 MB a task.
MAX_SHUFFLE_PARTITIONS = 1_000_000
# Leaves of a plan whose size nobody knows report more than this.
UNKNOWN_BYTES = 1 << 60
_WIDTH = "spark.sql.shuffle.partitions"
MAX_SCAN_TASKS = 200_000
# What a task of a micro-batch reads: log records grow about tenfold when decoded, and a task may sort what it read.
STREAM_SPLIT_BYTES = 16 * 1024 * 1024
# Files a task of a micro-batch keeps open before it sorts by partition; its rows land in one hour, seldom two.
OPEN_FILES = 2

_own_scratch: dict[str, str] = {}
# application id -> (width before the library raised it, width it was raised to)
_raised: dict[str, tuple[str, str]] = {}


def shuffle_partitions_for(input_bytes: int, floor: int = 8) -> int:
    """Shuffle width that keeps one partition near ``TARGET_PARTITION_BYTES``.

    Parquet grows about threefold when decoded, hence the factor. Adaptive execution merges what
    turns out too small, so it is safe to err on the wide side; it cannot split a plain shuffle that
    was started too narrow.
    """
    wanted = math.ceil(3 * input_bytes / TARGET_PARTITION_BYTES)
    return max(floor, min(wanted, MAX_SHUFFLE_PARTITIONS))


def split_bytes_for(input_bytes: int) -> int:
    """Scan split size that keeps a scan below ``MAX_SCAN_TASKS`` tasks."""
    return max(TARGET_PARTITION_BYTES, math.ceil(input_bytes / MAX_SCAN_TASKS))


def engine_conf(input_bytes: int | None = None) -> dict[str, str]:
    """Settings for a run over about ``input_bytes`` of Parquet.

    Skewed joins are split even where that costs another shuffle: a key may own a third of the rows,
    and its task would outlast any shuffle.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    if input_bytes is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(input_bytes))
        conf["spark.sql.files.maxPartitionBytes"] = str(split_bytes_for(input_bytes))
    return conf


def catalog_conf(
    name: str = "local",
    warehouse: str = "warehouse",
    extensions: str = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
    implementation: str = "org.apache.iceberg.spark.SparkCatalog",
    kind: str = "hadoop",
) -> dict[str, str]:
    """Settings of a named table catalog whose provider supports ``MERGE INTO``.

    The provider's runtime jar has to be on the classpath of the session they are given to.
    """
    # Public setting names of the connector.
    return {
        "spark.sql.extensions": extensions,
        f"spark.sql.catalog.{name}": implementation,
        f"spark.sql.catalog.{name}.type": kind,
        f"spark.sql.catalog.{name}.warehouse": warehouse,
    }


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with ``engine_conf`` and ``conf`` on top."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**engine_conf(), **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def fit_session(spark: SparkSession, *paths: str) -> None:
    """Pin the zone to UTC, let skewed joins be split, and suit task sizes to the data under ``paths``.

    Widths are only ever raised, so a session tuned by hand keeps its settings.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    total = sum(size_in_bytes(spark, p) for p in paths)
    width = spark.conf.get(_WIDTH)
    wanted = shuffle_partitions_for(total, floor=int(width))
    if wanted > int(width):
        app = spark.sparkContext.applicationId
        _raised[app] = (_raised.get(app, (width, width))[0], str(wanted))
        spark.conf.set(_WIDTH, str(wanted))
    if total / MAX_SCAN_TASKS > TARGET_PARTITION_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes_for(total)))


def begin_query(spark: SparkSession) -> None:
    """Undo what ``fit_session`` raised for the query before; a width set by anyone else stays."""
    now = spark.conf.get(_WIDTH)
    before, raised = _raised.pop(spark.sparkContext.applicationId, (now, now))
    if now == raised and before != now:
        spark.conf.set(_WIDTH, before)


def input_bytes(*frames: DataFrame) -> int:
    """Bytes that the plans of ``frames`` read, as far as their sources know."""
    total = 0
    for df in frames:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        for i in range(leaves.size()):
            size = int(str(leaves.apply(i).stats().sizeInBytes()))
            total += size if size < UNKNOWN_BYTES else 0
    return total


@contextmanager
def sized(spark: SparkSession, *frames: DataFrame, paths: tuple[str, ...] = ()) -> Iterator[None]:
    """Run the jobs inside with shuffles as wide as what ``frames`` and ``paths`` hold; then as before."""
    width = spark.conf.get(_WIDTH)
    total = input_bytes(*frames) + sum(size_in_bytes(spark, p) for p in paths)
    wanted = shuffle_partitions_for(total, floor=int(width))
    if wanted > int(width):
        spark.conf.set(_WIDTH, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(_WIDTH, width)


@contextmanager
def bounded_tasks(spark: SparkSession) -> Iterator[None]:
    """Run streams inside so that the memory of a task follows neither the log nor its files; then as before.

    Scans take in ``STREAM_SPLIT_BYTES`` a task, and rows of one landing hour are written as they come,
    without the sort by partition that would hold a task's rows first. File sources and sinks look these
    up in the session for every micro-batch, so wait for the streams inside the block. A session that
    sets them keeps its own.
    """
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(STREAM_SPLIT_BYTES),
        "spark.sql.files.maxPartitionNum": str(MAX_SCAN_TASKS),
        "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES),
    }
    missing = [key for key in wanted if spark.conf.get(key, None) is None]
    for key in missing:
        spark.conf.set(key, wanted[key])
    try:
        yield
    finally:
        for key in missing:
            spark.conf.unset(key)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without it; it then gets one temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = tempfile.mkdtemp(prefix="statelake-")
        atexit.register(shutil.rmtree, _own_scratch[app], ignore_errors=True)
    return _own_scratch[app]


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/statelake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, in this application's part of it; nothing is created."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_dropped(spark: SparkSession) -> Iterator[set[str]]:
    """Delete what this application writes to its scratch inside the block, and nothing it wrote before.

    Results that were not written elsewhere by the end of the block still read from there, so write
    them inside; scratch paths added to the yielded set stay. Nested blocks and other applications on
    the same folder do not disturb one another.
    """
    root = _scratch_root(spark)
    before = set(child_names(spark, root))
    kept: set[str] = set()
    try:
        yield kept
    finally:
        for name in child_names(spark, root):
            if name not in before and f"{root}/{name}" not in kept:
                delete(spark, f"{root}/{name}")


@contextmanager
def materialized(df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """Write ``df`` once to the shared folder and hand back a scan of it.

    Used where several jobs need the very same rows. Unlike ``persist`` it survives the loss of
    executors (a recomputed batch could read a moving source or stamp another clock), and unlike
    ``checkpoint`` it gives the optimizer the true size, so joins against it pick broadcast or
    shuffle by measured bytes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)
