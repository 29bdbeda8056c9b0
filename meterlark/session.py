"""Session settings, the package on the workers, and the stage tables that cut lineage between heavy steps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "meterlark") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # Recording a call site for every column expression doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


_local_folders: dict[str, str] = {}
_shipped: set[str] = set()
_stages: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session, where all tasks share one machine, may fall back to a temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="meterlark-")
        atexit.register(shutil.rmtree, _local_folders[app], ignore_errors=True)
    return _local_folders[app]


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application; they need it to unpickle the functions of tasks."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="meterlark-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Give Spark ML a place to cut the lineage of many boosting rounds; without one it never does."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a table in the shared folder and read it back.

    Fits read their input many times; a written table is columnar, survives lost executors and
    spares each pass the work upstream. ``drop_stages`` deletes the tables; the end of the program
    does so too.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _stages:
        atexit.register(drop_stages)
    _stages.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_stages() -> None:
    """Delete every stage table written so far; only when nothing that reads them is still to run."""
    while _stages:
        spark, path = _stages.pop()
        try:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # the session has ended; its folder is the cluster's to clean
            return


def size_shuffles(spark: SparkSession, input_bytes: int, target_bytes: int = 256 << 20) -> int:
    """Set the number of shuffle partitions for an input size and return it.

    The default of 200 would give partitions of hundreds of gigabytes on a large table; adaptive
    execution merges what turns out too small, but it cannot add partitions to a plain shuffle.
    """
    partitions = max(200, -(-input_bytes // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return partitions
