"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings, safe to apply to a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs the parent one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
# Compressed rows of a shuffle take about this multiple of the same data in parquet.
ROW_EXPANSION = 3
# Catalyst's estimate for a source without statistics, such as JDBC, is Long.MaxValue.
UNKNOWN_BYTES = 2**62


def shuffle_partitions_for(shuffled_bytes: int) -> int:
    """Partition count that keeps one shuffle partition near 128 MB, without an upper limit.

    AQE merges partitions that turn out small but cannot split the ones of an
    aggregation, so the starting number must fit the largest shuffle of the job.
    """
    return max(1, -(-shuffled_bytes // TARGET_PARTITION_BYTES))


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate from file sizes; None for sources that have none."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate if estimate < UNKNOWN_BYTES else None


def fit_shuffles(spark: SparkSession, *inputs: DataFrame) -> None:
    """Raise the shuffle partition count to what the largest input table needs.

    It is never lowered: AQE merges partitions that stay small.
    """
    sizes = [size for size in map(estimated_bytes, inputs) if size]
    needed = shuffle_partitions_for(ROW_EXPANSION * max(sizes, default=0))
    if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "tradewind", **conf: str) -> SparkSession:
    """A session for tests, benchmarks and notebooks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _hadoop_path(spark: SparkSession, path: str):
    """The path and the file system that its scheme belongs to."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach, removed when the driver ends.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a machine-local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        shared = tempfile.gettempdir()
    folder = f"{shared.rstrip('/')}/tradewind/{purpose}-{uuid.uuid4().hex}"
    hadoop_path, file_system = _hadoop_path(spark, folder)
    file_system.mkdirs(hadoop_path)
    file_system.deleteOnExit(hadoop_path)
    return folder


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on any file system Spark can reach."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    return file_system.exists(hadoop_path)


def drop_scratch(spark: SparkSession, folder: str) -> None:
    """Remove a folder that :func:`scratch_dir` gave out."""
    if "/tradewind/" not in folder:
        raise ValueError(f"not a scratch folder: {folder}")
    hadoop_path, file_system = _hadoop_path(spark, folder)
    file_system.delete(hadoop_path, True)


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in a folder; none where it does not exist."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    found = file_system.listStatus(hadoop_path)
    return [status.getPath().getName() for status in found if status.isFile()]


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    stream = file_system.open(hadoop_path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place, whole, unless there is one of that name; whether it was put.

    It is written under another name and renamed without overwriting, which file systems such as
    HDFS do in one step. Of several writers one succeeds.
    """
    jvm = spark._jvm
    draft, file_system = _hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.draft")
    final, _ = _hadoop_path(spark, path)
    stream = file_system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        file_system.getUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(draft, final, options)
        return True
    except Py4JJavaError as error:
        if file_system.exists(final):
            return False
        raise error
    finally:
        if file_system.exists(draft):
            file_system.delete(draft, False)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below one; none where it does not exist."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    found = file_system.listStatus(hadoop_path)
    return [status.getPath().getName() for status in found if status.isDirectory()]


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder with all it holds."""
    hadoop_path, file_system = _hadoop_path(spark, folder)
    file_system.delete(hadoop_path, True)


def in_parallel(spark: SparkSession, jobs: Iterable[Callable[[], object]], threads: int) -> list:
    """Run independent Spark actions side by side, so small ones fill idle executors.

    All are waited for; the first failure is raised afterwards.
    """
    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [future.result() for future in futures]
