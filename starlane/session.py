"""Session helpers: one place for engine settings and for the shared work folder.

Zones (cleaned, dims, fact), reliable checkpoints and CSV/Parquet sinks all
live under the folder the cluster names in ``spark.checkpoint.dir``.  We only
invent a folder when that setting is unset *and* the master is local (tests,
laptops); on a cluster an unset value is an error, never a silent fallback to
a machine-local temp directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the library relies on (adaptive execution and its skew
# handling for the shuffle path of large lookups).  They are applied to any
# session handed in; nothing else global is changed - writes that need a
# dynamic partition overwrite pass it as a write option, and no expression
# depends on the session time zone (all timestamps are timestamp_ntz).
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM does not compile methods beyond 8,000 bytes: a wider stage is
    # generated as several methods instead of one that runs interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # texts go to Python workers by size, not by 10,000 rows at once, which
    # executor and worker would both hold several times over
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # shuffle files go when the job that wrote them ends, not when the driver
    # happens to collect its garbage: jobs of many stages kept all of them
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "starlane") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # remove reliable-checkpoint files once their DataFrames are gone
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and zones, read from the session."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/object store) before running starlane jobs on a cluster")
        root = tempfile.mkdtemp(prefix="starlane-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


_CREATED: list[str] = []  # run folders made by work_dir in this process


def work_dir(spark: SparkSession, name: str) -> str:
    """The name of a fresh folder under the shared root for one run."""
    root = checkpoint_root(spark)
    path = f"{root.rstrip('/')}/starlane-work/{name}-{uuid.uuid4().hex[:12]}"
    _CREATED.append(path)  # writers create it, on whatever store it is
    return path


def release_work_dir(spark: SparkSession, path: str) -> bool:
    """Delete one run's folder once its results have been consumed."""
    if path in _CREATED:
        _CREATED.remove(path)
    return delete_path(spark, path)


def release_work_dirs(spark: SparkSession) -> int:
    """Delete every run folder this process created so far.

    Only for callers that have fully consumed the results reading from those
    folders (e.g. a benchmark after each timed run); returns how many.
    """
    n = 0
    while _CREATED:
        if delete_path(spark, _CREATED.pop()):
            n += 1
    return n


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop FileSystem API (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete through the Hadoop FileSystem API."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).delete(p, True)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if it does not exist."""
    fs, p = _file_system(spark, path)
    return sorted(str(f.getPath().getName()) for f in fs.listStatus(p)) if fs.exists(p) else []


def has_data_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds any file that a reader would take (the listing
    stops at the first); names that begin with ``_`` or ``.`` are not data."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return False
    root = str(fs.makeQualified(p).toUri().getPath())
    files = fs.listFiles(p, True)
    while files.hasNext():
        parts = str(files.next().getPath().toUri().getPath())[len(root):].split("/")
        if not any(x.startswith(("_", ".")) and "=" not in x for x in parts if x):
            return True
    return False


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file."""
    fs, p = _file_system(spark, path)
    fs.create(p, True).close()
