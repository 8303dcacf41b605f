"""Session settings the library relies on, and the shared scratch folder.

Every operator in the package is a pure ``DataFrame -> DataFrame`` function;
nothing here holds a global session. ``ensure_settings`` pins the few runtime
options whose values change results (time zone) or scale behaviour (AQE).
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Runtime SQL options: results depend on the time zone; the AQE options let
# Spark re-plan joins and shuffles from measured sizes and split skewed
# partitions (a single user may own a third of all facts).
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Date text is parsed with the java.time patterns (Spark 4's default);
    # pinned so a session set to the legacy parser cannot change results.
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Floor for AQE's partition coalescing. For a write partitioned by user the
    # cost is the number of directories and files, not bytes: coalescing a small
    # shuffle into two 1 MB partitions leaves two tasks creating every user's
    # file. At cluster scale partitions are far above this floor, so it only
    # matters for small shuffles, where it keeps them parallel.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
}

# Of these, the ones that results depend on.
RESULT_SETTINGS = ("spark.sql.session.timeZone", "spark.sql.legacy.timeParserPolicy")

LISTING_PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
SPARK_DEFAULT_LISTING_PARALLELISM = "10000"


def ensure_settings(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library's results depend on.

    The performance settings are left as the caller has them; ``build_session``
    sets those of a session of its own.
    """
    for key in RESULT_SETTINGS:
        if spark.conf.get(key, None) != RUNTIME_SETTINGS[key]:
            spark.conf.set(key, RUNTIME_SETTINGS[key])
    # Listing a table partitioned by user (one directory per user) runs as a
    # Spark job; Spark's default starts up to 10,000 tasks of one directory
    # each. Size it to the cluster instead: 8 tasks per core, at most
    # Spark's own cap, unless the session chose a value.
    if is_classic(spark) and spark.conf.get(LISTING_PARALLELISM) == SPARK_DEFAULT_LISTING_PARALLELISM:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(LISTING_PARALLELISM, str(min(int(SPARK_DEFAULT_LISTING_PARALLELISM), max(64, 8 * cores))))
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster ``master`` stays ``None`` so the launcher decides; tests and
    the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return ensure_settings(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is read, never replaced.
    Only when it is unset and the master is local (tests, the bench) a folder
    is created and registered, so later calls in the same session agree; with
    any other master an unset folder is an error, as a driver's own temporary
    folder is not there on executors.
    """
    if not is_classic(spark):  # Spark Connect: no SparkContext on the client
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return root.rstrip("/")
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def is_classic(spark: SparkSession) -> bool:
    """True for an in-process (py4j) session, False for Spark Connect."""
    return hasattr(spark, "_jsparkSession")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _folder(spark: SparkSession, path: str):
    """(file system, path) on the JVM's side, for any file system Spark reads."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def names_in(spark: SparkSession, path: str) -> Iterator[str]:
    """Names in a folder, as the file system lists them; none when there is no folder.

    Read as far as the caller goes on, so asking for one of many costs one.
    """
    system, where = _folder(spark, path)
    if not system.exists(where):
        return
    found = system.listStatusIterator(where)
    while found.hasNext():
        yield found.next().getPath().getName()


def first_folder_of_key(spark: SparkSession, path: str) -> str | None:
    """The first ``key=value`` folder in a folder, in the order of names; hidden ones are left out.

    Listed and sorted on the JVM's side: only names up to that one come to Python.
    """
    system, where = _folder(spark, path)
    if not system.exists(where):
        return None
    found = system.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where, "*=*")) or ()
    names = (status.getPath().getName() for status in found)
    return next((n for n in names if not n.startswith((".", "_"))), None)


def path_exists(spark: SparkSession, path: str) -> bool:
    system, where = _folder(spark, path)
    return system.exists(where)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all in it."""
    system, where = _folder(spark, path)
    system.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file of the driver's, replaced if it is there."""
    system, where = _folder(spark, path)
    out = system.create(where, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file; ``None`` when there is none."""
    system, where = _folder(spark, path)
    if not system.exists(where):
        return None
    source = system.open(where)
    try:
        return bytes(source.readAllBytes()).decode("utf-8")
    finally:
        source.close()


def release_dropped_frames() -> None:
    """Let the JVM free what dropped frames held, such as the list of a table's files.

    Py4j's objects are in reference cycles, so the JVM's side of a dropped frame
    stays until Python's collector happens to run: by then the driver may hold
    the files of several tables at once.
    """
    gc.collect()


def require_persistent_catalog(spark: SparkSession) -> None:
    """Fail when catalog tables would be gone after this process.

    Set ``spark.sql.catalogImplementation=hive`` (with a shared metastore) to
    register tables that later jobs read by name.
    """
    if spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory":
        raise RuntimeError("a database needs a persistent catalog: set spark.sql.catalogImplementation=hive, or leave the database out")
