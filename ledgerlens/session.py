"""Spark session set-up shared by every job.

One place for the settings the jobs rely on: UTC session time (month labels
are UTC calendar months), ANSI mode on (bad casts fail loudly; parsing goes
through ``try_cast``), adaptive execution with skew-join splitting, and an
optional object-store connector configured through public ``fs.s3a.*``
Hadoop options.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job assumes. Sizes are per-task targets; adaptive execution
# merges small shuffle partitions up to the advisory size but does not split
# large ones of an aggregation, so their number has to follow the input
# (``build_session(input_bytes=...)``).
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def object_store_conf(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
    ssl: bool = False,
) -> dict[str, str]:
    """Hadoop S3A options for an S3-compatible object store.

    Returned as ``spark.hadoop.*`` keys so they are applied when the session
    is built and reach every executor, instead of being pushed into the
    driver's Hadoop configuration after start-up.
    """
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
    if access_key is not None:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
    if secret_key is not None:
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


# Cluster defaults: initial shuffle partitions for inputs of unknown size (about
# half a terabyte at the advisory size); small shuffles are merged down.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.shuffle.partitions": "4096",
}


ADVISORY_BYTES = 128 << 20


def shuffle_partitions_for(input_bytes: int) -> int:
    """Initial shuffle partitions for jobs that may shuffle most of their input."""
    return max(int(CLUSTER_CONF["spark.sql.shuffle.partitions"]), -(-input_bytes // ADVISORY_BYTES))


def build_session(
    master: str | None = None,
    app_name: str = "ledgerlens",
    conf: Mapping[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with :data:`BASE_CONF` plus ``conf``.

    ``input_bytes`` (the size of the exports) sets the cluster's initial
    shuffle partitions so that each stays near the advisory size.

    Defaults never override what the deployment already set (for example
    ``spark-submit --conf``); ``conf`` always applies.
    """
    from pyspark import SparkConf

    deployed = SparkConf()          # spark.* settings handed to this process
    defaults = dict(BASE_CONF)
    target = master or deployed.get("spark.master", "")
    if target and not target.startswith("local"):   # no master at all runs locally
        defaults.update(CLUSTER_CONF)
        if input_bytes:
            defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(input_bytes))
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in defaults.items():
        if not deployed.contains(key):
            builder = builder.config(key, value)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local benchmark."""
    return build_session(
        master=f"local[{cores}]",
        conf={
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": "16g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )


def session_key(spark: SparkSession) -> str:
    """Identity of the running application, for per-session caches."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        return f"session-{id(spark)}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, choosing one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS / object
    store) and is used as is; a cluster session without one is an error.
    Only a local-mode session without one (tests) gets a fresh scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the configuration is visible
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured
        # a folder of the client is not one of the executors
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)") from None
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        # executors on other machines cannot see a local folder
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
    path = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for intermediate tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(session_key(spark), []).append(path)
    return path


_SCRATCH: dict[str, list[str]] = {}


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this application has made; their number.

    For the end of an application: tables that still read them fail afterwards.
    """
    paths = _SCRATCH.pop(session_key(spark), [])
    for path in paths:
        p, fs = _file_system(spark, path)
        fs.delete(p, True)
    return len(paths)


def free_scratch(spark: SparkSession, path: str) -> None:
    """Delete one scratch folder that nothing reads any more."""
    paths = _SCRATCH.get(session_key(spark), [])
    if path in paths:
        paths.remove(path)
        p, fs = _file_system(spark, path)
        fs.delete(p, True)


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Data files of a folder, in order of their names, with their bytes."""
    p, fs = _file_system(spark, path)
    return sorted((f.getPath().toString(), f.getLen()) for f in fs.listStatus(p)
                  if f.isFile() and f.getPath().getName()[0] not in "._")


def delete_files(spark: SparkSession, files: Iterable[str]) -> None:
    """Delete files of a scratch folder that nothing reads any more."""
    for file in files:
        p, fs = _file_system(spark, file)
        fs.delete(p, False)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written inside go when its write has ended, not
    when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def path_version(spark: SparkSession, path: str) -> tuple:
    """What tells one state of a file or folder from another: names, sizes and
    times of its files. Nothing is known without a JVM at hand (Spark Connect);
    the value then never repeats."""
    try:
        p, fs = _file_system(spark, path)
    except Exception:
        return (object(),)
    status = fs.getFileStatus(p)
    files = fs.listStatus(p) if status.isDirectory() else [status]
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))
