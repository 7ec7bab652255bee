"""Session construction and the shared work folder.

Jobs that must cut lineage or materialise an intermediate table write under
the folder the cluster names in ``spark.checkpoint.dir``.  Only when that is
unset (local tests) do we choose one ourselves.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import SparkSession


def _default_driver_memory() -> str:
    """Local mode runs everything in the driver JVM: ~60% of physical memory, between 1 and 16 GiB."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    gib = int(total * 0.6) >> 30
    return f"{min(16, max(1, gib))}g"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "fintide") -> SparkSession:
    """A session for tests, bench and local runs (cluster jobs get theirs from spark-submit)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("FINTIDE_DRIVER_MEMORY", _default_driver_memory()))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, choosing a local one only if none is configured."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; checkpoint() uses spark.checkpoint.dir
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not conf_dir:
        # A cluster names a folder that its executors share; only local sessions (tests) may choose their own.
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="fintide-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc is None:
        return conf_dir.rstrip("/")
    sc.setCheckpointDir(conf_dir)
    # setCheckpointDir adds a per-application sub-folder; return what Spark uses.
    return (sc.getCheckpointDir() or conf_dir).rstrip("/")


def app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        return spark.conf.get("spark.app.id", "connect")


_PATHS: list[str] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for a written table."""
    path = f"{ensure_checkpoint_dir(spark)}/fintide/{name}-{uuid.uuid4().hex[:12]}"
    _PATHS.append(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def work_scope(spark: SparkSession, keep: Callable[[], Iterable[str]] = tuple) -> Iterator[None]:
    """Delete the work folders that are asked for inside the block when it ends, but those that ``keep()`` then names.

    For a job that writes its result inside the block: nothing read later may depend on its intermediate tables.
    """
    begin = len(_PATHS)
    try:
        yield
    finally:
        kept = set(keep())
        made, _PATHS[begin:] = _PATHS[begin:], [p for p in _PATHS[begin:] if p in kept]
        for path in made:
            if path not in kept:
                delete_folder(spark, path)


_TABLES: list[str] = []


def work_table(database: str, name: str) -> str:
    """Note a catalog table over a work folder, so that ``clear_work`` drops it; returns ``name``."""
    _TABLES.append(f"`{database}`.`{name}`")
    return name


def clear_work(spark: SparkSession) -> None:
    """Drop this application's work tables and delete its written work folders (their results can't be read afterwards)."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    _PATHS.clear()
    delete_folder(spark, f"{ensure_checkpoint_dir(spark)}/fintide")
