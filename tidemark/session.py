"""Session settings and shared working folders."""

from __future__ import annotations

import contextlib
import re
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Required for the semantics (DATE(ts) and "now" are UTC, as in the source).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}
# Preferred settings: applied only where the session still has Spark's own
# default, so a cluster operator's choice is never overridden.
PREFERRED_CONF = {
    "spark.sql.adaptive.enabled": ("true", "true"),
    "spark.sql.adaptive.coalescePartitions.enabled": ("true", "true"),
    "spark.sql.adaptive.skewJoin.enabled": ("true", "true"),
    "spark.sql.execution.arrow.pyspark.enabled": ("false", "true"),
    # Many small .json.gz objects: pack more of them into one read task.
    "spark.sql.files.openCostInBytes": ("4194304", str(1 << 20)),
}
SESSION_CONF = {**REQUIRED_CONF, **{k: v for k, (_, v) in PREFERRED_CONF.items()}}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None, extra: dict | None = None
                  ) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.ui.enabled"] = "false"
    # reliable checkpoints (merge sources, decoded batches) are removed once
    # their DataFrames are gone, so a long-running session does not pile them up
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_session_conf(spark)
    return spark


_LISTING_PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_SPARK_DEFAULT_LISTING_PARALLELISM = "10000"


def apply_session_conf(spark: SparkSession) -> None:
    """Runtime SQL settings the operators rely on (UTC clock; AQE and file
    packing where the operator has not chosen otherwise)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, (spark_default, v) in PREFERRED_CONF.items():
        try:
            if spark.conf.get(k, spark_default) == spark_default:
                spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: keep cluster value
            pass
    # A micro-batch of N new objects is listed by a job of up to N tasks
    # (Spark's default cap is 10000); keep it proportional to the cores
    # unless the operator has chosen a value.
    if spark.conf.get(_LISTING_PARALLELISM, _SPARK_DEFAULT_LISTING_PARALLELISM) == \
            _SPARK_DEFAULT_LISTING_PARALLELISM:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(_LISTING_PARALLELISM, str(min(10000, max(8, 4 * cores))))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to shared storage, and without it there
    is none to fall back to: a folder of one machine would lose what the others
    write. Only a session that runs in one process (``local`` master, as in
    tests) gets a folder of its own where it is unset."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current.rsplit("/", 1)[0] if _looks_uuid(current) else current
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _looks_uuid(path: str) -> bool:
    tail = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(tail)
        return True
    except ValueError:
        return False


def work_dir(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A fresh folder under ``root`` (default: the shared checkpoint folder);
    never reused."""
    base = f"{root.rstrip('/')}/_work" if root else f"{checkpoint_root(spark)}/tidemark-work"
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffle_files_dropped(spark: SparkSession):
    """Queries that end inside leave no shuffle files behind. For those whose
    whole result has been written: nobody reads their shuffles again."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before) if before else spark.conf.unset(_SHUFFLE_CLEANUP)


_copies = threading.local()


@contextlib.contextmanager
def working_copies(spark: SparkSession):
    """Releases at its end the copies that ``materialize`` wrote inside (in
    this thread), but for the paths added to the set it gives; those pass to
    the block around it, if there is one. For results that are written before
    the block ends: a DataFrame that still reads a released copy fails."""
    stack = _copies.__dict__.setdefault("stack", [])
    written: list[str] = []
    kept: set[str] = set()
    stack.append(written)
    try:
        yield kept
    finally:
        stack.pop()
        for path in written:
            if path not in kept:
                release(spark, path)
            elif stack:
                stack[-1].append(path)


def materialize(df, name: str, root: str | None = None, partition_by: tuple[str, ...] = ()):
    """Write ``df`` once as Parquet below ``root`` (a job's lake; default: the
    shared checkpoint folder) and return ``(reread DataFrame, path)``.

    Cuts the lineage like a reliable checkpoint and survives executor loss,
    but computes ``df`` exactly once (an eager ``checkpoint()`` of an uncached
    DataFrame runs it twice: for the count and again for the files) and
    stores it columnar; ``partition_by`` lets later reads of one value leave
    the others alone. The shuffles behind it go when it is complete. Call
    ``release`` when the data is no longer read."""
    spark = df.sparkSession
    path = work_dir(spark, name, root)
    if stack := getattr(_copies, "stack", None):
        stack[-1].append(path)
    writer = df.write.mode("overwrite")
    with shuffle_files_dropped(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns), path


def release(spark: SparkSession, path: str) -> None:
    """Drop a ``materialize``d copy (driver-side metadata delete)."""
    from tidemark.plans.storage import delete_path

    try:
        delete_path(spark, path)
    except Exception:  # best effort: never fail a finished job on cleanup
        pass
