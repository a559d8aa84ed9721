"""Object sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.paths import has_suffix, relative_name
from tidemark.session import materialize, release, shuffle_files_dropped
from tidemark.specs import OBJECT_SUFFIX, REPROCESS_DAYS

BINARY_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


#: Longer than any object's age (a hundred years).
_NO_AGE = "36500d"


def parse_execution_date(value) -> dt.datetime:
    """ISO text / datetime / None → aware UTC datetime.

    Naive values are UTC; offsets are converted to UTC; invalid text raises
    ``ValueError`` before anything is written. ``None``/'' = now."""
    if value is None or value == "":
        return dt.datetime.now(dt.timezone.utc)
    if isinstance(value, dt.datetime):
        d = value
    elif isinstance(value, dt.date):
        d = dt.datetime(value.year, value.month, value.day)
    else:
        try:
            d = dt.datetime.fromisoformat(str(value))
        except ValueError as exc:
            raise ValueError(f"the execution date isn't ISO 8601: {exc}") from None
    if d.tzinfo is None:
        d = d.replace(tzinfo=dt.timezone.utc)
    return d.astimezone(dt.timezone.utc)


def lookback_cutoff(execution_date=None, days: int = REPROCESS_DAYS) -> dt.datetime:
    """``execution_date − days`` (UTC)."""
    return parse_execution_date(execution_date) - dt.timedelta(days=days)


def _naive_utc(d: dt.datetime) -> dt.datetime:
    return d.astimezone(dt.timezone.utc).replace(tzinfo=None)


def filter_listing(listing: DataFrame, folder: str, cutoff, name_col: str = "name",
                   time_col: str = "modificationTime") -> DataFrame:
    """S3 predicate over any object listing: name under ``folder/``, suffix
    ``.json.gz``, updated at or after ``cutoff`` (inclusive)."""
    c = _naive_utc(parse_execution_date(cutoff))
    return listing.filter(
        F.startswith(F.col(name_col), F.lit(f"{folder}/"))
        & has_suffix(name_col, OBJECT_SUFFIX)
        & (F.col(time_col) >= F.lit(c).cast("timestamp"))
    )


def _binary_reader(spark: SparkSession):
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{OBJECT_SUFFIX}")
        .option("recursiveFileLookup", "true")
    )


def list_objects(spark: SparkSession, root: str, folder: str, cutoff) -> DataFrame:
    """S3: objects under ``root/folder/`` updated at or after ``cutoff``.

    ``binaryFile`` evaluates the ``modificationTime`` predicate while
    listing, so skipped objects are never opened; ``content`` is read only
    by the tasks that decode it. Adds ``name`` (relative object name)."""
    c = _naive_utc(parse_execution_date(cutoff))
    base = f"{root.rstrip('/')}/{folder}"
    try:
        files = _binary_reader(spark).load(base)
    except Exception as exc:  # absent folder = nothing to list
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], BINARY_FILE_SCHEMA).withColumn(
                "name", F.lit(None).cast("string"))
        raise
    files = files.filter(F.col("modificationTime") >= F.lit(c).cast("timestamp"))
    return files.withColumn("name", relative_name("path", root))


# -- listing by tasks -----------------------------------------------------------
_LISTED = "kind string, path string, modificationTime timestamp, length long"
_ENTRIES = pa.schema([("kind", pa.string()), ("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64())])
#: Entries in one Arrow batch of a listing.
_LIST_BATCH = 10_000


def _list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of each folder (URIs in): files, and folders to list next."""
    from pyarrow import fs as pafs

    from tidemark.operators.decode import _resolve

    rows: list[tuple] = []
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            filesystem, inside = _resolve(folder)
            base = folder.rstrip("/")
            for e in filesystem.get_file_info(pafs.FileSelector(inside, allow_not_found=True)):
                kind = {pafs.FileType.Directory: "folder", pafs.FileType.File: "object"}.get(e.type)
                if kind and not e.base_name.startswith((".", "_")):
                    # in milliseconds, as Spark reads it
                    at = e.mtime and e.mtime.replace(microsecond=e.mtime.microsecond // 1000 * 1000)
                    rows.append((kind, f"{base}/{e.base_name}", at, e.size))
                if len(rows) >= _LIST_BATCH:
                    yield _entry_batch(rows)
                    rows = []
    if rows:
        yield _entry_batch(rows)


def _entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_ENTRIES)], schema=_ENTRIES)


def list_changed(spark: SparkSession, root: str, folder: str, cutoff, work_root: str | None = None,
                 held: list[str] | None = None) -> DataFrame:
    """S3 by tasks: path, modificationTime, length and name of the objects under
    ``root/folder/`` (``root`` for folder '') updated at or after ``cutoff``.

    Folders are listed level by level, each level by one job whose tasks take a
    share of its folders; what a level has found is written, and only its number
    of folders comes back. The driver never holds the listing, which
    ``list_objects`` (Spark's file index) does. Objects are named as Spark names
    them, hidden entries are left out. Under a scheme that tasks can't list it
    is ``list_objects``. A task holds the entries of one folder at a time. The
    written levels' paths go to ``held``, for the caller to release."""
    from tidemark.operators.decode import OPENABLE, _resolve, scheme_of

    base = f"{root.rstrip('/')}/{folder}".rstrip("/")
    if scheme_of(root) not in OPENABLE:
        return list_objects(spark, root, folder, cutoff)
    if scheme_of(root) == "file":
        base = f"file:{_resolve(base)[1]}"
    c = F.lit(_naive_utc(parse_execution_date(cutoff))).cast("timestamp")
    level, levels, tasks = spark.createDataFrame([(base,)], "path string"), [], 1
    most = 4 * spark.sparkContext.defaultParallelism
    while tasks:
        found = level.repartition(tasks).mapInArrow(_list_folders, _LISTED)
        # of objects only the changed ones are kept
        found = found.where((F.col("kind") == "folder") | (has_suffix("path", OBJECT_SUFFIX) & (F.col("modificationTime") >= c)))
        found, path = materialize(found, "listing", work_root, ("kind",))
        levels.append(found)
        if held is not None:
            held.append(path)
        level = found.where(F.col("kind") == "folder").select("path")
        tasks = min(level.count(), most)
    every = reduce(DataFrame.unionByName, levels)
    objects = every.where(F.col("kind") == "object").select("path", "modificationTime", "length")
    return objects.withColumn("name", relative_name("path", root))


#: Longer than any object's age.
_EVER = "0001-01-01T00:00:00Z"
#: Written listings of micro-batches that are kept apart.
_LISTINGS_KEPT = 16


def objects_seen(checkpoint: str) -> str:
    """Where a stream that lists by tasks keeps its micro-batches' objects."""
    return f"{checkpoint.rstrip('/')}/tidemark_objects"


def new_objects(spark: SparkSession, root: str, checkpoint: str, batch_id: int, work_root: str | None = None) -> DataFrame:
    """S2 by tasks: the objects under ``root`` of micro-batch ``batch_id``, those
    that no earlier micro-batch has seen (by path, whatever their time).

    They are written below the checkpoint before they are given, so a replay of
    the batch gets the same ones, and the listings of earlier batches say what
    has been seen. The driver holds none of them. Many listings become one."""
    from tidemark.plans.storage import delete_path, list_dirs, path_exists

    base, own = objects_seen(checkpoint), f"batch-{batch_id}"
    columns = ["path", "modificationTime", "length", "name"]

    def read(names: list[str]) -> DataFrame:
        schema = "path string, modificationTime timestamp, length long, name string"
        return spark.read.schema(schema).parquet(*(f"{base}/{n}" for n in names))

    if not path_exists(spark, f"{base}/{own}/_SUCCESS"):
        seen = [n for n in list_dirs(spark, base) if int(n.rsplit("-", 1)[1]) < batch_id]
        if len(seen) > _LISTINGS_KEPT:
            upto = f"upto-{batch_id - 1}"
            if upto not in seen or not path_exists(spark, f"{base}/{upto}/_SUCCESS"):
                seen = [n for n in seen if n != upto]
                read(seen).write.mode("overwrite").parquet(f"{base}/{upto}")
            for n in seen:
                if n != upto:
                    delete_path(spark, f"{base}/{n}")
            seen = [upto]
        held: list[str] = []
        found = list_changed(spark, root, "", _EVER, work_root, held).select(*columns)
        if seen:
            found = found.join(read(seen).select("path"), "path", "left_anti").select(*columns)
        with shuffle_files_dropped(spark):
            found.write.mode("overwrite").parquet(f"{base}/{own}")
        for path in held:
            release(spark, path)
    return read([own])


def stream_objects(spark: SparkSession, root: str, max_files_per_trigger: int | None = None
                   ) -> DataFrame:
    """Unbounded discovery of new ``*.json.gz`` objects under ``root``.

    The file source remembers paths in its checkpoint; an object overwritten
    under the same name is not seen again (the daily re-read covers it). The
    driver lists and remembers all objects, and lists them here already, to
    learn the columns; ``new_objects`` does so by tasks."""
    r = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", f"*{OBJECT_SUFFIX}")
        .option("recursiveFileLookup", "true")
        # an object that arrives with an old time stamp (copied, restored) is
        # new all the same; the default would skip it after a week
        .option("maxFileAge", _NO_AGE)
    )
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(root).withColumn("name", relative_name("path", root))
