"""Stage and gold storage (K2, T1, T2, gold snapshot commit).

Stage: Parquet partitioned by ``p_date`` (payload: ``_partition_date``) and
``ingest_batch``. Every writer names its batch (``stream-<id>``,
``daily-<date>``), and writes with dynamic partition overwrite, so a replay
of the same batch replaces its own files instead of adding duplicates.

Gold: a version is a manifest, the list of the Parquet files that make it up.
Writers put new files into a folder of their own attempt, write the manifest,
and publish the version by creating its marker ``_commits/<n>`` exclusively.
Who comes second finds the marker taken, and does its merge again on the
version that was published before it, so no writer's rows are lost and a
published version never changes. Files hold ranges of the key; a merge
rewrites the files in which rows change and takes the others over.
"""

from __future__ import annotations

import datetime as dt
import logging
import os
import random
import re
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.jsonfn import canonical_json
from tidemark.operators.merge import ACTION, merge_plan
from tidemark.session import materialize, release
from tidemark.specs import INGEST_BATCH, FolderSpec

log = logging.getLogger(__name__)

COMMITS = "_commits"


# -- Hadoop FileSystem helpers (driver-side metadata only) --------------------
def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Small text file written to a temp name then renamed into place."""
    fs, p = _fs(spark, path)
    jvm = spark._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp-{dt.datetime.now().timestamp()}")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"could not publish {path}")


def create_marker(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a new small file; False if it already exists. Of several writers
    one succeeds: distributed file systems create exclusively, and on a local
    one, where Hadoop's client only looks before it writes, the system call
    does."""
    fs, p = _fs(spark, path)
    if fs.getScheme() == "file":
        local = p.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x", encoding="utf-8") as f:
                f.write(text)
            return True
        except FileExistsError:
            return False
    try:
        out = fs.create(p, False)
    except Py4JJavaError as exc:
        if "AlreadyExists" in exc.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    return True


def list_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        reader.close()


# -- stage -------------------------------------------------------------------
class StageStore:
    def __init__(self, path: str, spec: FolderSpec):
        self.path = path.rstrip("/")
        self.spec = spec

    def schema(self) -> T.StructType:
        s = self.spec.stage_schema()
        return T.StructType(s.fields + [T.StructField(INGEST_BATCH, T.StringType(), True)])

    def append(self, rows: DataFrame, batch_id: str, max_records_per_file: int = 1_000_000,
               rebalance: bool = True) -> None:
        """K2: append rows (row columns + partition column) as batch
        ``batch_id``.

        Never repartitioned by date (one busy day is not funnelled into one
        task). With ``rebalance`` (default) a ``REBALANCE`` hint lets AQE cut
        oversized input partitions (all records of one huge object arrive in
        one decode task) and merge tiny ones (thousands of small objects)
        into files of ``advisoryPartitionSizeInBytes``. Rows of a file are
        sorted by the folder's key (T1), so that a reader of some keys skips
        row groups by their statistics."""
        cols = self.spec.row_columns + [self.spec.partition_col]
        if rebalance:
            rows = rows.hint("rebalance")
        out = rows.select(*cols).withColumn(INGEST_BATCH, F.lit(str(batch_id)))
        if self.spec.key:
            out = out.sortWithinPartitions(self.spec.partition_col, INGEST_BATCH, self.spec.key)
        (out.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", max_records_per_file)
         .partitionBy(self.spec.partition_col, INGEST_BATCH)
         .parquet(self.path))

    def read(self, spark: SparkSession, as_of=None, retention: bool = True) -> DataFrame:
        """Stage rows; with ``as_of`` the partitions past retention are
        excluded (read-time expiry, pruned from the scan)."""
        if not path_exists(spark, self.path):
            df = spark.createDataFrame([], self.schema())
        else:
            df = spark.read.schema(self.schema()).option("basePath", self.path).parquet(self.path)
        if as_of is not None and retention:
            df = df.filter(F.col(self.spec.partition_col) > F.lit(retention_cutoff(as_of, self.spec.retention_days)))
        return df.drop(INGEST_BATCH)

    def compact(self, spark: SparkSession, before, min_batches: int = 16) -> list[str]:
        """Rewrite each closed date (before ``before``) that has at least
        ``min_batches`` batch folders as one batch. The old folders go after
        the new one is complete; stage readers bear duplicates, which is all
        that a failure between the two leaves."""
        from tidemark.operators.views import as_date

        done, prefix = [], f"{self.spec.partition_col}="
        for name in list_dirs(spark, self.path):
            day = name.removeprefix(prefix)
            if not name.startswith(prefix) or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", day) or day >= as_date(before).isoformat():
                continue
            batches = [b for b in list_dirs(spark, f"{self.path}/{name}") if b.startswith(f"{INGEST_BATCH}=")]
            if len(batches) < min_batches:
                continue
            paths = [f"{self.path}/{name}/{b}" for b in batches]
            rows = spark.read.schema(self.schema()).option("basePath", self.path).parquet(*paths)
            self.append(rows.drop(INGEST_BATCH), f"compact-{uuid.uuid4().hex[:12]}")
            for p in paths:
                delete_path(spark, p)
            done.append(name)
        return sorted(done)

    def expire(self, spark: SparkSession, as_of, days: int | None = None) -> list[str]:
        """Delete partitions whose date is ``days`` or more before
        ``as_of`` (metadata operation; no data is rewritten)."""
        days = self.spec.retention_days if days is None else days
        cutoff = retention_cutoff(as_of, days)
        gone = []
        prefix = f"{self.spec.partition_col}="
        for name in list_dirs(spark, self.path):
            if not name.startswith(prefix):
                continue
            try:
                d = dt.date.fromisoformat(name[len(prefix):])
            except ValueError:
                continue
            if d <= cutoff:
                delete_path(spark, f"{self.path}/{name}")
                gone.append(name)
        return sorted(gone)


def retention_cutoff(as_of, days: int) -> dt.date:
    """Last expired date: a partition is kept while ``p_date > as_of − days``."""
    from tidemark.operators.views import as_date
    return as_date(as_of) - dt.timedelta(days=int(days))


# -- gold --------------------------------------------------------------------
class CommitConflict(Exception):
    """Another writer has published the version first."""


class GoldStore:
    #: Times that a merge is done again after another writer's commit.
    ATTEMPTS = 20

    def __init__(self, path: str, spec: FolderSpec):
        self.path = path.rstrip("/")
        self.spec = spec

    # -- versions
    def versions(self, spark: SparkSession) -> list[int]:
        return sorted(int(n) for n in list_files(spark, f"{self.path}/{COMMITS}") if n.isdigit())

    def current_version(self, spark: SparkSession) -> int | None:
        return max(self.versions(spark), default=None)

    def files(self, spark: SparkSession, version: int) -> list[str]:
        """Data files of a version, relative to the table."""
        for _ in range(50):  # a marker is created, then written
            name = read_text(spark, f"{self.path}/{COMMITS}/{version:020d}")
            if name:
                return (read_text(spark, f"{self.path}/{name}") or "").split()
            time.sleep(0.1)
        raise OSError(f"version {version} of {self.path} names no manifest")

    def _publish(self, spark: SparkSession, base: int | None, files: list[str], first: int = 1) -> int:
        """Make ``files`` the version after ``base``; ``CommitConflict`` when
        that version exists already."""
        version = first if base is None else base + 1
        manifest = f"_manifests/{uuid.uuid4().hex}"
        write_text(spark, f"{self.path}/{manifest}", "\n".join(files))
        if not create_marker(spark, f"{self.path}/{COMMITS}/{version:020d}", manifest):
            delete_path(spark, f"{self.path}/{manifest}")
            raise CommitConflict(f"version {version} of {self.path}")
        return version

    # -- rows
    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        v = self.current_version(spark) if version is None else version
        return self._read_files(spark, [] if v is None else self.files(spark, v))

    def _read_files(self, spark: SparkSession, files: list[str]) -> DataFrame:
        schema = self.spec.gold_schema()
        if not files:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in files))

    def _write(self, spark: SparkSession, rows: DataFrame) -> tuple[str, list[str]]:
        """Write rows as files of a new attempt, each a sorted range of keys:
        (the attempt's folder, its files that have rows)."""
        out = rows.select(*self.spec.gold_schema().fieldNames())
        if self.spec.key:
            out = out.repartitionByRange(self.spec.key).sortWithinPartitions(self.spec.key)
        folder = f"data/{uuid.uuid4().hex}"
        out.write.mode("errorifexists").parquet(f"{self.path}/{folder}")
        return folder, [f"{folder}/{n}" for n in list_files(spark, f"{self.path}/{folder}") if n.endswith(".parquet")]

    def _attempt(self, spark: SparkSession, change, keep_empty: bool = True) -> int:
        """``change(version, files)`` gives (rows to write or None, files to
        take over); done again until no other writer comes between. Without
        ``keep_empty`` rows that turn out to be none, once written, make no
        version."""
        for k in range(self.ATTEMPTS):
            base = self.current_version(spark)
            files = [] if base is None else self.files(spark, base)
            rows, kept = change(base, files)
            if rows is None and base is not None:
                return base
            folder, new = self._write(spark, spark.createDataFrame([], self.spec.gold_schema()) if rows is None else rows)
            if base is not None and not keep_empty and self._read_files(spark, new).isEmpty():
                delete_path(spark, f"{self.path}/{folder}")
                return base
            try:
                return self._publish(spark, base, kept + new)
            except CommitConflict:
                delete_path(spark, f"{self.path}/{folder}")
                log.info("%s: version after %s was taken, attempt %d", self.path, base, k + 1)
                time.sleep(random.uniform(0, 0.2 * (k + 1)))
        raise CommitConflict(f"{self.path}: {self.ATTEMPTS} attempts")

    def commit(self, spark: SparkSession, rows: DataFrame) -> int:
        """Make ``rows`` the whole table."""
        return self._attempt(spark, lambda base, files: (rows, []))

    def append(self, spark: SparkSession, rows_for) -> int:
        """Add rows, as files of their own. ``rows_for``: the rows, or a
        function that finds them given gold, which an insert-only merge needs
        (another writer may have inserted some meanwhile)."""
        def change(base, files):
            return (rows_for(self._read_files(spark, files)) if callable(rows_for) else rows_for), files

        return self._attempt(spark, change, keep_empty=False)  # the rows are computed once, by the write

    def upsert(self, spark: SparkSession, source: DataFrame, broadcast: bool, work_root: str | None = None) -> dict:
        """M1: insert the keys that gold lacks and replace the rows that are
        older than the source's. ``source`` holds one row for each key and
        should be a written table; ``broadcast`` says that it is small.

        Gold's key, order and file name are joined with the source's key and
        order; rows are read and rewritten only of files in which one changes.
        Nothing is written when none does."""
        key, order, columns = self.spec.key, self.spec.order_col, self.spec.row_columns
        hint = F.broadcast if broadcast else (lambda d: d)
        done: dict = {}

        def change(base, files):
            gold = self._read_files(spark, files)
            if files:
                gold = gold.select(key, F.col(order).alias("_order"), F.col("_metadata.file_path").alias("_file"))
            else:
                gold = gold.select(key, F.col(order).alias("_order"), F.lit("").alias("_file"))
            s = source.select(key, F.col(order).alias("_new"))
            # the matched part of gold is no larger than the source
            matched, tmp = materialize(gold.join(hint(s), key).select(key, "_file", (F.col("_new") > F.col("_order")).alias("_newer")),
                                       "matched", work_root)
            try:
                touched = sorted(r["_file"] for r in matched.where("_newer").select("_file").distinct().collect())
                kept_keys = matched.where("not coalesce(_newer, false)").select(key)
                changes = source.join(kept_keys, key, "left_anti")
                n = changes.count()
                done.update(changed=n, files=len(files), rewritten=len(touched))
                if n == 0:
                    return None, files
                names = {f"{f.rsplit('/', 2)[-2]}/{f.rsplit('/', 1)[-1]}" for f in touched}
                old = [f for f in files if f.split("/", 1)[1] in names]
                if len(old) != len(touched):
                    raise OSError(f"files of {self.path} don't match its manifest")
                rows = merge_plan(self._read_files(spark, old), changes, key, order, columns,
                                  "broadcast" if broadcast else "shuffle").drop(ACTION)
                rows, done["tmp"] = materialize(rows, "merged", work_root)
                return rows, [f for f in files if f not in set(old)]
            finally:
                release(spark, tmp)

        done["version"] = self._attempt(spark, change)
        if "tmp" in done:
            release(spark, done.pop("tmp"))
        return done

    def vacuum(self, spark: SparkSession, keep: int = 2) -> list[int]:
        """Drop all versions but the last ``keep``, with the files that only
        they have. Files of attempts that haven't been published stay."""
        versions = self.versions(spark)
        gone, kept = versions[:-keep] if keep else versions[:-1], versions[-keep:] if keep else versions[-1:]
        if not gone:
            return []
        used = {f for v in kept for f in self.files(spark, v)}
        for v in gone:
            old = self.files(spark, v)
            manifest = read_text(spark, f"{self.path}/{COMMITS}/{v:020d}")
            for f in old:
                if f not in used:
                    delete_path(spark, f"{self.path}/{f}")
            for folder in {f.rsplit("/", 1)[0] for f in old} - {f.rsplit("/", 1)[0] for f in used}:
                delete_path(spark, f"{self.path}/{folder}")
            delete_path(spark, f"{self.path}/{COMMITS}/{v:020d}")
            delete_path(spark, f"{self.path}/{manifest}")
        return gone


def create_tables(spark: SparkSession, lake_root: str, registry) -> DataFrame:
    """Folders and empty version 0 of every gold table; returns the
    table list (name, kind, location, columns)."""
    rows = []
    for spec in registry:
        st = StageStore(f"{lake_root}/stage/{spec.stage_table}", spec)
        g = GoldStore(f"{lake_root}/gold/{spec.gold_table}", spec)
        fs, p = _fs(spark, st.path)
        fs.mkdirs(p)
        if g.current_version(spark) is None:
            g._publish(spark, None, [], first=0)
        rows.append((spec.stage_table, "stage", st.path, len(st.schema().fields) - 1))
        rows.append((spec.gold_table, "gold", g.path, len(spec.gold_schema().fields)))
    return spark.createDataFrame(rows, "table string, kind string, location string, n_columns int")


class CatalogGoldStore:
    """Gold as a catalog table whose format supports row-level MERGE
    (Iceberg, Delta, … configured on the cluster).

    The merge is then Spark's own ``DataFrame.mergeInto``: the table format
    rewrites only the files holding matched keys, instead of the snapshot
    store's copy-on-write of the whole table. Same rules: update all columns
    when ``S.order > T.order``, insert unmatched keys; insert-only for
    payload tables. Plain Parquet tables refuse MERGE (Spark raises
    ``UNSUPPORTED_FEATURE.TABLE_OPERATION``); use ``GoldStore`` there."""

    def __init__(self, table: str, spec: FolderSpec):
        self.table = table
        self.spec = spec
        self.alias = table.split(".")[-1].strip("`")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def upsert(self, source: DataFrame) -> None:
        key, order = self.spec.key, self.spec.order_col
        t = self.alias
        (source.select(*self.spec.row_columns).alias("S")
         .mergeInto(self.table, F.expr(f"{t}.`{key}` = S.`{key}`"))
         .whenMatched(F.expr(f"S.`{order}` > {t}.`{order}`")).updateAll()
         .whenNotMatched().insertAll()
         .merge())

    def insert_only(self, source: DataFrame, now, last_updated: str) -> None:
        t = self.alias
        ident = canonical_json(F.col(f"{t}.payload")) == canonical_json(F.col("S.payload"))
        (source.select(*self.spec.row_columns)
         .withColumn(last_updated, F.lit(now).cast("timestamp")).alias("S")
         .mergeInto(self.table, ident)
         .whenNotMatched().insertAll()
         .merge())


def write_bucketed(rows: DataFrame, table: str, key: str, path: str | None = None, buckets: int | None = None) -> None:
    """Make ``rows`` a catalog table bucketed and sorted by ``key`` (at ``path``;
    default: the warehouse). A merge that joins it on the key shuffles the
    source into its buckets and leaves the table where it is. ``buckets``:
    default the session's shuffle partitions, rows are dealt to one task each."""
    n = buckets or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def append_stage(rows: DataFrame, spec: FolderSpec, path: str, batch_id: str) -> None:
    """K2: batch append of stage rows (an empty input writes nothing)."""
    StageStore(path, spec).append(rows, batch_id)


def expire_partitions(spark: SparkSession, path: str, spec: FolderSpec, as_of,
                      days: int | None = None) -> list[str]:
    """Drop stage partitions older than the retention."""
    return StageStore(path, spec).expire(spark, as_of, days)
