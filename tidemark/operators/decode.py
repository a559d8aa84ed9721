"""Object decoding (D1–D6): gzip JSON objects → one row per record.

The only Python operator of the pipeline. JSON *syntax* must be judged per
file with all-or-nothing semantics (one bad line voids the whole object and
yields exactly one error row), trailing text must fail and duplicate keys
keep the last value; Catalyst's JSON readers differ on all three, so the
syntax check runs in ``mapInArrow`` over Arrow batches. Everything after it
(field extraction, typing, routing) is Catalyst again.

One decoder serves every object size. It reads the object in pieces, so a
task holds one record and the records of ``HOLD_BYTES`` at most: an object
whose records fit is decoded once, a larger one is read a second time to emit
them after the first reading has found it sound. Time is linear in the
object's size, however its records and lines are laid out.
"""

from __future__ import annotations

import codecs
import gzip
import io
import json
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECODED_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), True),
        T.StructField("modificationTime", T.TimestampType(), True),
        T.StructField("ordinal", T.LongType(), True),
        T.StructField("record_json", T.StringType(), True),
        T.StructField("error", T.StringType(), True),
    ]
)

_OUT_FIELDS = [
    pa.field("path", pa.string()),
    pa.field("modificationTime", pa.timestamp("us", tz="UTC")),
    pa.field("ordinal", pa.int64()),
    pa.field("record_json", pa.string()),
    pa.field("error", pa.string()),
]
_OUT_ARROW = pa.schema(_OUT_FIELDS)
_BATCH_ROWS = 4096


class DecodeError(Exception):
    def __init__(self, kind: str, detail: str):
        super().__init__(f"{kind}: {detail}")
        self.kind = kind


#: Bytes read from an object at a time.
_PIECE = 1 << 18
#: Records of this many characters are held while the rest of their object is
#: checked; beyond it they are read again.
HOLD_BYTES = 8 << 20
_GZIP_ERRORS = (OSError, EOFError, zlib.error)
_JSON_BLANK = " \t\n\r"

#: Numbers that a double would change: many digits, or an exponent.
_LONG_NUMBER = re.compile(r"[0-9][0-9.]{16}|(?:^|[\[,:\s])-?[0-9]+(?:\.[0-9]+)?[eE]")
#: What any of them holds; found sooner.
_MAYBE_LONG = re.compile(r"[0-9](?:[0-9.]{16}|[eE])")

Opener = Callable[[], io.IOBase]


class _Ahead:
    """An open object of which ``head`` has been read already."""

    def __init__(self, head: bytes, raw):
        self.head, self.raw = head, raw

    def read(self, n: int = -1) -> bytes:
        if not self.head:
            return self.raw.read(n)
        out, self.head = self.head if n < 0 else self.head[:n], b"" if n < 0 else self.head[n:]
        # as much as was asked for: gzip takes a short read for the end
        return out + self.raw.read(n - len(out) if n >= 0 else n) if n < 0 or len(out) < n else out


def _small_text(head: bytes) -> str | None:
    """Text of a small object that is one sound gzip member; None for any
    other, which the general path reads (or finds its error)."""
    member = zlib.decompressobj(wbits=31)
    try:
        plain = member.decompress(head, _PIECE)
        return plain.decode() if member.eof and not member.unused_data else None
    except (zlib.error, UnicodeDecodeError):
        return None


def _text_pieces(source: Opener) -> Iterator[str]:
    """Decoded text of a gzip object, piece by piece. What can't be
    decompressed counts before what isn't UTF-8, so after a UTF-8 error the
    rest is still decompressed."""
    with source() as raw:
        try:
            head = raw.read(_PIECE)
            text = None if len(head) == _PIECE else _small_text(head)
            if text is not None:
                more = raw.read(1)  # a short read isn't an end yet
                head, text = (head + more, None) if more else (head, text)
        except _GZIP_ERRORS as exc:
            raise DecodeError("gzip", str(exc)) from None
        if text is None:
            yield from _inflated(_Ahead(head, raw))
        elif text:
            yield text


def _inflated(raw) -> Iterator[str]:
    utf8 = codecs.getincrementaldecoder("utf-8")()
    broken = None
    with gzip.GzipFile(fileobj=raw) as plain:
        while True:
            try:
                piece = plain.read(_PIECE)
            except _GZIP_ERRORS as exc:
                raise DecodeError("gzip", str(exc)) from None
            if broken is None:
                try:
                    text = utf8.decode(piece, final=not piece)
                except UnicodeDecodeError as exc:
                    broken = str(exc)
                else:
                    if text:
                        yield text
            if not piece:
                break
    if broken is not None:
        raise DecodeError("utf8", broken)


class _Problems:
    """The problem that an object is reported with: text that isn't JSON
    anywhere in it counts before a record that isn't an object."""

    def __init__(self):
        self.syntax: DecodeError | None = None
        self.shape: DecodeError | None = None

    def not_json(self, detail) -> None:
        if self.syntax is None:
            self.syntax = DecodeError("json", str(detail))

    def record(self, number: int, value, raw: str) -> str | None:
        """Compact text of a record (its own text where a number has more
        digits than a double); None once there is a problem."""
        if not isinstance(value, dict):
            if self.shape is None:
                self.shape = DecodeError("not_object", f"record {number} is {type(value).__name__}, expected object")
        elif self.syntax is None and self.shape is None:
            try:
                text = _ENCODER.encode(value)
                text.encode()
                return raw.strip() if _MAYBE_LONG.search(raw) and _LONG_NUMBER.search(raw) else text
            except UnicodeEncodeError:
                self.not_json(f"record {number} holds a lone surrogate, which has no UTF-8 form")
            except RecursionError as exc:
                self.not_json(exc)
        return None

    def settle(self) -> None:
        if self.syntax or self.shape:
            raise self.syntax or self.shape


def _lines(pieces: Iterator[str]) -> Iterator[str]:
    """Non-blank lines (``str.splitlines``'s ends); blanks around the whole
    text don't belong to its first and last line."""
    kept: list[str] = []  # of the line that isn't complete yet
    waiting = None
    for piece in pieces:
        if kept and kept[-1].endswith("\r"):  # its line feed may come with this piece
            piece = kept.pop() + piece
        parts = piece.splitlines(keepends=True)
        for k, part in enumerate(parts, 1):
            kept.append(part)
            ended = part.splitlines()[0] != part
            if not ended or part.endswith("\r") and k == len(parts):
                continue
            line = "".join(kept).splitlines()[0]
            kept = []
            if line.strip():
                if waiting is not None:
                    yield waiting
                waiting = line
    line = "".join(kept).splitlines()[0] if kept else ""
    if line.strip():
        if waiting is not None:
            yield waiting
        waiting = line
    if waiting is not None:
        yield waiting.rstrip()


def _line_records(pieces: Iterator[str], problems: _Problems) -> Iterator[str]:
    for number, line in enumerate(_lines(pieces)):
        if problems.syntax is not None:
            continue  # what follows may still not decompress or decode
        try:
            value = json.loads(line)
        except (ValueError, RecursionError) as exc:
            problems.not_json(exc)
            continue
        text = problems.record(number, value, line)
        if text is not None:
            yield text


class _Window:
    """A stretch of text over pieces: what is parsed is dropped; to complete
    one value it grows by doubling."""

    def __init__(self, first: str, pieces: Iterator[str]):
        self.text, self.at, self.pieces, self.ended = first, 0, pieces, False

    def grow(self) -> bool:
        parts, want = [self.text[self.at:]], len(self.text) - self.at
        got = 0
        for piece in self.pieces:
            parts.append(piece)
            got += len(piece)
            if got >= want:
                break
        else:
            self.ended = True
        self.text, self.at = "".join(parts), 0
        return got > 0

    def peek(self) -> str:
        """The next character that isn't blank, '' at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in _JSON_BLANK:
                self.at += 1
            if self.at < len(self.text):
                return self.text[self.at]
            if not self.grow():
                return ""

    def value(self):
        """The JSON value that starts here, and its text."""
        while True:
            try:
                value, end = _DECODER.raw_decode(self.text, self.at)
            except json.JSONDecodeError as exc:
                # only near the end of what has been read can an error mean
                # that the value goes on
                cut = exc.pos >= len(self.text) - 16 or exc.msg.startswith("Unterminated string")
                if cut and self.grow():
                    continue
                raise ValueError(exc.msg) from None
            if end == len(self.text) and not self.ended and self.grow():
                continue  # a number may go on
            raw, self.at = self.text[self.at:end], end
            return value, raw


_DECODER = json.JSONDecoder()
_ENCODER = json.JSONEncoder(ensure_ascii=False, separators=(",", ":"))


def _array_records(first: str, pieces: Iterator[str], problems: _Problems) -> Iterator[str]:
    window = _Window(first, pieces)
    window.at = 1  # the bracket
    number = 0
    try:
        if window.peek() == "]":
            window.at += 1
        else:
            while True:
                if not window.peek():
                    raise ValueError("the array isn't closed")
                value, raw = window.value()
                text = problems.record(number, value, raw)
                if text is not None:
                    yield text
                number += 1
                after = window.peek()
                if after not in (",", "]"):
                    raise ValueError("expected ',' or ']'")
                window.at += 1
                if after == "]":
                    break
        rest = window.text[window.at:]
        while not rest.strip():
            rest = next(pieces, None)
            if rest is None:
                return
        raise ValueError("text follows the array")
    except (ValueError, RecursionError) as exc:
        problems.not_json(f"record {number}: {exc}")
    for _ in pieces:  # what follows may still not decompress or decode
        pass


def _walk(source: Opener) -> Iterator[str]:
    """Records of an object; a problem is raised at the end."""
    pieces = _text_pieces(source)
    first = ""
    for piece in pieces:
        first = piece.lstrip()
        if first:
            break
    problems = _Problems()
    if first.startswith("["):
        yield from _array_records(first, pieces, problems)
    elif first:
        yield from _line_records(_chain(first, pieces), problems)
    problems.settle()


def _chain(first: str, rest: Iterator[str]) -> Iterator[str]:
    yield first
    yield from rest


def iter_records(source: bytes | Opener | None) -> Iterator[str]:
    """Compact JSON texts of one object's records, given as bytes or as a
    function that opens it.

    All or nothing: a problem raises ``DecodeError`` (kind ``gzip``, ``utf8``,
    ``json``, ``not_object`` or ``read``) before the first record. Only an
    object that changes between the two readings of a large one is found out
    later; it raises kind ``changed`` after records were given, which the
    caller has to drop. A blank object has no records."""
    if source is None:
        raise DecodeError("read", "object has no content")
    opener = source if callable(source) else lambda: io.BytesIO(source)
    held: list[str] | None = []
    size = check = 0
    for text in _walk(opener):
        size += len(text)
        if held is None:
            check = zlib.crc32(text.encode(), check)
            continue
        held.append(text)
        if size > HOLD_BYTES:  # only then is there a second reading to compare with
            for early in held:
                check = zlib.crc32(early.encode(), check)
            held = None
    if held is not None:
        yield from held
        return
    again = 0
    try:
        for text in _walk(opener):
            again = zlib.crc32(text.encode(), again)
            yield text
    except Exception as exc:  # noqa: BLE001 - it could be read a moment ago
        raise DecodeError(CHANGED, str(exc)) from None
    if again != check:
        raise DecodeError(CHANGED, "the object changed while it was read")


#: Kind of the error row that voids records of the same object.
CHANGED = "changed"


def decode_blob(data: bytes | None) -> list[str]:
    """All records of an object's bytes."""
    return list(iter_records(data))


def iter_records_path(path: str) -> Iterator[str]:
    """``iter_records`` of an object opened by URI."""
    filesystem, p = _resolve(path)
    return iter_records(lambda: filesystem.open_input_stream(p, compression=None))


class _Out:
    """Column buffers flushed as Arrow batches of bounded size."""

    def __init__(self):
        self.reset()

    def reset(self):
        self.cols = {f.name: [] for f in _OUT_FIELDS}

    def add(self, path, mtime, ordinal, record, error):
        c = self.cols
        c["path"].append(path)
        c["modificationTime"].append(mtime)
        c["ordinal"].append(ordinal)
        c["record_json"].append(record)
        c["error"].append(error)

    def __len__(self):
        return len(self.cols["path"])

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(self.cols[f.name], type=f.type) for f in _OUT_FIELDS]
        self.reset()
        return pa.RecordBatch.from_arrays(arrays, schema=_OUT_ARROW)


def _object_rows(records: Callable[[], Iterator[str]]) -> Iterator[tuple[int | None, str | None, str | None]]:
    """(ordinal, record, error) of one object: its records, or one error."""
    try:
        for number, text in enumerate(records()):
            yield number, text, None
    except DecodeError as exc:
        yield None, None, str(exc)
    except Exception as exc:  # noqa: BLE001 - missing or unreadable: a dead letter, not a failed job
        yield None, None, f"read: {exc}"


def _decode_content_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Out()
    for b in batches:
        paths = b.column("path").to_pylist()
        mtimes = b.column("modificationTime").to_pylist()
        content = b.column("content")
        for i, (path, mtime) in enumerate(zip(paths, mtimes)):
            blob = content[i].as_py()
            for number, text, error in _object_rows(lambda blob=blob: iter_records(blob)):
                out.add(path, mtime, number, text, error)
                if len(out) >= _BATCH_ROWS:
                    yield out.batch()
    if len(out):
        yield out.batch()


_FS_CACHE: dict = {}


#: Names that Hadoop gives to stores which Arrow opens by another.
_ALIASES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss", "": "file"}
#: Schemes that the tasks' filesystem client opens.
OPENABLE = ("file", "s3", "gs", "gcs", "hdfs", "abfs", "abfss")


def scheme_of(uri: str) -> str:
    """The client's name of a URI's (or plain path's) scheme."""
    scheme = uri.split(":", 1)[0].lower() if ":" in uri.split("/", 1)[0] else ""
    return _ALIASES.get(scheme, scheme)


def openable_scheme(uri: str) -> str:
    """``scheme_of``; ``ValueError`` for one that tasks couldn't open (asked on
    the driver, before any work)."""
    scheme = scheme_of(uri)
    if scheme not in OPENABLE:
        raise ValueError(f"objects can't be opened by their URI under scheme {scheme!r}")
    return scheme


def _resolve(path: str):
    """(filesystem, path) for a URI; one client per scheme and authority and
    Python worker."""
    from pyarrow import fs as pafs

    scheme = openable_scheme(path)
    if scheme == "file":
        key, p = ("file", ""), path.split("://", 1)[1] if "://" in path else path.removeprefix("file:")
    else:
        rest = path.split("://", 1)[1]
        key, p = (scheme, rest.split("/", 1)[0]), None
    if key not in _FS_CACHE:
        _FS_CACHE[key] = pafs.LocalFileSystem() if scheme == "file" else pafs.FileSystem.from_uri(f"{scheme}://{rest}")[0]
    if p is None:
        p = pafs.FileSystem.from_uri(f"{scheme}://{rest}")[1] if scheme == "hdfs" else rest
    return _FS_CACHE[key], p


def _decode_path_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cols = {f.name: [] for f in _PATH_OUT_FIELDS}
    for b in batches:
        rows = zip(*(b.column(c).to_pylist() for c in ("path", "folder", "modificationTime")))
        for path, folder, mtime in rows:
            for number, text, error in _object_rows(lambda path=path: iter_records_path(path)):
                for c, v in zip(cols, (path, mtime, number, text, error, folder)):
                    cols[c].append(v)
                if len(cols["path"]) >= _BATCH_ROWS:
                    yield _to_batch(cols)
                    cols = {f.name: [] for f in _PATH_OUT_FIELDS}
    if cols["path"]:
        yield _to_batch(cols)


_PATH_OUT_FIELDS = _OUT_FIELDS + [pa.field("folder", pa.string())]
_PATH_OUT_ARROW = pa.schema(_PATH_OUT_FIELDS)
PATH_DECODED_SCHEMA = T.StructType(
    DECODED_SCHEMA.fields + [T.StructField("folder", T.StringType(), True)]
)


def _to_batch(cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[f.name], type=f.type) for f in _PATH_OUT_FIELDS], schema=_PATH_OUT_ARROW
    )


def decode_objects(files: DataFrame) -> DataFrame:
    """``binaryFile`` rows ``(path, modificationTime, content, …)`` →
    ``(path, modificationTime, ordinal, record_json, error)``.

    Good objects give one row per record (``error`` NULL); a bad object
    gives exactly one row with ``error`` set and no records; a blank object
    gives nothing. Runs as one narrow ``mapInArrow`` stage: no shuffle.
    """
    src = files.select(
        F.col("path").cast("string").alias("path"),
        F.col("modificationTime").cast("timestamp").alias("modificationTime"),
        F.col("content").cast("binary").alias("content"),
    )
    return src.mapInArrow(_decode_content_batches, DECODED_SCHEMA)


def decode_paths(paths: DataFrame, path_col: str = "path", folder_col: str = "folder",
                 num_partitions: int | None = None, mtime_col: str | None = None) -> DataFrame:
    """Same as ``decode_objects`` for bare object URIs (notification
    source): each task opens its objects itself through ``pyarrow.fs``; a
    missing object is an error row, not a failed job. ``folder`` is carried
    through.

    Message batches often arrive in few partitions while the cost is in the
    object reads, so the (small) path rows are spread round-robin over
    ``num_partitions`` tasks (default: the cluster's parallelism) first."""
    n = num_partitions or paths.sparkSession.sparkContext.defaultParallelism
    mtime = F.col(mtime_col) if mtime_col else F.lit(None)
    src = paths.select(
        F.col(path_col).cast("string").alias("path"),
        F.col(folder_col).cast("string").alias("folder"),
        mtime.cast("timestamp").alias("modificationTime"),
    ).repartition(max(1, int(n)))
    return src.mapInArrow(_decode_path_batches, PATH_DECODED_SCHEMA)
