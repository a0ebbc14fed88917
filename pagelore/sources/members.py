"""Text lines in gzip files of many members, as web archives are: many tasks read one file.

Spark gives a gzip file to one task, since it cannot begin in the middle. A file made of many
members can be entered wherever one begins. A task gets a range of bytes; it looks for the first
place in it that looks like the head of a member, decompresses from there to the end of the
member, checksum included, and takes the place only if that works. From there on it reads member
after member, as long as they begin in its range.
"""

import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

BYTES_PER_TASK = 64 * 1024 * 1024
LINES_PER_MEMBER = 10_000
_NAME = "gzip_members"
_HEAD = b"\x1f\x8b\x08"
_READ = 1024 * 1024
_ROWS = 10_000


def read_member_lines(
    spark: SparkSession, path: str, bytes_per_task: int = BYTES_PER_TASK
) -> DataFrame:
    """Lines (column ``value``) of all ``.gz`` files below a folder, or of one file.

    Lines end as in Spark's text reader. Each member but a file's last must end with a line
    break; another one fails the job, as its last line would go on in the next. Broken members
    fail. Bytes that are no UTF-8 become U+FFFD. Files of one member work, by one task each.
    Names beginning with ``.`` or ``_`` are left out. Files are read through Arrow: ``file``,
    ``hdfs``, ``s3``, ``gs``, ``abfs``.
    """
    spark.dataSource.register(GzipMembers)
    reader = spark.read.format(_NAME).option("bytesPerTask", bytes_per_task)
    return reader.load(path)


def write_member_lines(
    lines: DataFrame, path: str, lines_per_member: int = LINES_PER_MEMBER
) -> None:
    """Write a column ``value`` as such files, one for each partition; null is an empty line.

    A file gets its final name when its task is done, and is removed when the job fails.
    """
    lines.sparkSession.dataSource.register(GzipMembers)
    writer = lines.select("value").write.format(_NAME).option("linesPerMember", lines_per_member)
    writer.mode("append").save(path)


@dataclass
class Range(InputPartition):
    """Members of a file that begin at ``start`` or later, and before ``stop``."""

    path: str
    start: int
    stop: int


class GzipMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return _NAME

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        return MemberReader(
            self.options["path"], int(self.options.get("bytesPerTask", BYTES_PER_TASK))
        )

    def writer(self, schema, overwrite) -> DataSourceArrowWriter:
        return MemberWriter(
            self.options["path"], int(self.options.get("linesPerMember", LINES_PER_MEMBER))
        )


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    scheme, colon, rest = path.partition("://")
    if not colon:
        return pafs.FileSystem.from_uri(path)
    return pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + colon + rest)


class MemberReader(DataSourceReader):
    def __init__(self, path: str, bytes_per_task: int):
        self.path, self.bytes_per_task = path, bytes_per_task

    def partitions(self) -> list[Range]:
        fs, path = _open(self.path)
        found = fs.get_file_info(path)
        if found.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [found]
        if found.type == pafs.FileType.Directory:
            files = fs.get_file_info(pafs.FileSelector(path, recursive=True))
            files = [f for f in files if f.is_file and f.extension == "gz" and f.base_name[0] not in "._"]
        step = self.bytes_per_task
        return [
            Range(f.path, start, min(start + step, f.size))
            for f in files for start in range(0, f.size, step)
        ]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark passes when there are no files
            return
        fs, _ = _open(self.path)
        with fs.open_input_file(partition.path) as file:
            rows = []
            for line in _lines(file, partition):
                rows.append(line.decode("utf-8", "replace"))
                if len(rows) == _ROWS:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)


def _batch(rows: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["value"])


def _lines(file, part: Range) -> Iterator[bytes]:
    at = 0 if part.start == 0 else _first_member(file, part.start, part.stop)
    size = file.size()
    while at is not None and at < part.stop:
        member = Member(file, at)
        rest = b""
        for data in member:
            # The last piece may go on, also a break of two characters.
            pieces = (rest + data).splitlines(keepends=True)
            rest = pieces.pop() if pieces else b""
            yield from (piece.rstrip(b"\r\n") for piece in pieces)
        at = _skip_padding(file, member.end, size)
        if rest and at < size and not rest.endswith((b"\n", b"\r")):
            raise ValueError(f"{part.path}: the member before byte {at} ends within a line")
        if rest:
            yield rest.rstrip(b"\r\n")


class Member:
    """The text of one member, in pieces; ``end`` is known when all have been taken."""

    def __init__(self, file, start: int):
        self.file, self.start, self.end = file, start, None

    def __iter__(self) -> Iterator[bytes]:
        work, at, size = zlib.decompressobj(31), self.start, self.file.size()
        while not work.eof:
            data = work.unconsumed_tail
            if not data:
                if at >= size:
                    raise zlib.error("the last member is cut off")
                data = self.file.read_at(min(_READ, size - at), at)
                at += len(data)
            yield work.decompress(data, _READ)
        self.end = at - len(work.unused_data)


def _first_member(file, start: int, stop: int) -> int | None:
    """Where the first member of a range begins, or None. No text is kept while looking."""
    at = start
    while at < stop:
        # Heads may lie across the end of what is read.
        data = file.read_at(min(_READ, stop - at) + len(_HEAD) - 1, at)
        found = data.find(_HEAD)
        while found >= 0:
            if _is_member(file, at + found):
                return at + found
            found = data.find(_HEAD, found + 1)
        at += min(_READ, stop - at)
    return None


def _is_member(file, at: int) -> bool:
    try:
        for _ in Member(file, at):
            pass
    except zlib.error:
        return False
    return True


def _skip_padding(file, at: int, size: int) -> int:
    """Files may be filled up with zeros behind a member."""
    while at < size:
        data = file.read_at(min(_READ, size - at), at)
        left = data.lstrip(b"\0")
        at += len(data) - len(left)
        if left:
            break
    return at


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class MemberWriter(DataSourceArrowWriter):
    def __init__(self, path: str, lines_per_member: int):
        self.path, self.lines_per_member = path, lines_per_member

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = _open(self.path)
        fs.create_dir(folder, recursive=True)
        name = f"part-{uuid.uuid4().hex}.gz"
        hidden, final = (posixpath.join(folder, n) for n in (f".{name}", name))
        empty = True
        with fs.open_output_stream(hidden, compression=None) as out:
            for batch in iterator:
                for start in range(0, batch.num_rows, self.lines_per_member):
                    values = batch.column(0).slice(start, self.lines_per_member).to_pylist()
                    text = "".join(f"{value or ''}\n" for value in values)
                    work = zlib.compressobj(wbits=31)
                    out.write(work.compress(text.encode()) + work.flush())
                    empty = False
        if empty:
            fs.delete_file(hidden)
            return Written(None)
        fs.move(hidden, final)
        return Written(final)

    def abort(self, messages) -> None:
        fs, _ = _open(self.path)
        for message in messages:
            if message is not None and message.path is not None:
                fs.delete_file(message.path)
