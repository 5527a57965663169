"""A replayable line source and a labelled sink for streams, as Python data sources.

*Arrival log* (format ``arrival_log``).  Lines arrive by being appended to the
files of a folder; files are taken in the order of their names.  An offset is
how many bytes of each file were read, so a stream that stops in the middle of a
file goes on at the next line, and nothing is lost or read twice.  Rows are
``seq, file, offset, value``: ``seq`` is the file's number and the line's first
byte, so it is the same at every replay, needs no counting and gives a total
arrival order.  A line counts once its newline is there.  Large ranges of bytes
are cut into parts that tasks read side by side.

*Labelled sink* (format ``labelled_sink``).  Tasks write a file per label into a
folder of their batch; the driver then publishes the batch by one file that
lists them.  :func:`read_labelled` reads what is listed and nothing else, so all
labels of a batch appear at once and files of failed or repeated tasks never do.

Paths may be local or shared folders, or URIs that ``pyarrow.fs`` opens (hdfs,
s3, gs); executors and the driver must see the same files.
"""

from __future__ import annotations

import io
import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of a file that ``seq`` can tell apart: files below 2**40 bytes, 2**23 files.
FILE_BITS = 40
LINES = "seq long, file string, offset long, value string"


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class Bytes(InputPartition):
    """Lines of ``file`` that begin in ``[start, stop)``; ``first``: where the batch's range of that file begins."""

    number: int
    file: str
    first: int
    start: int
    stop: int
    end: int


class ArrivalLogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.part_bytes = int(options.get("partbytes", 32 << 20))
        self.batch_lines = 10_000

    def _files(self) -> list[tuple[str, int]]:
        fs, root = open_folder(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        named = [(posixpath.basename(f.path), f.size) for f in found if f.is_file]
        return sorted((n, s) for n, s in named if not n.startswith((".", "_")))

    def _whole_lines(self, name: str, size: int, block: int = 1 << 16) -> int:
        """Bytes up to and including the last newline, looked for from the end."""
        fs, root = open_folder(self.path)
        with fs.open_input_file(posixpath.join(root, name)) as f:
            end = size
            while end > 0:
                start = max(0, end - block)
                f.seek(start)
                at = f.read(end - start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                end = start
        return 0

    def initialOffset(self) -> dict:
        return {"files": "[]"}

    def latestOffset(self) -> dict:
        # A list of (name, bytes) as text: offsets hold plain values, and the files' numbers must not change later.
        return {"files": json.dumps([[n, self._whole_lines(n, s)] for n, s in self._files()])}

    def partitions(self, start: dict, end: dict) -> list[Bytes]:
        before, now = dict(map(tuple, json.loads(start["files"]))), json.loads(end["files"])
        known = [n for n, _ in json.loads(start["files"])]
        if known != [n for n, _ in now][: len(known)]:
            raise ValueError(f"{self.path}: files must be appended in the order of their names; {known} were there before")
        out = []
        for number, (name, stop) in enumerate(now):
            first = before.get(name, 0)
            out += [Bytes(number, name, first, at, min(at + self.part_bytes, stop), stop) for at in range(first, stop, self.part_bytes)]
        return out

    def read(self, part: Bytes) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(self.path)
        with io.BufferedReader(fs.open_input_file(posixpath.join(root, part.file)), 1 << 20) as f:
            at = part.start
            if at > part.first:  # a line that began before this part belongs to the part before
                f.seek(at - 1)
                at += len(f.readline()) - 1
            else:
                f.seek(at)
            seqs, offsets, values = [], [], []
            while at < part.stop:
                line = f.readline()
                seqs.append(part.number << FILE_BITS | at)
                offsets.append(at)
                values.append(line.removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", "replace"))
                at += len(line)
                if len(seqs) >= self.batch_lines:
                    yield _lines(seqs, part.file, offsets, values)
                    seqs, offsets, values = [], [], []
            yield _lines(seqs, part.file, offsets, values)


def _lines(seqs, file, offsets, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(seqs, pa.int64()), pa.array([file] * len(seqs), pa.string()), pa.array(offsets, pa.int64()), pa.array(values, pa.string())],
        ["seq", "file", "offset", "value"])


class ArrivalLog(DataSource):
    """``readStream.format("arrival_log").load(folder)``; option ``partBytes``: bytes that one task reads."""

    @classmethod
    def name(cls) -> str:
        return "arrival_log"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema) -> ArrivalLogReader:
        return ArrivalLogReader(dict(self.options))


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str, int]]  # label, path below the sink, rows


class LabelledWriter(DataSourceStreamArrowWriter):
    def __init__(self, schema, options: dict):
        self.path, self.label = options["path"], options.get("label", "route")
        self.columns = list(schema.names)
        self.arrow = to_arrow_schema(schema)
        if self.label not in self.columns:
            raise ValueError(f"no column {self.label!r} to label rows by")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, root = open_folder(self.path)
        mine, open_files, rows = uuid.uuid4().hex, {}, {}
        try:
            for b in batches:
                t = pa.Table.from_batches([b])
                labels = t[self.label].combine_chunks().dictionary_encode()
                codes = labels.indices.fill_null(-1)
                for code in codes.unique().to_pylist():
                    some = t.filter(pa.compute.equal(codes, code))
                    name = None if code < 0 else labels.dictionary[code].as_py()
                    if name not in open_files:
                        folder = posixpath.join(root, "data", mine)
                        fs.create_dir(folder, recursive=True)
                        file = posixpath.join("data", mine, f"{len(open_files)}.parquet")
                        open_files[name] = (file, pq.ParquetWriter(posixpath.join(root, file), some.schema, filesystem=fs))
                    open_files[name][1].write_table(some)
                    rows[name] = rows.get(name, 0) + some.num_rows
        finally:
            for _, w in open_files.values():
                w.close()
        return Written([(name, file, rows[name]) for name, (file, _) in open_files.items()])

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        """One file names all files of the batch: written aside, then moved in place."""
        fs, root = open_folder(self.path)
        files = [x for m in messages if m is not None for x in m.files]
        fs.create_dir(posixpath.join(root, "batches"), recursive=True)
        aside, place = posixpath.join(root, f".{uuid.uuid4().hex}"), posixpath.join(root, "batches", f"{batchId}.json")
        with fs.open_output_stream(aside) as out:
            out.write(json.dumps({"batch": batchId, "files": files}).encode())
        fs.move(aside, place)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        """What the tasks of a failed batch wrote goes; it was never listed."""
        fs, root = open_folder(self.path)
        for m in messages:
            for _, file, _ in m.files if m is not None else []:
                info = fs.get_file_info(posixpath.join(root, file))
                if info.type != pafs.FileType.NotFound:
                    fs.delete_file(info.path)


class LabelledSink(DataSource):
    """``writeStream.format("labelled_sink").option("label", column).start(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "labelled_sink"

    def streamWriter(self, schema, overwrite: bool) -> LabelledWriter:
        return LabelledWriter(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    """Make both formats known to the session (again is harmless)."""
    spark.dataSource.register(ArrivalLog)
    spark.dataSource.register(LabelledSink)


def stream_arrivals(spark: SparkSession, folder: str, part_bytes: int | None = None) -> DataFrame:
    """Unbounded line source: ``seq, file, offset, value`` of every line appended to the files of ``folder``."""
    register(spark)
    r = spark.readStream.format("arrival_log")
    if part_bytes:
        r = r.option("partBytes", str(part_bytes))
    return r.load(folder)


def published(path: str) -> list[dict]:
    """The published batches of a labelled sink, in order: ``batch`` and ``files`` (label, path, rows)."""
    fs, root = open_folder(path)
    found = fs.get_file_info(pafs.FileSelector(posixpath.join(root, "batches"), allow_not_found=True))
    out = []
    for f in found:
        with fs.open_input_file(f.path) as x:
            out.append(json.loads(x.read()))
    return sorted(out, key=lambda b: b["batch"])


def read_labelled(spark: SparkSession, path: str, schema, label: str | None = None, batches: list[int] | None = None) -> DataFrame:
    """Rows of the published batches, of one label if given; files that no published batch lists are not seen."""
    files = [f"{path.rstrip('/')}/{file}" for b in published(path) if batches is None or b["batch"] in batches
             for name, file, _ in b["files"] if label is None or name == label]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
