"""Capture files ``<root>/<yyyy-MM-dd>/<name>`` as a Spark data source.

Reading lists folders and sizes first. Filters on ``folder_date`` and ``length`` are
answered from that listing, so files of other days, or of the wrong size, are
never opened; a file above ``maxBytes`` gives a row without content. Writing puts
each row's bytes in its dated folder, with a checksum sidecar beside them, and
never changes a file that is there.
"""

from __future__ import annotations

import fnmatch
import hashlib
import operator
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds

FORMAT = "order_captures"
SCHEMA = "path string, folder_date string, length bigint, content binary"
DAY = re.compile(r"\d{4}-\d{2}-\d{2}")
#: Bytes and files of one task, and bytes of one batch.
TASK_BYTES, TASK_FILES, BATCH_BYTES = 64 << 20, 256, 8 << 20
_COMPARED = {
    ds.EqualTo: operator.eq, ds.GreaterThan: operator.gt, ds.GreaterThanOrEqual: operator.ge,
    ds.LessThan: operator.lt, ds.LessThanOrEqual: operator.le,
}


def file_system(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path there; a path without a scheme is a local one."""
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:/", root):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", root).rstrip("/"))
    return fs.LocalFileSystem(), root.rstrip("/")


@dataclass
class Listed:
    """A file that is to be read: its path as the caller names it, and as its file system does."""

    path: str
    place: str
    folder_date: str
    length: int


def list_captures(root: str, name: str, keep=lambda column, value: True) -> Iterator[Listed]:
    """Files of the dated folders; ``keep`` judges a folder's date before the folder is listed, and a file's size."""
    system, base = file_system(root)
    if system.get_file_info(base).type != fs.FileType.Directory:
        return
    for folder in sorted(system.get_file_info(fs.FileSelector(base)), key=lambda f: f.path):
        if folder.type != fs.FileType.Directory or not DAY.fullmatch(folder.base_name) or not keep("folder_date", folder.base_name):
            continue
        for file in sorted(system.get_file_info(fs.FileSelector(folder.path)), key=lambda f: f.path):
            if file.type == fs.FileType.File and fnmatch.fnmatchcase(file.base_name, name) and keep("length", file.size):
                yield Listed(f"{root.rstrip('/')}/{folder.base_name}/{file.base_name}", file.path, folder.base_name, file.size)


class Files(ds.InputPartition):
    def __init__(self, files: list[Listed]):
        self.files = files


class CaptureReader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.name = options["path"], options.get("name", "orders.csv")
        most = options.get("maxbytes")
        self.most = int(most) if most is not None else None
        self.tests: list[tuple] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in ("folder_date", "length"):
                yield f
            elif type(f) in _COMPARED:
                self.tests.append((column, _COMPARED[type(f)], f.value))
            elif isinstance(f, ds.In):
                self.tests.append((column, lambda value, values: value in values, f.value))
            elif not isinstance(f, ds.IsNotNull):  # both are always there
                yield f

    def keep(self, column: str, value) -> bool:
        return all(compare(value, other) for of, compare, other in self.tests if of == column)

    def partitions(self) -> list[Files]:
        tasks, held, n_bytes = [], [], 0
        for file in list_captures(self.root, self.name, self.keep):
            size = file.length if self.most is None else min(file.length, self.most)
            if held and (n_bytes + size > TASK_BYTES or len(held) == TASK_FILES):
                tasks.append(Files(held))
                held, n_bytes = [], 0
            held.append(file)
            n_bytes += size
        return [*tasks, Files(held)] if held else tasks or [Files([])]

    def content(self, system: fs.FileSystem, file: Listed) -> bytes | None:
        if self.most is not None and file.length > self.most:
            return None
        with system.open_input_file(file.place) as stream:
            return stream.read()

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.root)
        rows: list[tuple] = []
        n_bytes = 0

        def batch() -> pa.RecordBatch:
            kinds = (("path", pa.string()), ("folder_date", pa.string()), ("length", pa.int64()), ("content", pa.binary()))
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], [n for n, _ in kinds])

        for file in partition.files:
            content = self.content(system, file)
            rows.append((file.path, file.folder_date, file.length, content))
            n_bytes += len(content or b"")
            if n_bytes >= BATCH_BYTES:
                yield batch()
                rows, n_bytes = [], 0
        if rows:
            yield batch()


@dataclass
class Written(ds.WriterCommitMessage):
    files: int


class CaptureWriter(ds.DataSourceArrowWriter):
    """Rows of ``folder_date`` and ``content``, and of ``name`` if there is one."""

    def __init__(self, options: dict):
        self.root, self.name = options["path"], options.get("name", "orders.csv")

    def put(self, system: fs.FileSystem, place: str, content: bytes) -> None:
        """Appears whole or not at all; equal bytes are left as they are, others are an error."""
        if system.get_file_info(place).type == fs.FileType.File:
            with system.open_input_file(place) as stream:
                if stream.read() != content:
                    raise FileExistsError(f"{place} already has different contents; it was not overwritten.")
            return
        task = f"{place}.{hashlib.sha256(content).hexdigest()[:16]}.part"
        with system.open_output_stream(task) as stream:
            stream.write(content)
        system.move(task, place)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, base = file_system(self.root)
        n = 0
        for rows in batches:
            names = rows.column("name").to_pylist() if "name" in rows.schema.names else [self.name] * rows.num_rows
            for day, name, content in zip(rows.column("folder_date").to_pylist(), names, rows.column("content").to_pylist(), strict=True):
                if not DAY.fullmatch(day or ""):
                    raise ValueError(f"{day!r} is no folder date.")
                system.create_dir(f"{base}/{day}", recursive=True)
                self.put(system, f"{base}/{day}/{name}", content)
                sidecar = f"{hashlib.sha256(content).hexdigest()}  {name}\n"
                self.put(system, f"{base}/{day}/{name}.sha256", sidecar.encode())
                n += 1
        return Written(n)

    def commit(self, messages: list) -> None:
        pass

    def abort(self, messages: list) -> None:
        pass  # files stay: each is whole, and a rerun finds it


class CaptureFiles(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CaptureReader:
        return CaptureReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> CaptureWriter:
        if overwrite:
            raise ValueError("Captures are never overwritten; append to them.")
        return CaptureWriter(dict(self.options))


def read_capture_files(spark: SparkSession, root: str, name: str = "orders.csv", most_bytes: int | None = None) -> DataFrame:
    """``path, folder_date, length, content``; content is null above ``most_bytes``."""
    spark.dataSource.register(CaptureFiles)
    source = spark.read.format(FORMAT).option("name", name)
    if most_bytes is not None:
        source = source.option("maxBytes", most_bytes)
    return source.load(root)


def write_capture_files(files: DataFrame, root: str, name: str = "orders.csv") -> None:
    """Write ``files(folder_date, content)``, and ``name`` if they have it, each with its sidecar."""
    files.sparkSession.dataSource.register(CaptureFiles)
    kept = files.select("folder_date", "content", *(["name"] if "name" in files.columns else []))
    kept.write.format(FORMAT).option("name", name).mode("append").save(root)
