"""File listings as a data source: ``spark.read.format("wharfline_files")``.

Planning lists the topmost folders until there are enough of them for the tasks;
each task then walks its folders down and yields entries as they come. Filters on
``path`` (prefix, suffix) and ``size`` reach the listing: folders that no path with
the prefix can lie in are never listed.

Options: ``root`` (a shared folder or a URI), ``hidden`` (``true`` takes names with
a dot in front in), ``tasks`` (ranges to plan for) and ``plan_folders`` (folders that
planning lists at most).
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSelector, FileType
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    StringEndsWith,
    StringStartsWith,
)

import wharfline
from wharfline.sources.files import posix_path, remote_filesystem

cloudpickle.register_pickle_by_value(wharfline)

SCHEMA = "uri string, path string, size bigint, mtime timestamp, error string"
PLAN_FOLDERS = 2_000
_EMIT_ROWS = 10_000


@dataclass
class Entry:
    """What a listing says of one name; ``uri`` and ``error`` for what can't be read."""

    name: str
    uri: str
    is_dir: bool
    size: int | None = None
    mtime_us: int | None = None
    error: str | None = None


def root_name(root: str) -> str:
    """The root as it stands in front of listed names: absolute where it is a plain one."""
    plain = posix_path(root)
    return root.rstrip("/") if plain is None else os.path.abspath(plain)


def lister(root: str) -> Callable[[str], Iterator[Entry]]:
    """The listing of one folder, on the filesystem that ``root`` names."""
    return _list_posix if posix_path(root) is not None else _list_remote(root)


def _list_posix(folder: str) -> Iterator[Entry]:
    with os.scandir(folder) as entries:
        for e in entries:
            yield _posix_entry(e)


def _posix_entry(e: os.DirEntry) -> Entry:
    try:
        e.path.encode("utf-8")
    except UnicodeEncodeError:
        shown = os.fsencode(e.path).decode("utf-8", "replace")
        return Entry(os.path.basename(shown), shown, False, error="UnicodeEncodeError: name is not UTF-8")
    try:
        if e.is_dir(follow_symlinks=False):
            return Entry(e.name, e.path, True)
        if e.is_dir():
            # Linked folders are not followed and are no files.
            return Entry(e.name, e.path, False, error="linked folder")
        st = e.stat()
        return Entry(e.name, e.path, False, st.st_size, st.st_mtime_ns // 1000)
    except OSError as err:
        return Entry(e.name, e.path, False, error=f"{type(err).__name__}: {err}")


def _list_remote(root: str) -> Callable[[str], Iterator[Entry]]:
    filesystem, _, prefix = remote_filesystem(root)

    def listing(folder: str) -> Iterator[Entry]:
        for info in filesystem.get_file_info(FileSelector(folder[len(prefix):])):
            is_dir = info.type == FileType.Directory
            stamp = None if is_dir or info.mtime_ns is None else info.mtime_ns // 1000
            yield Entry(info.base_name, prefix + info.path, is_dir, None if is_dir else info.size, stamp)

    return listing


@dataclass
class Wanted:
    """The pushed conditions. Rows without a size, such as errors, meet no condition on it."""

    prefixes: tuple[str, ...] = ()
    suffixes: tuple[str, ...] = ()
    least: int | None = None
    most: int | None = None

    def take(self, f: Filter) -> bool:
        """Whether the filter is one of these; it is then kept."""
        if f.attribute == ("path",) and isinstance(f, StringStartsWith):
            self.prefixes += (f.value,)
        elif f.attribute == ("path",) and isinstance(f, StringEndsWith):
            self.suffixes += (f.value,)
        elif f.attribute == ("size",) and isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, EqualTo)):
            low = f.value + (1 if isinstance(f, GreaterThan) else 0)
            high = f.value - (1 if isinstance(f, LessThan) else 0)
            if not isinstance(f, (LessThan, LessThanOrEqual)):
                self.least = low if self.least is None else max(self.least, low)
            if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.most = high if self.most is None else min(self.most, high)
        else:
            return False
        return True

    def folder(self, path: str) -> bool:
        """Whether anything below a folder can be wanted."""
        inside = path + "/" if path else ""
        return all(inside.startswith(p) or p.startswith(inside) for p in self.prefixes)

    def file(self, path: str, size: int | None) -> bool:
        if self.least is not None and (size is None or size < self.least):
            return False
        if self.most is not None and (size is None or size > self.most):
            return False
        return path.startswith(self.prefixes or "") and all(path.startswith(p) for p in self.prefixes) and all(
            path.endswith(s) for s in self.suffixes)


@dataclass
class Range(InputPartition):
    """Folders of one task: to be walked down, or (not ``deep``) listed without what lies below."""

    folders: list[str]
    deep: bool

    def __post_init__(self):
        super().__init__(None)


class FolderReader(DataSourceReader):
    def __init__(self, options: dict):
        if "root" not in options:
            raise ValueError("the option root is missing")
        self.top = root_name(options["root"])
        self.hidden = options.get("hidden", "false").lower() == "true"
        self.tasks = int(options.get("tasks", "64"))
        self.plan_folders = int(options.get("plan_folders", str(PLAN_FOLDERS)))
        self.wanted = Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        return iter([f for f in filters if not self.wanted.take(f)])

    def _path(self, uri: str) -> str:
        return uri[len(self.top):].lstrip("/")

    def _entries(self, listing, folder: str) -> Iterator[Entry]:
        """Entries of a folder that may be wanted; a folder that can't be listed is an entry with an error."""
        try:
            for e in listing(folder):
                if not self.hidden and e.name.startswith("."):
                    continue
                path = self._path(e.uri)
                if self.wanted.folder(path) if e.is_dir else self.wanted.file(path, e.size):
                    yield e
        except OSError as err:
            path = self._path(folder)
            if self.wanted.file(path, None):
                yield Entry("", folder, False, error=f"{type(err).__name__}: {err}")

    def partitions(self) -> list[Range]:
        listing, waiting, shallow = lister(self.top), deque([self.top]), []
        while waiting and len(waiting) < self.tasks and len(shallow) < self.plan_folders:
            folder = waiting.popleft()
            below = [e.uri for e in self._entries(listing, folder) if e.is_dir]
            shallow.append(folder)
            waiting.extend(below)
        # dealt out in turn, so that neighbours go to different tasks
        ranges = [Range(list(waiting)[i::self.tasks], True) for i in range(min(self.tasks, len(waiting)))]
        return ranges + [Range(shallow[i::self.tasks], False) for i in range(min(self.tasks, len(shallow)))]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        listing, waiting, rows = lister(self.top), list(partition.folders), []
        while waiting:
            for e in self._entries(listing, waiting.pop()):
                if e.is_dir:
                    if partition.deep:
                        waiting.append(e.uri)
                    continue
                rows.append((e.uri, self._path(e.uri), e.size, e.mtime_us, e.error))
                if len(rows) >= _EMIT_ROWS:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    uri, path, size, mtime, error = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict({
        "uri": pa.array(uri, pa.string()), "path": pa.array(path, pa.string()), "size": pa.array(size, pa.int64()),
        "mtime": pa.array(mtime, pa.timestamp("us", "UTC")), "error": pa.array(error, pa.string())})


class FileListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wharfline_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FolderReader:
        return FolderReader(dict(self.options))


def list_files(spark: SparkSession, root: str, hidden: bool = False, tasks: int | None = None) -> DataFrame:
    """uri, path, size, mtime, error of all files below ``root``, read when the DataFrame is.

    Filter it by ``path`` and ``size`` before anything else, so that the listing
    leaves out what the filters do.
    """
    spark.dataSource.register(FileListing)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    n = tasks or 2 * spark.sparkContext.defaultParallelism
    reader = spark.read.format(FileListing.name()).option("root", root).option("hidden", str(hidden)).option("tasks", n)
    return reader.load()
