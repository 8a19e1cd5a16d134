"""A Spark data source for line-delimited transcripts with true byte offsets and no shuffle.

A file is cut into byte ranges. A range owns the lines that begin in it, reads on to the end of
its last line, and knows the offset of each line without looking at any other range. Lines leave
as Arrow batches made from the file's own bytes. As a stream the source remembers how far each
file was read and goes on behind the last complete line; a file that shrank starts again.
"""

from __future__ import annotations

import fnmatch
import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "agent_transcripts"
SPLIT, BLOCK, STEP = 64 << 20, 4 << 20, 64 << 10
TASKS = 64  # a read of small ranges has about this many tasks, until they hold SPLIT bytes
SCHEMA = "path string, file_size long, modified timestamp, split int, line_in_split long, byte_start long, byte_end long, complete boolean, raw binary"
FIELDS = [("path", pa.string()), ("file_size", pa.int64()), ("modified", pa.timestamp("us", "UTC")), ("split", pa.int32()), ("line_in_split", pa.int64()), ("byte_start", pa.int64()), ("byte_end", pa.int64()), ("complete", pa.bool_()), ("raw", pa.large_binary())]
#: Schemes that can be read outside the JVM; other stores go through Spark's own text scan.
SCHEMES = ("", "file", "s3", "gs", "hdfs")


def reachable(root: str) -> bool:
    return urlsplit(root).scheme in SCHEMES


def _store(root: str) -> tuple:
    """The file system of ``root``, its folder there, and what precedes paths in names."""
    from pyarrow import fs as pafs  # only where files are read: it starts threads of its own

    if urlsplit(root).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlsplit(root).path, "file://"
    store, folder = pafs.FileSystem.from_uri(root)
    return store, folder, root[: root.index(folder)] if folder in root else ""


@dataclass
class File:
    path: str
    name: str
    size: int
    modified: int


def list_files(root: str, pattern: str = "*.jsonl", depth: int | None = None) -> list[File]:
    """The files below ``root`` whose name fits, ``depth`` folders down (None: any); none for a
    folder that is not there. Names that begin with a dot or a low line are not data."""
    from pyarrow import fs as pafs

    store, folder, prefix = _store(root.rstrip("/") or "/")
    out = []
    for f in store.get_file_info(pafs.FileSelector(folder, allow_not_found=True, recursive=True)):
        below = f.path[len(folder) :].strip("/").split("/")
        if f.type == pafs.FileType.File and fnmatch.fnmatchcase(below[-1], pattern) and (depth is None or len(below) == depth + 1) and not any(b.startswith((".", "_")) for b in below):
            out.append(File(f.path, prefix + f.path, f.size, f.mtime_ns // 1000))
    return sorted(out, key=lambda f: f.path)


@dataclass
class Range(InputPartition):
    """The lines of a file that begin in [start, end)."""

    path: str
    name: str
    size: int
    modified: int
    split: int
    start: int
    end: int
    aligned: bool = False  # start is known to begin a line


def ranges(files: list[File], split: int, begin: dict[str, int] | None = None) -> list[Range]:
    out = []
    for f in files:
        first = (begin or {}).get(f.name, 0)
        cuts = [*range(first, f.size, split), f.size] if f.size > first else []
        out += [Range(f.path, f.name, f.size, f.modified, i, a, b, i == 0) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return out


@dataclass
class Ranges(InputPartition):
    """Ranges that one task reads one after another."""

    ranges: list[Range]


def grouped(all_ranges: list[Range]) -> list[Ranges]:
    """Small files and short ranges share tasks, so their number does not grow with the bytes."""
    most = min(SPLIT, sum(r.end - r.start for r in all_ranges) // TASKS)
    out, held = [], most
    for r in all_ranges:
        if held >= most:
            out.append(Ranges([]))
            held = 0
        out[-1].ranges.append(r)
        held += r.end - r.start
    return out


def read_range(r: Range, root: str, block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Batches of the range's lines. At most one block and one line are in memory."""
    store, _, _ = _store(root)
    with store.open_input_file(r.path) as f:
        at = r.start if r.aligned else r.start - 1  # the byte before tells whether a line begins here
        f.seek(at)
        skip, rest, lines = not r.aligned, [], 0
        while True:
            read = at + sum(map(len, rest))
            # no further than the range, then in growing steps to the end of its last line
            chunk = f.read(min(block, max(r.end - read, STEP << min(len(rest), 6)), max(0, r.size - read)))
            if skip:
                cut = chunk.find(b"\n")
                if chunk and cut < 0:
                    at += len(chunk)
                    if at >= r.end:
                        return
                    continue
                if not chunk or at + cut + 1 >= r.end:
                    return
                chunk, at, skip = chunk[cut + 1 :], at + cut + 1, False
                if not chunk:
                    continue
            last = chunk.rfind(b"\n")
            if chunk and last < 0:
                rest.append(chunk)
                continue
            tail = chunk[last + 1 :] if chunk else b""
            data = b"".join([*rest, chunk[: last + 1]])
            if not chunk and not data:
                return
            ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
            if not chunk:  # the file's last line has no break
                ends = np.append(ends, len(data) + 1)
            begins = np.concatenate([[0], ends[:-1]])
            mine = int(np.searchsorted(begins + at, r.end))
            if mine:
                yield _lines(r, at, lines, data, begins[:mine], ends[:mine])
            if mine < len(ends) or not chunk:
                return
            lines, at, rest = lines + mine, at + len(data), [tail] if tail else []


def _lines(r: Range, at: int, lines: int, data: bytes, begins: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    n = len(ends)
    body = data[: min(int(ends[-1]), len(data))].replace(b"\n", b"")
    offsets = np.concatenate([[0], ends - np.arange(1, n + 1)]).astype(np.int64)
    raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body)])
    every = lambda v, t: pa.repeat(pa.scalar(v, t), n)
    columns = [every(r.name, pa.string()), every(r.size, pa.int64()), every(r.modified, pa.timestamp("us", "UTC")), every(r.split, pa.int32()), pa.array(np.arange(lines + 1, lines + n + 1)), pa.array(begins + at), pa.array(ends + at), pa.array(ends + at <= r.size), raw]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in FIELDS])


class Transcripts(DataSource):
    """Options: ``path``, ``pattern``, ``depth``, ``split_bytes``, ``files`` (all; whole: those of
    one range; cut: those of several) and, for streams, ``max_bytes`` of new text in a trigger."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)

    def streamReader(self, schema):
        return _Stream(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.root, self.pattern = options["path"], options.get("pattern", "*.jsonl")
        self.depth = int(options["depth"]) if "depth" in options else None
        self.split, self.files = int(options.get("split_bytes", SPLIT)), options.get("files", "all")

    def partitions(self):
        files = list_files(self.root, self.pattern, self.depth)
        if self.files != "all":
            files = [f for f in files if (f.size > self.split) == (self.files == "cut")]
        return grouped(ranges(files, self.split)) or [Ranges([])]

    def read(self, partition):
        for r in partition.ranges:
            yield from read_range(r, self.root)


class _Stream(DataSourceStreamReader):
    """The offset maps each file to the end of what was taken of it, a line's end where it goes on."""

    def __init__(self, options):
        self.batch = _Reader(options)
        self.most = int(options.get("max_bytes", 1 << 62))
        self.offset: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def _line_end(self, f: File, begin: int) -> int:
        """The end of the last complete line of at most ``max_bytes`` new text, else of the first."""
        store, _, _ = _store(self.batch.root)
        with store.open_input_file(f.path) as h:
            end = min(f.size, begin + self.most)
            while end > begin:  # backwards to a line's end
                at = max(begin, end - (64 << 10))
                h.seek(at)
                cut = h.read(end - at).rfind(b"\n")
                if cut >= 0:
                    return at + cut + 1
                end = at
            at = begin + self.most  # one line longer than a trigger: forwards to its end
            while at < f.size:
                h.seek(at)
                chunk = h.read(BLOCK)
                cut = chunk.find(b"\n")
                if cut >= 0:
                    return at + cut + 1
                at += len(chunk)
        return begin

    def latestOffset(self) -> dict:
        out, left = {}, self.most
        for f in list_files(self.batch.root, self.batch.pattern, self.batch.depth):
            seen = self.offset.get(f.name, 0)
            seen = seen if seen <= f.size else 0
            out[f.name] = end = self._line_end(f, seen) if f.size > seen and left > 0 else seen
            left -= end - seen
        self.offset = out
        return out

    def partitions(self, start: dict, end: dict):
        files = {f.name: f for f in list_files(self.batch.root, self.batch.pattern, self.batch.depth)}
        out = []
        for name, stop in end.items():
            begin = start.get(name, 0)
            begin = begin if begin <= stop else 0  # a file that shrank starts again
            if name in files and stop > begin:
                f = files[name]
                out += ranges([File(f.path, f.name, stop, f.modified)], self.batch.split, {name: begin})
        return grouped(out)

    def read(self, partition):
        return self.batch.read(partition)

    def commit(self, end: dict) -> None:
        self.offset = json.loads(json.dumps(end))
