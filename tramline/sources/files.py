"""Parts of files, read in tasks: listings, byte ranges, members of archives."""

from __future__ import annotations

import struct
import zipfile
from collections.abc import Iterable, Iterator
from typing import IO
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that are read at once.
CHUNK = 1 << 20


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files at a path or pattern; none is opened."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    scheme, _, rest = path.rpartition(":")
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), f"/{rest.lstrip('/')}" if scheme else path
    return fs.FileSystem.from_uri(quote(path, safe=":/@?=&"))


def opened(path: str) -> pa.NativeFile | Packed:
    """A file for reading at any place, on the local file system or one that
    pyarrow knows by the address; of a ``.zst`` file what is packed in it."""
    system, inner = located(path)
    file = system.open_input_file(inner)
    return Packed(file) if path.endswith(".zst") else file


def created(path: str) -> pa.NativeFile:
    """A new file for writing, and the folders that it is in."""
    system, inner = located(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner)


def moved(path: str, target: str) -> None:
    """A finished file put in the place of another."""
    system, inner = located(path)
    system.move(inner, located(target)[1])


def exists(path: str) -> bool:
    system, inner = located(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound


def dropped(path: str) -> None:
    system, inner = located(path)
    system.delete_file(inner)


def removed(folder: str) -> None:
    system, inner = located(folder)
    system.delete_dir(inner)


def chunks(file: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    """The bytes from ``start`` up to ``end``, a chunk at a time."""
    file.seek(start)
    while start < end and (data := file.read(min(CHUNK, end - start))):
        start += len(data)
        yield data


#: The seek table of Zstandard's seekable format, a frame that readers skip.
SKIPPED, TABLE = 0x184D2A5E, 0x8F92EAB1


def packed(data: bytes) -> tuple[bytes, bytes]:
    """Some bytes as a frame of a ``.zst`` file, and the frame's entry in its seek table."""
    frame = pa.compress(data, codec="zstd", asbytes=True)
    return frame, struct.pack("<II", len(frame), len(data))


def seek_table(entries: Iterable[bytes]) -> bytes:
    """The end of a ``.zst`` file: where its frames are, so that they are read at any place."""
    rows = b"".join(entries)
    return struct.pack("<II", SKIPPED, len(rows) + 9) + rows + struct.pack("<IBI", len(rows) // 8, 0, TABLE)


class Packed:
    """What is in a ``.zst`` file, a frame at a time; without a seek table it can only be
    read on from its beginning."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.at, self.held, self.stream = file, 0, (-1, b""), None
        size = file.size()
        n, sums, mark = struct.unpack("<IBI", file.read_at(9, size - 9)) if size >= 17 else (0, 0, 0)
        self.known = mark == TABLE and sums == 0 and size >= 17 + 8 * n
        if self.known:
            sizes = np.frombuffer(file.read_at(8 * n, size - 9 - 8 * n), "<u4").reshape(n, 2).astype(np.int64)
            self.places, self.starts = (np.concatenate([[0], np.cumsum(sizes[:, k])]) for k in (0, 1))
            self.known = int(self.places[-1]) + 17 + 8 * n == size

    def size(self) -> int:
        return int(self.starts[-1]) if self.known else -1

    def seek(self, place: int) -> None:
        if not self.known and place != self.at:
            raise ValueError("no seek table")
        self.at = place

    def read(self, n: int) -> bytes:
        """Up to ``n`` bytes, none at the end."""
        if not self.known:
            if self.stream is None:
                self.file.seek(0)
                self.stream = pa.CompressedInputStream(self.file, "zstd")
            data = self.stream.read(n)
        elif self.at >= self.starts[-1]:
            data = b""
        else:
            k = int(np.searchsorted(self.starts, self.at, "right")) - 1
            if self.held[0] != k:
                frame = self.file.read_at(int(self.places[k + 1] - self.places[k]), int(self.places[k]))
                self.held = k, pa.decompress(frame, int(self.starts[k + 1] - self.starts[k]), codec="zstd", asbytes=True)
            begin = self.at - int(self.starts[k])
            data = self.held[1][begin : begin + n]
        self.at += len(data)
        return data

    def __enter__(self) -> Packed:
        return self

    def __exit__(self, *error: object) -> None:
        self.file.close()


def unpacked(listing: DataFrame) -> DataFrame:
    """(path, length) with the length of what is packed, 0 if a file does not say it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with opened(path) as file:
                    yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([max(0, file.size())], pa.int64())], ["path", "length"])

    there = F.col("path").endswith(".zst")
    return listing.where(~there).select("path", "length").union(listing.where(there).select("path").mapInArrow(run, "path string, length long"))


def streamed(file: IO[bytes]) -> Iterator[bytes]:
    """All bytes of a file that can only be read on."""
    while data := file.read(CHUNK):
        yield data


def members(files: DataFrame) -> DataFrame:
    """(path, member, size) of the archives among ``files`` (path): their
    directories are read, at their ends, and nothing else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with opened(path) as file, zipfile.ZipFile(file) as z:
                    found = [i for i in z.infolist() if not i.is_dir()]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(found), pa.string()), pa.array([i.filename for i in found], pa.string()), pa.array([i.file_size for i in found], pa.int64())], ["path", "member", "size"])

    return files.select("path").mapInArrow(run, "path string, member string, size long")
