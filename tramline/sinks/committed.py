"""Files and HTTP resources put together from parts that tasks have written.

Rows are (target, part): tasks append each target's parts, in the order of the rows,
to a file of their own in a staging folder; when all tasks are done the commit joins
the files of each target, in the order of the partitions, a block at a time, and puts
the result in its place or sends it by HTTP PUT. Nothing is seen of a job that fails.
A file whose name ends in ``.zst`` is packed where its parts are written, a frame for
each part, and can be read at any place (``files.Packed``).
A batch that was delivered leaves a mark, so that the same batch, run again, is not
delivered twice.
"""

from __future__ import annotations

import json
import urllib.request
import uuid
from base64 import b64decode, b64encode
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..session import shared_dir
from ..sources import files


@dataclass
class Parts(WriterCommitMessage):
    """What a task has written: for each target its file, its bytes and, if it is
    packed, the frames' entries for the seek table."""

    place: int
    written: dict[str, tuple[str, int, bytes]]


def is_packed(target: str) -> bool:
    return target.endswith(".zst") and not target.startswith(("http://", "https://"))


def envelope(before: bytes = b"", between: bytes = b"", after: bytes = b"", optional: bool = False) -> dict:
    """What stands around the parts of a target, and whether it may fail."""
    return {"around": [b64encode(x).decode() for x in (before, between, after)], "optional": optional}


class Assembler:
    """Writes parts in tasks, and joins and delivers them in the commit."""

    def __init__(self, options: dict[str, str]):
        self.staging = options["staging"].rstrip("/")
        self.targets = json.loads(options["targets"])
        self.every = options.get("targets.any", "false") == "true"
        self.timeout = float(options.get("timeout", "30"))
        self.batch = options.get("batch") or None

    def around(self, target: str) -> tuple[list[bytes], bool]:
        given = self.targets.get(target) or envelope()
        return [b64decode(x) for x in given["around"]], given["optional"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        place = TaskContext.get().partitionId()
        out: dict[str, pa.NativeFile] = {}
        written: dict[str, tuple[str, int, bytearray]] = {}
        try:
            for batch in iterator:
                for target, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if target not in self.targets and not self.every:
                        continue
                    between = self.around(target)[0][1] if target in written else b""
                    if target not in out:
                        path = f"{self.staging}/{uuid.uuid4().hex}"
                        out[target], written[target] = files.created(path), (path, 0, bytearray())
                    data = between + (part or b"")
                    if is_packed(target) and data:
                        data, entry = files.packed(data)
                        written[target][2].extend(entry)
                    out[target].write(data)
                    written[target] = written[target][0], written[target][1] + len(data), written[target][2]
        finally:
            for file in out.values():
                file.close()
        return Parts(place, {t: (path, n, bytes(entries)) for t, (path, n, entries) in written.items()})

    def joined(self, parts: list[tuple[str, int, bytes]], around: list[bytes], pack: bool = False, once: bool = False) -> Iterator[bytes]:
        """A target's bytes; parts that are needed ``once`` are removed when they were read."""
        table: list[bytes] = []

        def own(data: bytes) -> bytes:
            if pack and data:
                data, entry = files.packed(data)
                table.append(entry)
            return data

        yield own(around[0])
        for k, (path, _, entries) in enumerate(parts):
            if k:
                yield own(around[1])
            table.append(entries)
            with files.opened(path) as file:
                yield from files.streamed(file)
            if once:
                files.dropped(path)
        yield own(around[2])
        if pack:
            yield files.seek_table(table)

    def deliver(self, target: str, parts: list[tuple[str, int, bytes]]) -> None:
        around, optional = self.around(target)
        size = sum(n for _, n, _ in parts) + len(around[0]) + len(around[1]) * max(0, len(parts) - 1) + len(around[2])
        if not target.startswith(("http://", "https://")):
            near = f"{target}.{uuid.uuid4().hex}"
            with files.created(near) as out:
                for data in self.joined(parts, around, is_packed(target), once=True):
                    out.write(data)
            files.moved(near, target)
            return
        request = urllib.request.Request(target, data=self.joined(parts, around), method="PUT", headers={"Content-Length": str(size)})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                if not 200 <= answer.status < 300:
                    raise OSError(f"PUT {target}: {answer.status}")
        except OSError:
            if not optional:
                raise

    def finish(self, messages: list[Parts | None], batch: str | None) -> None:
        """Delivers the targets in the order that they were given in, then those
        that only rows name."""
        found = [m for m in sorted((m for m in messages if m), key=lambda m: m.place) if m.written]
        targets = [*self.targets, *sorted({t for m in found for t in m.written} - set(self.targets))]
        for k, target in enumerate(targets):
            mark = f"{self.staging}/delivered-{batch}-{k}" if batch else None
            if mark and files.exists(mark):
                continue
            self.deliver(target, [m.written[target] for m in found if target in m.written])
            if mark:
                files.created(mark).close()


class Once(Assembler, DataSourceArrowWriter):
    def commit(self, messages: list[Parts | None]) -> None:
        self.finish(messages, self.batch)

    def abort(self, messages: list[Parts | None]) -> None:
        pass


class Each(Assembler, DataSourceStreamArrowWriter):
    def commit(self, messages: list[Parts | None], batchId: int) -> None:
        self.finish(messages, str(batchId))

    def abort(self, messages: list[Parts | None], batchId: int) -> None:
        pass


class Assembled(DataSource):
    """``df.write.format("assembled")`` of (target string, part binary) rows, with
    the options ``staging`` (a shared folder), ``targets`` (JSON of ``envelope`` by
    target), ``targets.any`` (also deliver targets that only rows name), ``batch``."""

    @classmethod
    def name(cls) -> str:
        return "assembled"

    def writer(self, schema: StructType, overwrite: bool) -> Once:
        return Once(self.options)

    def streamWriter(self, schema: StructType, overwrite: bool) -> Each:
        return Each(self.options)


def assemble(rows: DataFrame, targets: dict[str, dict], every: bool = False, staging: str | None = None, batch: str | None = None) -> None:
    """Delivers the parts of ``rows`` (target, part). With ``staging`` and ``batch``
    a batch is delivered once, however often it is run."""
    spark = rows.sparkSession
    spark.dataSource.register(Assembled)
    options = {"staging": staging or shared_dir(spark), "targets": json.dumps(targets), "targets.any": str(every).lower(), "batch": batch or ""}
    rows.select("target", "part").write.format("assembled").mode("append").options(**options).save()
    if staging is None:
        files.located(options["staging"])[0].create_dir(files.located(options["staging"])[1], recursive=True)
        files.removed(options["staging"])
