"""Large feeds, cut into their entities by many tasks.

Nothing in a feed marks where an entity begins, so the task of a range guesses the
first one in it and reads on from there, up to the first entity behind its range. The
guesses hold if each range's first entity is where the range before it ended: then the
cuts are those of reading the feed from its beginning. Feeds of which a guess fails are
read on by one task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import files

#: Bytes of a range, and bytes at its start in which the first entity is looked for.
RANGE, LOOK = 32 << 20, 4 << 20
#: Most bytes of a JSON feed that are read as one text.
AT_ONCE = 1 << 30
#: Entities that have to follow each other for a guess in a protobuf feed.
ROW = 8
#: Fields that an entity has, besides its id.
KNOWN = {"trip_update", "vehicle", "alert", "is_deleted"}


# --- protobuf ------------------------------------------------------------------------


def protobuf_entities(parts: Iterable[bytes], base: int = 0) -> Iterator[tuple[int, bytes]]:
    """The place and the bytes of each entity of a feed, not decoded, as the feed is read."""
    data, at = b"", 0
    parts = iter(parts)

    def more() -> bool:
        nonlocal data, at, base
        part = next(parts, b"")
        data, at, base = data[at:] + part, 0, base + at
        return bool(part)

    def number() -> int:
        nonlocal at
        n = shift = 0
        while True:
            if at >= len(data) and not more():
                raise ValueError("a feed that ends in a number")
            b, at = data[at], at + 1
            n, shift = n | (b & 127) << shift, shift + 7
            if b < 128:
                return n

    while at < len(data) or more():
        place = base + at
        key = number()
        size = {5: 4, 1: 8}.get(key & 7, 0) if key & 7 != 2 else number()
        if key & 7 == 0:
            number()
        while len(data) - at < size:
            if not more():
                raise ValueError("a feed that ends in a field")
        if key == 2 << 3 | 2:
            yield place, data[at : at + size]
        at += size


def protobuf_guess(data: bytes) -> int | None:
    """Where in some bytes of a feed the first entity is likely to begin."""

    def behind(at: int) -> int | None:
        """The place behind an entity, if there may be one."""
        n, shift, at = 0, 0, at + 1
        while at < len(data) and shift < 42:
            n, shift, at = n | (data[at] & 127) << shift, shift + 7, at + 1
            if data[at - 1] < 128:
                return at + n if data[at : at + 1] == b"\x0a" and n > 1 else None
        return None

    at = data.find(b"\x12")
    while at >= 0:
        end, k = at, 0
        while end is not None and end < len(data) and data[end] == 0x12 and k < ROW:
            end, k = behind(end), k + 1
        if end is not None and (k == ROW or end >= len(data)):
            return at
        at = data.find(b"\x12", at + 1)
    return None


# --- JSON ----------------------------------------------------------------------------


class Json:
    """A JSON text as it is read. Bytes are taken as characters, so that places are
    those in the file; what is told apart here is ASCII."""

    def __init__(self, parts: Iterable[bytes], base: int = 0):
        self.parts, self.base, self.text, self.at = iter(parts), base, "", 0
        self.decoder = json.JSONDecoder()
        while base == 0 and len(self.text) < 3 and self.more():
            pass
        if base == 0 and self.text.startswith("\xef\xbb\xbf"):  # a byte order mark
            self.at = 3

    @property
    def place(self) -> int:
        return self.base + self.at

    def more(self) -> bool:
        part = next(self.parts, None)
        self.text, self.base, self.at = self.text[self.at :] + (part or b"").decode("latin-1"), self.base + self.at, 0
        return part is not None

    def seen(self, wanted: str) -> str:
        """The next character that is no blank, taken if it is wanted."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in " \t\r\n":
                self.at += 1
            if self.at < len(self.text):
                break
            if not self.more():
                raise ValueError("a feed that ends early")
        if self.text[self.at] in wanted:
            self.at += 1
            return self.text[self.at - 1]
        return ""

    def value(self) -> bytes:
        self.seen("")
        while True:
            try:
                end = self.decoder.raw_decode(self.text, self.at)[1]
                if end < len(self.text) or not self.more():
                    found, self.at = self.text[self.at : end], end
                    return found.encode("latin-1")
                # more of the text may belong to it, as of a number
            except ValueError:
                if not self.more():
                    raise

    def items(self) -> Iterator[tuple[int, bytes]]:
        """The rest of an array of entities."""
        while not self.seen("]"):
            place = self.place
            yield place, self.value()
            self.seen(",")

    def fields(self) -> Iterator[tuple[int, bytes]]:
        """The entities in the rest of the feed's object."""
        while not self.seen("}"):
            self.seen(",")
            key = json.loads(self.value())
            self.seen(":")
            if key != "entity" or not self.seen("["):
                self.value()
                continue
            yield from self.items()


def json_entities(parts: Iterable[bytes], base: int = 0) -> Iterator[tuple[int, bytes]]:
    """The place and the text of each entity of a feed, as the feed is read; behind
    its beginning, from an entity on."""
    feed = Json(parts, base)
    if base == 0 and not feed.seen("{"):
        raise ValueError("a feed is an object")
    if base:
        yield from feed.items()
    yield from feed.fields()


def json_guess(data: bytes, least: int) -> int | None:
    """Where in some bytes of a feed, from a place on, the first entity is likely to begin."""
    text, decoder = data.decode("latin-1"), json.JSONDecoder()
    for m in re.finditer(r"[,\[][ \t\r\n]*(?=\{)", text):
        if m.end() < least:
            continue
        try:
            found = decoder.raw_decode(text, m.end())[0]
        except ValueError:
            continue
        if "id" in found and not KNOWN.isdisjoint(found):
            return m.end()
    return None


def own_feed(file: pa.NativeFile, begin: int, behind: int, length: int) -> bytes:
    """The entities between two places, where the first of them and one behind them begin,
    as a feed of their own."""
    if behind - begin > AT_ONCE:
        raise ValueError("too much for one text")
    text = b"".join(files.chunks(file, begin, behind)).rstrip()
    if behind < length:
        if not text.endswith(b","):
            raise ValueError("not between entities")
        text = text[:-1] + b"]}"
    return b'{"entity":[' + text if begin else text


def json_walked(file: pa.NativeFile, begin: int, end: int, length: int) -> tuple[int, int] | None:
    """(behind, count) of a range behind the first, by reading all up to where an entity is
    guessed behind its end; as this is a list of entities, the guess is right. None if not."""
    from . import gtfsrt_columns as columns  # it needs this module

    behind = length
    if end < length:
        at = json_guess(b"".join(files.chunks(file, end - 256, min(length, end + LOOK))), 256)
        if at is None:
            return None
        behind = end - 256 + at
    try:
        return behind, len(columns.feed_rows(own_feed(file, begin, behind, length), StructType().add("id", "string")))
    except (ValueError, pa.ArrowException):
        return None


# --- ranges --------------------------------------------------------------------------


def entities(file: pa.NativeFile, protobuf: bool, begin: int, length: int) -> Iterator[tuple[int, bytes]]:
    return (protobuf_entities if protobuf else json_entities)(files.chunks(file, begin, length), begin)


def walked(name: str, protobuf: bool, start: int, end: int, length: int) -> tuple[int, int, int]:
    """(begin, behind, count): the first entity of a range, the first behind it, and how
    many there are; begin is -1 if none was guessed, or what follows is no feed."""
    with files.opened(name) as file:
        begin = start
        if start:
            before = min(start, 256)
            data = b"".join(files.chunks(file, start - before, min(length, start + LOOK)))
            at = (protobuf_guess(data[before:]) if protobuf else json_guess(data, before)) if data else None
            begin = -1 if at is None else start + at - (0 if protobuf else before)
        if start and not start <= begin < end:
            return -1, -1, 0
        if start and not protobuf and (found := json_walked(file, begin, end, length)):
            return begin, *found
        count = 0
        try:
            for place, _ in entities(file, protobuf, begin, length):
                if place >= end:
                    return begin, place, count
                count += 1
        except ValueError:
            return -1, -1, 0
        return begin, length, count


def ranges(listing: DataFrame, protobuf_names: str, size: int) -> DataFrame:
    """(path, length, protobuf, start, end) of the files of more than ``size`` bytes."""
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))).alias("start")
    each = listing.where(F.col("length") > size).select("path", "length", F.expr(protobuf_names).alias("protobuf"), start)
    return each.withColumn("end", F.least(F.col("start") + size, "length"))


def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            begin, behind, count = walked(r["path"], r["protobuf"], r["start"], r["end"], r["length"])
            yield pa.RecordBatch.from_pylist([r | {"begin": begin, "behind": behind, "count": count}])


def chained(rows: pa.Table) -> pa.Table:
    """The ranges of a file, each with the number of entities before it, if each begins
    where the last one ended; else one range of the whole file, of -1 entities."""
    out, expected, place = [], 0, 0
    ordered = sorted(rows.to_pylist(), key=lambda r: r["start"])
    for r in ordered:
        if r["start"] and expected >= r["end"]:
            continue  # within an entity, or behind the last
        if r["begin"] != expected:
            out = [{"path": r["path"], "protobuf": r["protobuf"], "begin": 0, "length": r["length"], "count": -1, "place": 0}]
            break
        out.append({"path": r["path"], "protobuf": r["protobuf"], "begin": r["begin"], "length": r["length"], "count": r["count"], "place": place})
        expected, place = r["behind"], place + r["count"]
    return pa.Table.from_pylist(out, pa.schema([("path", pa.string()), ("protobuf", pa.bool_()), ("begin", pa.int64()), ("length", pa.int64()), ("count", pa.int64()), ("place", pa.int64())]))
