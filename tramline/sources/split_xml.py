"""Where a large XML file can be cut, found by many tasks at once.

A file is divided into byte ranges. A task that reads one range cannot know what is
open at its start, but it can say what the range does to it: how many elements that
were open it closes, and which start tags it leaves open. Put together in the order
of the ranges, these give the open elements at every range's start. From there a
second task reads on to the next place where a cut is allowed. Each piece between
two cuts, behind the start tags that are open at its beginning, is XML that a parser
takes on its own.

A range may also begin inside a comment, a CDATA section or a processing
instruction, so what it does is worked out for each of these.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .files import CHUNK, chunks, opened

#: Bytes of a piece, about.
PIECE = 32 << 20
#: Most tasks that pieces are dealt over, for each core.
TASKS_A_CORE = 32
#: What ends the constructs that a range may begin in, by their first characters.
ENDS = {b"<!--": b"-->", b"<![CDATA[": b"]]>", b"<?": b"?>"}
TAG = re.compile(rb"<(/?)([^\s/>!?\"'<]+)((?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*)>")
MARKUP = re.compile(rb"<(?:!--|!\[CDATA\[|\?)")
#: For the tags of a range to be told apart at once: bytes behind it in which the last one
#: has to end, and the most elements in it that are asked about.
BEHIND, ASKED = 1 << 16, 64
#: Files that are not cut: archives, text of two bytes a character, own entities.
WHOLE = re.compile(rb"PK|\xfe\xff|\xff\xfe|.*<!DOCTYPE", re.S)
DECLARATION = re.compile(rb"(?:\xef\xbb\xbf)?(<\?xml[^>]*\?>)")


def name(tag: bytes) -> bytes:
    """The local name of a tag."""
    return TAG.match(tag)[2].rpartition(b":")[2]


class Source:
    """A file's bytes from any place on, as far as they are needed."""

    def __init__(self, file: pa.NativeFile, start: int):
        self.file, self.base, self.data = file, start, b""
        file.seek(start)

    def more(self) -> bool:
        part = self.file.read(CHUNK)
        self.data += part
        return bool(part)

    def at(self, place: int, n: int) -> bytes:
        while len(self.data) < place - self.base + n and self.more():
            pass
        return self.data[place - self.base : place - self.base + n]

    def drop(self, before: int) -> None:
        if before - self.base > CHUNK:
            self.data, self.base = self.data[before - self.base :], before

    def find(self, what: bytes, place: int, limit: int | None = None) -> int:
        """Where ``what`` comes next; -1 if it does not, or not before ``limit``."""
        k = place - self.base
        while (found := self.data.find(what, k)) < 0:
            k = max(k, len(self.data) - len(what) + 1)
            if limit is not None and self.base + k >= limit or not self.more():
                return -1
        return found + self.base if limit is None or found + self.base < limit else -1

    def tag(self, place: int) -> re.Match | None:
        """The tag that starts at a place; None if none does."""
        while (m := TAG.match(self.data, place - self.base)) is None and b"<" not in self.data[place - self.base + 1 :] and self.more():
            pass
        return m


def tokens(file: pa.NativeFile, start: int, inside: bytes = b"", limit: int | None = None) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(start, end, kind, raw) of tags, comments and the like from ``start`` on;
    kind is the opening characters of a construct, ``<`` or ``</``. ``inside`` ends
    the construct that ``start`` lies in. A construct that does not end before
    ``limit`` has end -1, and is the last."""
    at = start - max(0, len(inside) - 1)  # what ends it may stand across the start
    source = Source(file, at)
    if inside:
        if (found := source.find(inside, at, limit)) < 0:
            yield at, -1, next(k for k in ENDS if ENDS[k] == inside), b""
            return
        if inside == b"-->" and b"--" in source.at(start + 3, max(0, found - start - 3)):  # beyond "!--", where "<" came before
            raise ValueError(f"no comment at byte {start}")  # which holds no "--", so another one begins
        at = found + len(inside)
    while (at := source.find(b"<", at, limit)) >= 0:
        head = source.at(at, 9)
        kind = next((k for k in ENDS if head.startswith(k)), None)
        if kind:
            end = source.find(ENDS[kind], at + len(kind), limit)
            if end < 0:
                yield at, -1, kind, b""
                return
            end, raw = end + len(ENDS[kind]), b""
        else:
            m = source.tag(at)
            if m is None:
                raise ValueError(f"no XML at byte {at}")
            kind, end, raw = b"</" if m[1] else b"<", source.base + m.end(), m[0]
        yield at, end, kind, raw
        at = end
        source.drop(at)


@dataclass
class Effect:
    """What a range does: how many elements it closes that were open before, the
    start tags that it leaves open, what ends the construct that its end lies in,
    and where the elements end that are asked about: (elements closed by then,
    start tags open then, place)."""

    closed: int = 0
    opened: list[str] = field(default_factory=list)
    inside: str = ""
    ends: list[tuple[int, list[str], int]] = field(default_factory=list)


def effect(file: pa.NativeFile, start: int, end: int, inside: bytes, noted: bytes) -> Effect | None:
    """The effect of a range that begins in ``inside``, None if it cannot; a tag
    belongs to the range that it starts in."""
    out = Effect()
    try:
        for at, stop, kind, raw in tokens(file, start, inside, end):
            if stop < 0 or stop > end and kind in ENDS:
                out.inside = ENDS[kind].decode()
            elif kind == b"<" and not raw.endswith(b"/>"):
                out.opened.append(raw.decode("latin-1"))
            elif kind == b"</":
                if out.opened:
                    out.opened.pop()
                else:
                    out.closed += 1
                if name(raw) == noted:
                    out.ends.append((out.closed, list(out.opened), at))
    except ValueError:
        return None
    return out


def unmatched(step: np.ndarray) -> tuple[int, np.ndarray]:
    """Of tags in order, 1 for a start tag, -1 for an end tag and 0 for both in one: how
    many elements they close that were open before, and the start tags left open."""
    if not len(step):
        return 0, np.zeros(0, np.int64)
    depth = np.cumsum(step, dtype=np.int32)
    lowest_from_here = np.minimum.accumulate(depth[::-1])[::-1]
    return max(0, -int(depth.min())), np.flatnonzero((step == 1) & (lowest_from_here >= depth))


def effect_at_once(data: bytes, start: int, size: int, noted: bytes) -> Effect | None:
    """``effect`` of the first ``size`` bytes of ``data``, which begin at the place
    ``start``, outside of comments and the like; None if its tags are unusual."""
    out, plain, behind = Effect(), bytearray(data), 0
    while (m := MARKUP.search(data, behind)) and m.start() < size:
        found = data.find(ENDS[m[0]], m.end())
        behind = found + len(ENDS[m[0]]) if found >= 0 else len(data)
        if found < 0 or behind > size:
            out.inside = ENDS[m[0]].decode()
        plain[m.start() : behind] = b" " * (behind - m.start())
    seen = np.frombuffer(plain, np.uint8)
    left, right = np.flatnonzero(seen[:size] == ord("<")), np.flatnonzero(seen == ord(">"))
    if not len(left):
        return out
    following = plain.find(b"<", int(left[-1]) + 1)
    first, upto = np.searchsorted(right, left), np.searchsorted(right, np.append(left[1:], following if following >= 0 else len(data)))
    if np.any(first == upto):
        return None  # a tag without an end
    last, unclear = right[first], upto - first > 1  # as one of these may stand in an attribute
    unclear[-1] = True
    for k in np.flatnonzero(unclear):
        if (tag := TAG.match(plain, int(left[k]))) is None:
            return None
        last[k] = tag.end() - 1
    second = seen[left + 1]
    if np.any((second == ord("!")) | (second == ord("?"))):
        return None
    step = np.where(second == ord("/"), -1, np.where(seen[last - 1] == ord("/"), 0, 1)).astype(np.int8)
    tags = lambda which: [bytes(plain[left[k] : last[k] + 1]).decode("latin-1") for k in which]
    out.closed, opened = unmatched(step)
    out.opened = tags(opened)
    asked = [m.start() for m in re.finditer(rb"</(?:[^\s/>!?\"'<]*:)?" + re.escape(noted) + rb"(?=[\s>])", plain[: size + len(noted) + BEHIND]) if m.start() < size]
    if len(asked) > ASKED:
        return None
    for place in asked:
        closed, opened = unmatched(step[: int(np.searchsorted(left, place)) + 1])
        out.ends.append((closed, tags(opened), start + place))
    return out


def effects_of(file: pa.NativeFile, start: int, end: int, length: int, noted: bytes) -> dict[str, Effect | None]:
    """The effect of a range by what it may begin in: all its tags are told apart at once
    if they are as usual, else one after the other."""
    lead = min(start, 3)  # what ends a comment may stand across the start
    data = b"".join(chunks(file, start - lead, min(length, end + BEHIND)))
    out: dict[str, Effect | None] = {}
    for inside in (b"", *ENDS.values()) if start else (b"",):
        at = data.find(inside, lead - min(lead, len(inside) - 1)) if inside else lead
        behind, found = at + len(inside), None
        if at < 0 and len(data) >= end - start + lead:
            found = Effect(inside=inside.decode())
        elif 0 <= at and behind <= lead + end - start and not (inside == b"-->" and b"--" in data[lead + 3 : at]):
            found = effect_at_once(data[behind:], start + behind - lead, end - start + lead - behind, noted)
        out[inside.decode()] = effect(file, start, end, inside, noted) if found is None else found
    return out


def ranges(files: DataFrame, size: int) -> DataFrame:
    """(path, start, end, length, head) of large files (path, length): ranges of
    ``size`` bytes; a file that cannot be cut is one. ``head`` is its declaration."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with opened(path) as file:
                    first = file.read(1 << 16)
                starts = [0] if WHOLE.match(first) else list(range(0, length, size))
                declared = DECLARATION.match(first)
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n, pa.string()), pa.array(starts, pa.int64()), pa.array([*starts[1:], length], pa.int64()), pa.array([length] * n, pa.int64()), pa.array([declared[1] if declared else b""] * n, pa.binary())],
                    ["path", "start", "end", "length", "head"],
                )

    return files.select("path", "length").mapInArrow(run, "path string, start long, end long, length long, head binary")


def dealt(rows: DataFrame, count: int) -> DataFrame:
    """``count`` rows, each much work, dealt over tasks evenly. Without a number of
    tasks they would be few, as rows are joined into tasks by their bytes."""
    return rows.repartition(max(1, min(count, TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism)))


def pieces(files: DataFrame, allowed: Callable[[list[bytes]], bool], last: tuple[str, ...], size: int = PIECE) -> DataFrame:
    """(path, start, end, length, prefix, piece): the pieces of large files, each
    well-formed behind its ``prefix`` but for the end tags that it leaves out, with a
    number of its own.

    ``allowed`` says of the names of the open elements whether a cut may be there.
    What follows the end of the first element with path ``last`` is left out.
    The pieces are written to the shared folder, a row for each.
    """
    noted = last[-1].encode()

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path, start, end, length in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                with opened(path) as file:
                    each = effects_of(file, start, end, length, noted) if end - start < length else {}
                found.append(json.dumps({i: asdict(e) for i, e in each.items() if e}))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "effects"])

    def opened_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ranges of a file in order: what is open at the start of each."""
        path, stack, inside, over = None, [], "", None
        for batch in batches:
            stacks, insides, overs = [], [], []
            for p, start, found in zip(*(batch.column(k).to_pylist() for k in (0, 1, 5)), strict=True):
                if p != path:
                    path, stack, inside, over = p, [], "", None
                known = json.loads(found)
                stacks.append(stack)
                insides.append(inside)
                if known:
                    if inside not in known:
                        raise ValueError(f"{path}: no XML after byte {start}")
                    e = known[inside]
                    after = lambda closed, tags, stack=stack: stack[: len(stack) - closed] + tags
                    for closed, tags, at in e["ends"]:
                        if over is None and tuple(name(t.encode("latin-1")).decode() for t in after(closed, tags)) == last[:-1]:
                            over = at
                    stack, inside = after(e["closed"], e["opened"]), e["inside"]
                overs.append(over)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(stacks, pa.list_(pa.string())), pa.array(insides, pa.string()), pa.array(overs, pa.int64())], [*batch.schema.names[:5], "stack", "inside", "over"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first place in each range, or after it, where a cut may be."""
        for batch in batches:
            starts, prefixes = [], []
            for path, start, length, head, stack, inside in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4, 5, 6)), strict=True):
                place, tags = (0, []) if not start else (length, [t.encode("latin-1") for t in stack])
                if start:
                    with opened(path) as file:
                        for at, _, kind, raw in tokens(file, start, inside.encode()):
                            if at >= start and allowed([name(t) for t in tags]):
                                place = at
                                break
                            if kind == b"<" and not raw.endswith(b"/>"):
                                tags.append(raw)
                            elif kind == b"</":
                                tags.pop()
                starts.append(place)
                prefixes.append(head + b"".join(tags) if place else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(starts, pa.int64()), batch.column(3), pa.array(prefixes, pa.binary()), batch.column(7)], ["path", "start", "length", "prefix", "over"])

    base = "path string, start long, end long, length long, head binary"
    count = files.agg(F.sum(F.ceil(F.col("length") / size))).head()[0] or 0
    done = dealt(ranges(files, size), count).mapInArrow(effects, f"{base}, effects string")
    known = done.repartition("path").sortWithinPartitions("path", "start").mapInArrow(opened_at, f"{base}, stack array<string>, inside string, over long")
    cuts = dealt(known, count).mapInArrow(cut, "path string, start long, length long, prefix binary, over long")
    cuts = cuts.groupBy("path", "start").agg(F.min("over").alias("over"), F.first("length").alias("length"), F.first("prefix").alias("prefix"))
    following = F.lead("start").over(Window.partitionBy("path").orderBy("start"))
    ended = cuts.withColumn("end", F.coalesce(following, "length")).where("start < end and (over is null or start < over)")
    folder, schema = shared_dir(files.sparkSession), "path string, start long, end long, length long, prefix binary, piece long"
    ended.select("path", "start", "end", "length", "prefix", F.monotonically_increasing_id().alias("piece")).write.parquet(folder)
    return files.sparkSession.read.schema(schema).parquet(folder)
