"""Substring dedup with a count-min prefilter.

Documents are dealt once into bundles by a hash, a few MB of text each. Every
bundle sketches its windows of ``size`` consecutive words: for each row of the
count-min sketch, the sorted cells it hits and whether it hits them twice. The
partition sketches are merged block of cells by block of cells, each in its own
group, and each bundle gets back one bit for each cell it sent: whether the
merged count reaches two. Counts are only overestimated, so a window that any
two documents share keeps its bits set in all rows and none is lost.

The second pass groups exactly, by a 96-bit hash of the word sequence, only the
windows that all rows estimate as repeated; a bundle sends each of those once
with its smallest document id and gets back one bit: whether that id is the
smallest anywhere. The width of the sketch follows the size of the corpus, no
sketch or window list is ever gathered in one place, and a window that a third
of the documents hold costs one entry for each bundle.

Blocks of cells, the groups of the second pass and bundles grow with the corpus
(``sizes``), so that a shuffled row carries many windows at any size; partitions
are of a number of their own and hold many bundles.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HEAVY_KEYS, written

#: Rows of the count-min sketch.
DEPTH = 2
#: Cells of a block that is merged in one group, as a power of two: at least,
#: and at most (256 MB of counts).
BLOCK, BLOCK_MOST = 22, 28
#: Blocks of a row of the sketch, as a power of two, before blocks grow.
BLOCKS = 12
#: Characters of text in a bundle, at least about.
BUNDLE_CHARS = 8_000_000
#: Windows of a bundle that a shuffled row of its sketch carries at least, on average.
WINDOWS_A_ROW = 12
#: Characters of a window's word and blank, about.
CHARS_A_WINDOW = 6
#: Partitions that bundles are dealt to, at most.
PARTITIONS = 50_000
LAST = np.iinfo(np.int64).max
#: The odd bases of the two word hashes.
BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
#: Powers that are kept between calls, at most.
KEPT_POWERS = 1 << 19
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def words_at(texts: pa.Array, blank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, where words start, where they end, number of the
    first word of each text and of one beyond the last). ``blank``: the bytes
    that separate words, ASCII white space if absent."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
    bounds = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    inside = ~(BLANK if blank is None else blank)[data]
    left, right = np.ones(len(data), bool), np.ones(len(data), bool)  # next to a blank or an end of a text
    left[1:], right[:-1] = ~inside[:-1], ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    left[cuts], right[cuts - 1] = True, True
    starts, ends = np.flatnonzero(inside & left), np.flatnonzero(inside & right) + 1
    return data, starts, ends, np.searchsorted(starts, bounds)


@lru_cache(maxsize=32)
def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd ``base``, and of its inverse."""
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of each word: its polynomial in the odd ``base``, stirred."""
    out = []
    for k in range(0, len(starts), 1 << 14):
        s, e = starts[k : k + (1 << 14)], ends[k : k + (1 << 14)]
        s, e, part = s - s[0], e - s[0], data[s[0] : e[-1]].astype(np.uint64)
        n = len(part)
        up, down = powers(base, 1 << (n - 1).bit_length()) if n <= KEPT_POWERS else powers.__wrapped__(base, n)
        part += np.uint64(1)
        part *= up[:n]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(part, out=sums[1:])
        out.append((sums[e] - sums[s]) * down[s])
    return mixed(np.concatenate(out), base) if out else np.empty(0, np.uint64)


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit words with all bits stirred."""
    x = (x ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Windows:
    """The windows of a bundle: where they start, their documents and hashes."""

    def __init__(self, table: pa.Table, id_col: str, size: int):
        # the order in which a shuffle hands out rows differs between reads
        table = table.sort_by([(id_col, "ascending"), ("text", "ascending")]).combine_chunks()
        self.size, self.table = size, table
        self.data, self.word, self.end, self.offsets = words_at(table.column("text"))
        self.ids = np.asarray(pc.fill_null(table.column(id_col), LAST), np.int64)
        n, lens = len(self.word), np.diff(self.offsets)
        owner = np.repeat(np.arange(len(lens)), lens)
        fits = self.offsets[1:][owner] - np.arange(n) >= size
        self.start = np.flatnonzero(fits)
        self.owner = owner[self.start]
        self.h1, self.h2 = self.hashed(0), self.hashed(1).astype(np.uint32)

    def hashed(self, which: int) -> np.ndarray:
        word = word_hashes(self.data, self.word, self.end, BASES[which])
        n = max(0, len(word) - self.size + 1)
        total = np.zeros(n, np.uint64)
        for j, by in enumerate(np.random.default_rng(which).integers(1, 2**63, self.size, np.uint64)):
            total += word[j : j + n] * (by * np.uint64(2) + np.uint64(1))
        return mixed(total[self.start], which)

    def cells(self, row: int, bits: int) -> np.ndarray:
        """The cell of each window in a row of a sketch of 2**bits cells."""
        return mixed(self.h1, 1000 + row) >> np.uint64(64 - bits)


def packed(sorted_numbers: np.ndarray) -> bytes:
    """Sorted uint32 as byte planes of their differences, which compress well."""
    steps = np.diff(sorted_numbers, prepend=0).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


def table_of(**columns) -> pa.Table:
    kinds = {"bundle": pa.int64(), "row": pa.int32(), "block": pa.int64()}
    return pa.table({k: pa.array(v, kinds.get(k, pa.binary())) for k, v in columns.items()})


def sketch(table: pa.Table, id_col: str, size: int, bits: int, depth: int, block: int) -> pa.Table:
    """The sketch of a bundle: one row for each sketch row and block it hits."""
    w, bundle = Windows(table, id_col, size), table.column("bundle")[0].as_py()
    out: dict[str, list] = {"bundle": [], "row": [], "block": [], "cells": [], "twice": []}
    for row in range(depth):
        cells, counts = np.unique(w.cells(row, bits), return_counts=True)
        blocks, first = np.unique(cells >> np.uint64(block), return_index=True)
        for b, s, e in zip(blocks.tolist(), first, np.append(first, len(cells))[1:], strict=True):
            for k, v in (("bundle", bundle), ("row", row), ("block", b), ("cells", packed((cells[s:e] & np.uint64((1 << block) - 1)).astype(np.int64))), ("twice", np.packbits(counts[s:e] > 1).tobytes())):
                out[k].append(v)
    return table_of(**out)


def merge(table: pa.Table, block: int) -> pa.Table:
    """Adds up a block of all sketches; which cells of each reach two."""
    counts = np.zeros(1 << block, np.uint8)
    cells = [unpacked(x) for x in table.column("cells").to_pylist()]
    for at, twice in zip(cells, table.column("twice").to_pylist(), strict=True):
        more = 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=len(at))
        counts[at] = np.minimum(counts[at] + more, 2)
    flags = [np.packbits(counts[at] > 1).tobytes() + len(at).to_bytes(4, "little") for at in cells]
    return table_of(bundle=table.column("bundle"), row=table.column("row"), block=table.column("block"), flags=flags)


def repeated(w: Windows, flags: pa.Table, bits: int, depth: int) -> np.ndarray:
    """Which windows all rows of the merged sketch estimate as repeated."""
    found = np.ones(len(w.start), bool)
    flags = flags.sort_by([("row", "ascending"), ("block", "ascending")])
    rows, data = np.asarray(flags.column("row")), flags.column("flags").to_pylist()
    for row in range(depth):
        mine = [x for r, x in zip(rows, data, strict=True) if r == row]
        bit = np.concatenate([np.unpackbits(np.frombuffer(x[:-4], np.uint8), count=int.from_bytes(x[-4:], "little")) for x in mine] or [np.empty(0, np.uint8)])
        _, where = np.unique(w.cells(row, bits), return_inverse=True)
        found &= bit[where].astype(bool)
    return found


def distinct(w: Windows, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows found: their order by hash, each one's number among the distinct ones, and where those start."""
    order = np.lexsort((w.ids[w.owner[found]], w.h2[found], w.h1[found]))
    h1, h2 = w.h1[found][order], w.h2[found][order]
    new = np.ones(len(order), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


def candidates(docs: pa.Table, flags: pa.Table, id_col: str, size: int, bits: int, depth: int, parts: int) -> pa.Table:
    """A bundle's windows estimated repeated, each once, dealt by their hash."""
    w = Windows(docs, id_col, size)
    found = repeated(w, flags, bits, depth)
    order, _, first = distinct(w, found)
    h1, h2, ids = w.h1[found][order][first], w.h2[found][order][first], w.ids[w.owner[found]][order][first]
    part = (h1 >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    blocks, at = np.unique(part, return_index=True)
    bundle, marks = docs.column("bundle")[0].as_py(), np.packbits(found).tobytes()
    out: dict[str, list] = {"bundle": [], "block": [], "h1": [], "h2": [], "ids": [], "marks": []}
    for k, (b, s, e) in enumerate(zip(blocks.tolist() or [0], at if len(at) else [0], [*at[1:], len(h1)], strict=True)):
        planes = ids[s:e].astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()
        for name, v in (("bundle", bundle), ("block", b), ("h1", h1[s:e].tobytes()), ("h2", h2[s:e].tobytes()), ("ids", planes), ("marks", marks if k == 0 else None)):
            out[name].append(v)
    return table_of(**out)


def exact(table: pa.Table) -> pa.Table:
    """Groups equal windows of all bundles; which entries hold the smallest id."""
    parts = [(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u4"), np.ascontiguousarray(np.frombuffer(c, np.uint8).reshape(8, -1).T).view("<i8").ravel()) for a, b, c in zip(*(table.column(x).to_pylist() for x in ("h1", "h2", "ids")), strict=True)]
    h1, h2, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((ids, h2, h1))
    a, b, c = h1[order], h2[order], ids[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    smallest = np.empty(len(order), bool)
    smallest[order] = c == c[np.flatnonzero(new)][np.cumsum(new) - 1] if len(c) else []
    ends = np.cumsum([len(x[0]) for x in parts])[:-1]
    firsts = [np.packbits(x).tobytes() + len(x).to_bytes(4, "little") for x in np.split(smallest, ends)]
    return table_of(bundle=table.column("bundle"), block=table.column("block"), firsts=firsts, marks=table.column("marks"))


def covered(w: Windows, answers: pa.Table) -> np.ndarray:
    """Which words of a bundle a window covers that starts in a smaller id."""
    answers = answers.sort_by([("block", "ascending")])
    marks = next(x for x in answers.column("marks").to_pylist() if x is not None)
    found = np.unpackbits(np.frombuffer(marks, np.uint8), count=len(w.start)).astype(bool)
    order, number, first = distinct(w, found)
    bit = np.concatenate([np.unpackbits(np.frombuffer(x[:-4], np.uint8), count=int.from_bytes(x[-4:], "little")) for x in answers.column("firsts").to_pylist()])
    ids = w.ids[w.owner[found]][order]
    later = np.empty(len(order), bool)
    later[order] = (bit[number] == 0) | (ids > ids[first][number])
    begun = w.start[found][later]
    edges = np.bincount(begun, minlength=len(w.word) + w.size + 1) - np.bincount(begun + w.size, minlength=len(w.word) + w.size + 1)
    return np.cumsum(edges)[: len(w.word)] > 0


def sizes(chars: int, bundle_chars: int = BUNDLE_CHARS) -> tuple[int, int, int, int, int]:
    """For a corpus of so many characters: (bits of a sketch row, bits of a
    block, bundles, partitions, groups of the second pass)."""
    bits = max(16, int(chars).bit_length())  # 4 to 8 cells for each window
    block = min(bits, BLOCK_MOST, max(BLOCK, bits - BLOCKS))
    a_bundle = max(bundle_chars, WINDOWS_A_ROW * CHARS_A_WINDOW << (bits - block) if bits > BLOCK + BLOCKS else 0)
    bundles = max(1, -(-chars // a_bundle))
    return bits, block, bundles, min(bundles, PARTITIONS), max(1, min(chars >> 22, 4_096 + (chars >> 28)))


def apart(docs: DataFrame, repeated: DataFrame, id_col: str, bundle_chars: int) -> DataFrame:
    """``docs`` with a ``_salt`` that deals rows repeated under one id, which never
    remove each other's words, over as many bundles as they have characters for.

    ``repeated``: id, hash and characters of the groups of rows that would not fit
    a bundle. Where there are any the salted rows are written, since every pass has
    to find a row in the same bundle.
    """
    if repeated.isEmpty():
        return docs.withColumn("_salt", F.lit(0))
    keys = repeated.select(F.col(id_col).alias("_id"), "_h", F.ceil(F.col("_chars") / bundle_chars).cast("int").alias("_parts"))
    keys = F.broadcast(keys) if keys.count() <= HEAVY_KEYS else keys  # a longer list is joined, its large keys split by AQE
    dealt = docs.join(keys, F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_h")), "left")
    salt = F.floor(F.rand(7) * F.coalesce("_parts", F.lit(1))).cast("int")
    return written(dealt.select(id_col, "text", salt.alias("_salt")))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 13, depth: int = DEPTH, bundle_chars: int = BUNDLE_CHARS, keep_text: bool = False) -> DataFrame:
    """Per row of ``docs``: (id_col, n_words, n_removed, kept_sha256[, kept_text]).

    Words are runs of anything but ASCII white space. A word goes if a window
    of ``size`` words covers it whose word sequence also starts in a row with a
    smaller id; windows are judged on the input. ``kept_sha256`` is of the kept
    words joined by single spaces, ``kept_text`` that text.

    Null and empty texts have no words and keep the empty text. A null id
    counts as the largest, and rows of one id never remove each other's words.
    Repeated rows each give a row; an empty table gives none; other columns
    are not read. A text shorter than a window stays whole; a longer one is
    read whole, in one bundle. Of equal windows in one text none goes.
    """
    docs = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    alike = written(docs.groupBy(id_col, F.xxhash64("text").alias("_h")).agg(F.count("*").alias("_n"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("_chars")))
    chars = alike.agg(F.coalesce(F.sum("_chars"), F.lit(0))).head()[0]
    bits, block, bundles, partitions, parts = sizes(chars, bundle_chars)
    docs = apart(docs, alike.where((F.col("_n") > 1) & (F.col("_chars") > bundle_chars)), id_col, bundle_chars)
    # texts too short for a window meet nothing: they go by partition too, so that repeated rows spread
    spread = F.when(F.coalesce(F.length("text"), F.lit(0)) < 2 * size - 1, F.spark_partition_id()).otherwise(F.lit(0))
    dealt = docs.withColumn("bundle", F.pmod(F.xxhash64(id_col, "text", spread, "_salt"), F.lit(bundles))).drop("_salt").repartition(partitions, "bundle")

    sketches = dealt.groupBy("bundle").applyInArrow(lambda t: sketch(t, id_col, size, bits, depth, block), "bundle long, row int, block long, cells binary, twice binary")
    flags = sketches.groupBy("row", "block").applyInArrow(lambda t: merge(t, block), "bundle long, row int, block long, flags binary")

    def seek(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return candidates(left, right, id_col, size, bits, depth, parts)

    sent = dealt.groupBy("bundle").cogroup(flags.groupBy("bundle")).applyInArrow(seek, "bundle long, block long, h1 binary, h2 binary, ids binary, marks binary")
    answers = sent.groupBy("block").applyInArrow(exact, "bundle long, block long, firsts binary, marks binary")

    def finish(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        w = Windows(left, id_col, size)
        gone = covered(w, right)
        ids, n, out = w.table.column(id_col), np.diff(w.offsets), []
        for s, e in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True):
            keep = s + np.flatnonzero(~gone[s:e])
            if len(keep) == e - s:
                out.append(b" ".join(w.data[w.word[s] : w.end[e - 1]].tobytes().split()) if e > s else b"")
            else:
                first, text = w.word[s], w.data[w.word[s] : w.end[e - 1]].tobytes()
                out.append(b" ".join([text[x:y] for x, y in zip((w.word[keep] - first).tolist(), (w.end[keep] - first).tolist(), strict=True)]))
        removed = np.add.reduceat(np.append(gone, False), w.offsets[:-1]) * (n > 0) if len(n) else n
        columns = {id_col: ids.cast(pa.int64()), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(removed.astype(np.int64)), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in out], pa.string())}
        if keep_text:
            columns["kept_text"] = pa.array(out, pa.binary()).cast(pa.string())
        return pa.table(columns)

    schema = f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text
    return dealt.groupBy("bundle").cogroup(answers.groupBy("bundle")).applyInArrow(finish, schema)
