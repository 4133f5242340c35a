"""Line dedup by pairwise patience alignment.

Runs of consecutive lines that just reach the words of a block are hashed. Any
block long enough to go is covered by such runs, so a run that several
documents hold pairs every later holder with that run's own first holder: each
shared block is seen, whatever its lines' other holders, and the pairs grow with
the lines and never with the square of a group of copies. Each pair's line
hashes are aligned with patience diff (unique common lines in longest increasing
order are anchors, the gaps between them are solved alike, those without an
anchor by longest common subsequence), and aligned blocks go from the later
document; so do blocks that it repeats or holds at another place.

A rare run and one that a third of all rows hold are treated alike: each holder
is one pair with the first one, and the holders of a common run or first document
are dealt over many tasks. Runs are found by one hash of the lines and aligned by
another, so that a line goes only where two independent 64-bit hashes agree.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Hashable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import split_join, words, written

#: Words that an aligned block must have to be deleted.
MIN_WORDS = 10
#: Bits that the alignment of a gap keeps at once; a larger gap is halved first.
GAP_BITS = 1 << 28


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by the first, that also rises in the second."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        before[k] = ends[at - 1] if at else -1
        if at == len(tails):
            tails.append(j)
            ends.append(k)
        else:
            tails[at], ends[at] = j, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def lcs_rows(a: Sequence, b: Sequence) -> Iterator[int]:
    """For each start of ``a``, where its longest common subsequence with ``b``
    grows: the zero bits (bit-parallel)."""
    where: dict = {}
    for k, x in enumerate(b):
        where.setdefault(x, []).append(k)

    @lru_cache(max(1, GAP_BITS // (len(b) + 1)))
    def mask(x: Hashable) -> int:
        bits = np.zeros(len(b), np.uint8)
        bits[where.get(x, [])] = 1
        return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")

    v = full = (1 << len(b)) - 1
    for x in a:
        u = v & mask(x)
        v = (v + u | v - u) & full
        yield v


def common(a: Sequence, b: Sequence, most_bits: int = GAP_BITS) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        if i == i_end or j == j_end:
            continue
        n, m = i_end - i, j_end - j
        if n * m > most_bits and n > 1:
            half = i + n // 2
            ends = []
            for x, y in ((a[i:half], b[j:j_end]), (a[half:i_end][::-1], b[j:j_end][::-1])):
                *_, v = lcs_rows(x, y)
                grows = np.unpackbits(np.frombuffer(v.to_bytes(-(-m // 8), "little"), np.uint8), bitorder="little")[:m] == 0
                ends.append(np.concatenate(([0], np.cumsum(grows))))
            cut = j + int(np.argmax(ends[0] + ends[1][::-1]))
            todo += [(i, half, j, cut), (half, i_end, cut, j_end)]
            continue
        rows = list(lcs_rows(a[i:i_end], b[j:j_end]))
        while n and m:
            if rows[n - 1] >> (m - 1) & 1:
                m -= 1
                continue
            n -= 1
            if not n or rows[n - 1] >> (m - 1) & 1:
                m -= 1
                out.append((i + n, j + m))
    return sorted(out)


def patience(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Aligned positions (i, j) with a[i] == b[j], rising in both."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            found.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        where = {x: k for k, x in enumerate(b[j:j_end], j) if in_b[x] == 1}
        anchors = increasing([(k, where[x]) for k, x in enumerate(a[i:i_end], i) if in_a[x] == 1 and x in where])
        for x, y in anchors:
            todo.append((i, x, j, y))
            found.append((x, y))
            i, j = x + 1, y + 1
        if anchors:
            todo.append((i, i_end, j, j_end))
        else:  # lines of one side alone align with nothing
            at_a, at_b = [k for k in range(i, i_end) if a[k] in in_b], [k for k in range(j, j_end) if b[k] in in_a]
            found += [(at_a[x], at_b[y]) for x, y in common([a[k] for k in at_a], [b[k] for k in at_b])]
    return sorted(found)


def runs(n_words: Sequence[int], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """(first, last) line of all runs of lines that just reach ``min_words``:
    without their first line, or without their last, they would not. Every line
    with words in a block of ``min_words`` is in such a run of that block."""
    at = [k for k, n in enumerate(n_words) if n > 0]
    out: set[tuple[int, int]] = set()
    total, start = 0, 0
    for end, k in enumerate(at):  # the shortest run that ends at each line
        total += n_words[k]
        while total - n_words[at[start]] >= min_words:
            total -= n_words[at[start]]
            start += 1
        if total >= min_words:
            out.add((at[start], k))
    total, end = 0, len(at) - 1
    for k in reversed(at):  # the shortest run that starts at each line
        total += n_words[k]
        while total - n_words[at[end]] >= min_words:
            total -= n_words[at[end]]
            end -= 1
        if total >= min_words:
            out.add((k, at[end]))
    return sorted(out)


def removed_lines(a: Sequence, b: Sequence, n_words: Sequence[int], min_words: int = MIN_WORDS) -> list[int]:
    """Lines of ``b`` in aligned blocks of at least ``min_words`` words, and in
    blocks of as many that ``a`` holds but the alignment left, as ``b`` repeats
    them or has them at another place."""
    out: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(a, b), (-9, -9)]:
        if (i - 1, j - 1) != last:
            if sum(n_words[k] for k in block) >= min_words:
                out += block
            block = []
        block.append(j)
        last = (i, j)
    gone, held = set(out), set(a)
    if all(k in gone or not n or x not in held for k, (x, n) in enumerate(zip(b, n_words, strict=True))):
        return out
    words_of = dict(zip(b, n_words, strict=True))
    there = {tuple(a[s : e + 1]) for s, e in runs([words_of.get(x, min_words) for x in a], min_words)}
    for s, e in runs(n_words, min_words):
        if tuple(b[s : e + 1]) in there:
            gone.update(range(s, e + 1))
    return sorted(gone)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``docs``: (doc, n_lines, gone, kept): the row itself as a struct
    of all its columns, the number of its lines, the positions deleted (null:
    none) and the text left.

    Lines end at \\n and are compared without white space at their ends; the
    earlier document is the one with the smaller id, of rows with one id the one
    whose text has the smaller hash. A null text has no lines and ``kept`` null;
    the empty text is one line and stays; a row with a null id neither loses nor
    removes lines; rows repeated under one id do not remove each other's lines,
    and each loses what earlier documents hold. A document all of whose lines go
    keeps the empty text. Texts are taken whole, however long: a text's line
    hashes are one row, and a gap is aligned in GAP_BITS at a time. An empty
    table gives no rows. Other columns, of any name, stay inside ``doc``.
    """
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), key.alias("row"), F.split(text_col, "\n").alias("l")).where("id is not null and l is not null")
    rows = rows.withColumn("l", F.transform("l", lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    "))))
    rows = rows.select(
        F.struct("id", "row").alias("doc"),
        F.transform("l", lambda x: F.xxhash64(x)).alias("h"),
        F.transform("l", lambda x: F.xxhash64(x, F.lit(1))).alias("g"),
        F.transform("l", lambda x: F.size(words(x))).alias("n"),
    )
    rows = written(rows)  # hashes and counts, far smaller than the texts, and read four times

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, keys = [], []
            g, n = batch.column(2), batch.column(3)
            data, bounds = g.flatten().to_numpy(zero_copy_only=False).tobytes(), np.concatenate(([0], np.cumsum(g.value_lengths()))).tolist()
            for k, n_words in enumerate(n.to_pylist()):
                mine = {xxh64_intdigest(data[8 * (bounds[k] + s) : 8 * (bounds[k] + e + 1)]) for s, e in runs(n_words, min_words)}
                owner += [k] * len(mine)
                keys += mine
            at = pa.array(owner, pa.int64())
            hashes = pa.array(np.array(keys, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), hashes], ["id", "row", "hash"])

    unique = rows.dropDuplicates(["doc"])
    # one row for each document and run
    held = unique.select("doc.id", "doc.row", "g", "n").mapInArrow(hashed, "id long, row long, hash long").select(F.struct("id", "row").alias("doc"), "hash")
    shared = held.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc.id").alias("last"), F.count("*").alias("n")).where("first.id < last")
    shared = written(shared.select("hash", "first", "n"))
    # one row for each pair of documents
    pairs = split_join(held, shared.select("hash", "first"), "hash", shared.select("hash", "n"), F.col("doc")).where("first.id < doc.id")
    pairs = written(pairs.select("first", "doc").distinct())

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, pos = [], []
            columns = [batch.column(k) for k in range(3)]
            for k, (a, b, n) in enumerate(zip(*(c.to_pylist() for c in columns), strict=True)):
                gone = removed_lines(a, b, n, min_words)
                docs_ += [k] * len(gone)
                pos += gone
            at = pa.array(docs_, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(3).take(at), batch.column(4).take(at), pa.array(pos, pa.int32())], ["id", "row", "pos"])

    later = pairs.join(unique.select("doc", "h", "n"), "doc")
    firsts = unique.select(F.col("doc").alias("first"), F.col("h").alias("ha"))
    both = split_join(later, firsts, "first", pairs.groupBy("first").agg(F.count("*").alias("n")), F.col("doc"))
    aligned = both.select("ha", "h", "n", "doc.id", "doc.row").mapInArrow(align, "id long, row long, pos int")
    gone = aligned.groupBy("id", "row").agg(F.collect_set("pos").alias("gone"))
    # rows without an id meet nothing: their keys only have to be many
    own = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id()).otherwise(key)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).cast("long").alias("id"), own.alias("row"), F.col(text_col).alias("text"))
    out = whole.join(gone, ["id", "row"], "left").withColumn("lines", F.split("text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    return out.select("doc", F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).alias("n_lines"), "gone", kept.alias("kept"))


def report(docs: DataFrame) -> DataFrame:
    """Per row: (doc_id, n_lines, n_removed, kept_sha256)."""
    found = dedup_lines(docs.select("doc_id", "text"))
    return found.select(
        "doc.doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )
