"""Best-fit packing into sequences of several permitted lengths.

Lengths are counted into a histogram, which has at most as many entries as the
largest permitted sequence is long, whatever the size of the corpus. Best-fit
decreasing runs on it in bulk: all pieces of one length are placed in runs of
equal bins, so the plan is a short list of intervals. Every set of sizes that
bins may be opened at is tried; a new bin opens at the size of the set with the
least cost for each unit it can still be filled with, and at the end each bin
shrinks to the smallest permitted size that holds its contents. The plan with
the least total cost wins. Pieces are then numbered within their length, in
salted groups, and each looks up its bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import words, written

#: Permitted sequence lengths and the cost of a sequence of each: linear plus
#: an attention term.
SIZES = (512, 1024, 2048, 4096)


def cost_of(size: int) -> float:
    return size * (1 + size / 16_384)


#: (length, first rank, pieces, first bin, pieces in each bin, offset in the bin)
Interval = tuple[int, int, int, int, int, int]


def pack(counts: Mapping[int, int], opened: tuple[int, ...], costs: Mapping[int, float]) -> tuple[list[Interval], list[tuple[int, int, int]]]:
    """Best-fit decreasing of a histogram; bins open at the sizes ``opened``.

    Returns the intervals, and the bins as (first bin, bins, contents).
    """
    intervals: list[Interval] = []
    room: dict[int, list[tuple[int, int, int]]] = {}  # room left: [(first bin, bins, size)]
    rooms: list[int] = []
    bins = 0
    left = sum(n * c for n, c in counts.items())

    def put(space: int, run: tuple[int, int, int]) -> None:
        if space not in room:
            room[space] = []
            insort(rooms, space)
        room[space].append(run)

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            at = bisect_left(rooms, length)
            if at < len(rooms):  # best fit: the least room that holds it
                space = rooms[at]
                first, n, size = room[space].pop()
                if not room[space]:
                    del room[space]
                    rooms.pop(at)
                used = min(n, todo)
                intervals.append((length, rank, used, first, 1, size - space))
                put(space - length, (first, used, size))
                if used < n:
                    put(space, (first + used, n - used, size))
                rank, todo, left = rank + used, todo - used, left - used * length
                continue
            size = min((s for s in opened if s >= length), key=lambda s: (costs[s] / min(s, left), -s))
            each = size // length
            for n, k in ((todo // each, each), (int(todo % each > 0), todo % each)):
                if n:
                    intervals.append((length, rank, n * k, bins, k, 0))
                    put(size - k * length, (bins, n, size))
                    bins, rank, left = bins + n, rank + n * k, left - n * k * length
            todo = 0
    return intervals, [(first, n, size - space) for space, runs in room.items() for first, n, size in runs]


def best_plan(counts: Mapping[int, int], costs: Mapping[int, float]) -> tuple[list[Interval], list[tuple[int, int, int, int]]]:
    """The cheapest plan over all sets of sizes that bins may be opened at, and
    its bins as (first bin, bins, contents, size after downsizing)."""
    sizes, best = sorted(costs), None
    for n in range(len(sizes)):
        for smaller in combinations(sizes[:-1], n):
            intervals, filled = pack(counts, (*smaller, sizes[-1]), costs)
            runs = [(first, k, used, sizes[bisect_left(sizes, used)]) for first, k, used in filled]
            rank = (sum(k * costs[s] for _, k, _, s in runs), sum(k for _, k, _, _ in runs))
            if best is None or rank < best[0]:
                best = rank, intervals, runs
    return best[1], sorted(best[2])


def pieces(docs: DataFrame, id_col: str, text_col: str, largest: int) -> DataFrame:
    """(id_col, piece, start, length): documents in pieces of at most ``largest`` words."""
    n = docs.select(F.col(id_col).cast("long").alias(id_col), F.size(words(F.col(text_col))).alias("_n")).where("_n > 0")
    cut = n.withColumn("piece", F.explode(F.sequence(F.lit(0), ((F.col("_n") - 1) / largest).cast("int"))))
    start = F.col("piece") * largest
    return cut.select(id_col, "piece", start.alias("start"), F.least(F.lit(largest), F.col("_n") - start).alias("length"))


def best_fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", costs: Mapping[int, float] | None = None, rows_of_a_salt: int = 10_000) -> DataFrame:
    """Per piece: (id_col, piece, start, length, bin_id, bin_size, position).

    Lengths are in words. A document longer than the largest permitted
    sequence is cut into pieces of that length and a rest, none is dropped;
    ``start`` is the piece's first word in its document, ``position`` its first
    word in the bin. Texts without words (null, empty) take no room and give no
    row; a null id is packed like any other; repeated rows are packed each; of
    equal lengths the order is by a hash, then id and piece; texts count whole;
    other columns are not read; an empty table gives none.
    """
    costs = dict(costs or {s: cost_of(s) for s in SIZES})
    largest = max(costs)
    cut = written(pieces(docs, id_col, text_col, largest))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `largest` rows
    schema = f"`{id_col}` long, piece int, start int, length int, bin_id long, bin_size int, position int"
    if not counts:
        return cut.select(id_col, "piece", "start", "length", F.lit(0).cast("long").alias("bin_id"), F.lit(0).alias("bin_size"), F.lit(0).alias("position"))
    intervals, bins = best_plan(counts, costs)

    # a rank of each piece within its length: groups of a length are salted, so none is large
    salts = max(1, sum(counts.values()) // rows_of_a_salt)
    apart = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())  # rows without an id spread too
    salted = cut.withColumn("salt", F.pmod(F.xxhash64(id_col, "piece", apart), F.lit(salts)).cast("int"))
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = before.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy(id_col, "piece", "start"))
    ranked = salted.withColumn("rank", within - 1).join(before, ["length", "salt"])
    ranked = ranked.select(id_col, "piece", "start", "length", (F.col("rank") + F.col("before")).alias("rank"))

    plan = np.array(sorted(intervals), np.int64)
    runs = np.array(bins, np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.int64(1) << 44  # above any rank
        keys = plan[:, 0] * base + plan[:, 1]
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (3, 4))
            p = plan[np.searchsorted(keys, length * base + rank, "right") - 1]
            nth = rank - p[:, 1]
            bin_id = p[:, 3] + nth // p[:, 4]
            size = runs[np.searchsorted(runs[:, 0], bin_id, "right") - 1, 3]
            position = p[:, 5] + nth % p[:, 4] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(bin_id), pa.array(size.astype(np.int32)), pa.array(position.astype(np.int32))], [id_col, "piece", "start", "length", "bin_id", "bin_size", "position"])

    return ranked.mapInArrow(place, schema)
