"""Hard negatives by K-means inverted lists.

Every vector lies in the list of its nearest centroid; lists are cut into blocks
of bounded size, each with the largest distance of its vectors from the centroid
as radius. By Cauchy-Schwarz the product of an anchor a with any vector of a block
is at most a.c + |a| r and at least a.c - |a| r. An anchor visits blocks by falling
upper bound, leaves out blocks whose bounds lie outside its window of scores, and
stops when the bound falls strictly below the k-th score that it has. Visits go in
waves: the first blocks of every anchor, then more of those still needed, then all
still needed, so the result is that of comparing with every row.

In a wave the vectors of a block meet the anchors that visit it in one task, the
vectors held (a bounded number) and the anchors read one batch after the other.
Scores are whole numbers throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .vectors import matrix_of, whole_vectors

#: Most centroids, entries of all centroids and entries of the sample that they
#: are fit on; vectors of the sample for each centroid.
CENTROIDS, CENTROID_ENTRIES, SAMPLE_ENTRIES, SAMPLE_EACH = 4_096, 1 << 22, 1 << 23, 64
#: Vectors of a block on average at least, and blocks at most besides one for each
#: centroid: beyond, blocks grow.
BLOCK_ROWS, BLOCKS = 256, 65_536
#: Blocks that an anchor has visited at the end of each wave but the last.
WAVES = (8, 64)
VISIT = "block int, side int, id long, label long, x array<long>, windows array<struct<w: long, low: long, high: long, least: long>>"


@dataclass
class Lists:
    """The index: ``rows`` (block, id, label, x), the centroids, and of each block
    its centroid's number and its radius."""

    rows: DataFrame
    centroids: np.ndarray
    of_block: np.ndarray
    radius: np.ndarray


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and of ``b``; a product beyond a
    long raises an error."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return (a.astype(object) @ b.T.astype(object)).astype(np.int64)


def k_means(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from the first rows of the sample; a centroid that loses
    all rows stays where it is."""
    centroids = sample[:k].astype(float)
    for _ in range(rounds):
        nearest, _ = assigned(sample, centroids)
        counts = np.bincount(nearest, minlength=k)
        total = np.zeros_like(centroids)
        np.add.at(total, nearest, sample)
        centroids = np.where(counts[:, None] > 0, total / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def assigned(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, and the distance to it."""
    size = (centroids**2).sum(axis=1)
    nearest = np.concatenate([(size - 2 * (x[s : s + 1024] @ centroids.T)).argmin(axis=1) for s in range(0, len(x), 1024)] or [np.zeros(0, int)])
    return nearest, np.linalg.norm(x - centroids[nearest], axis=1)


def build(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> Lists | None:
    """The lists of ``vectors`` (id, label, x), ids unique; None without rows.

    Centroids, the square root of the rows in number, are fit on a sample that is
    bounded (``SAMPLE_EACH``, ``SAMPLE_ENTRIES``), the first rows by a hash of the
    id; every row is then put into a list. A list of more than a block's rows is
    dealt over blocks by another hash of the id.
    """
    vectors = written(vectors)
    n = vectors.count()
    if not n:
        return None
    d = len(vectors.first()["x"])
    k = max(1, min(isqrt(n), CENTROIDS, CENTROID_ENTRIES // d))
    size = max(k, min(n, SAMPLE_EACH * k, SAMPLE_ENTRIES // d))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    some = vectors.where(place < int(min(1, 2 * size / n) * (1 << 30))).orderBy(place, "id").limit(size)
    sample = np.array([r["x"] for r in some.select("x").collect()], float)
    centroids = k_means(sample, min(k, len(sample)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nearest, far = assigned(matrix_of(batch.column(2)), centroids)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest, pa.int32()), pa.array(far)], ["id", "label", "x", "list", "far"])

    listed = written(vectors.select("id", "label", "x").mapInArrow(assign, "id long, label long, x array<long>, list int, far double"))
    rows = max(block_rows, -(-n // BLOCKS))
    counts = listed.groupBy("list").count().collect()  # a row for each centroid at most
    parts, first, at = {}, {}, 0
    for r in sorted(counts, key=lambda r: r["list"]):
        parts[r["list"]], first[r["list"]] = -(-r["count"] // rows), at
        at += parts[r["list"]]
    starts = F.broadcast(vectors.sparkSession.createDataFrame([(c, first[c], parts[c]) for c in parts], "list int, first int, parts int"))
    block = F.col("first") + F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int")
    blocked = written(listed.join(starts, "list").select(block.alias("block"), "list", "id", "label", "x", "far"))
    found = blocked.groupBy("block").agg(F.max("far").alias("radius"), F.min("list").alias("list")).collect()  # a row for each block
    of_block, radius = np.zeros(at, int), np.full(at, -1.0)
    for r in found:
        of_block[r["block"]], radius[r["block"]] = r["list"], r["radius"]
    return Lists(blocked.select("block", "id", "label", "x"), centroids, of_block, radius)


def visits(anchors: DataFrame, lists: Lists, done: int, upto: int | None) -> DataFrame:
    """The blocks from number ``done`` up to ``upto`` in each anchor's order, as
    long as they are needed: a row for each anchor and block."""
    centroids, of_block, radius = lists.centroids, lists.of_block, lists.radius

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 64):
                batch = whole.slice(s, 64)
                x = matrix_of(batch.column(2)).astype(float)
                middle = (x @ centroids.T)[:, of_block]
                reach = np.linalg.norm(x, axis=1)[:, None] * radius
                slack = 1e-9 * (np.abs(middle) + reach + 1)  # of the rounding
                upper, lower = middle + reach + slack, middle - reach - slack
                upper[:, radius < 0] = -np.inf  # a block without rows
                for i, windows in enumerate(batch.column(3).to_pylist()):
                    order = np.argsort(-upper[i], kind="stable")[done:upto]
                    needed = np.zeros(len(order), bool)
                    for w in windows:
                        needed |= (upper[i, order] >= w["least"]) & (lower[i, order] <= w["high"])
                    if len(order := order[needed]):
                        own = batch.take(pa.array(np.full(len(order), i)))
                        yield pa.RecordBatch.from_arrays([pa.array(order, pa.int32()), pa.array(np.ones(len(order)), pa.int32()), *own.columns], ["block", "side", "id", "label", "x", "windows"])

    return anchors.select("id", "label", "x", "windows").mapInArrow(run, VISIT)


def scored(visited: DataFrame, lists: Lists, k: int, same_label: bool) -> DataFrame:
    """(anchor, w, id, score): of each visit and window the ``k`` first rows of the
    block, by falling score, then by id, none below what the anchor has already."""

    def best(label: int, own: int, windows: list[dict], score: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Iterator[tuple]:
        low, high = min(w["least"] for w in windows), max(w["high"] for w in windows)
        use = np.flatnonzero((score >= low) & (score <= high) & ((labels == label) == same_label) & (ids != own))
        if not len(use):
            return
        use = use[np.lexsort((ids[use], -score[use]))]
        falling = -score[use]
        for w in windows:
            s = np.searchsorted(falling, -w["high"], "left")
            e = min(s + k, np.searchsorted(falling, -w["least"], "right"))
            for j in use[s:e]:
                yield own, w["w"], int(ids[j]), int(score[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, held = None, [], None
        for batch in batches:
            blocks, sides = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(sides) != 0)) + 1
            for s, e in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
                if s == e:
                    continue
                piece = batch.slice(s, e - s)
                ids, labels, x = piece.column(2).to_numpy(), piece.column(3).to_numpy(), matrix_of(piece.column(4))
                if blocks[s] != block:
                    block, parts, held = blocks[s], [], None
                if sides[s] == 0:
                    parts.append((ids, labels, x))
                    continue
                held = held or tuple(map(np.concatenate, zip(*parts, strict=True)))
                all_ids, all_labels, vectors = held
                found = []
                for score, windows, own, label in zip(products(x, vectors), piece.column(5).to_pylist(), ids.tolist(), labels.tolist(), strict=True):
                    found += best(label, own, windows, score, all_ids, all_labels)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["anchor", "w", "id", "score"])

    rows = lists.rows.withColumn("side", F.lit(0)).withColumn("windows", F.lit(None).cast("array<struct<w: long, low: long, high: long, least: long>>"))
    wanted = visited.select("block").distinct()
    both = rows.join(wanted, "block", "left_semi").select("block", "side", "id", "label", "x", "windows").union(visited)
    return both.repartition("block").sortWithinPartitions("block", "side", "id").mapInArrow(run, "anchor long, w long, id long, score long")


def first(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` first of each anchor and window, with their ``rank``."""
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(anchors: DataFrame, lists: Lists, k: int, same_label: bool, waves: tuple[int, ...] = WAVES) -> DataFrame:
    """(anchor, w, id, score, rank): for each anchor (id, label, x, windows) and
    window the ``k`` first rows of the same label, or of others, whose score is from
    the window's low to its high."""
    best, open_, done = None, anchors, 0
    for upto in (*waves, None):
        new = scored(written(visits(open_, lists, done, upto)), lists, k, same_label)
        best = written(first(new if best is None else best.drop("rank").union(new), k))
        if upto is None or upto >= len(lists.radius):
            return best
        full = best.where(F.col("rank") == k).select(F.col("anchor").alias("id"), "w", F.col("score").alias("reached"))
        each = anchors.select("id", F.explode("windows").alias("of")).select("id", "of.*").join(full, ["id", "w"], "left")
        window = F.struct("w", "low", "high", F.coalesce("reached", "low").alias("least"))
        again = each.groupBy("id").agg(F.sort_array(F.collect_list(window)).alias("windows"))  # as many as an anchor has windows
        open_, done = anchors.drop("windows").join(again, "id"), upto
    raise AssertionError("the last wave has no end")


def percent(score: Column, share: int, up: bool) -> Column:
    """share / 100 of a whole score, rounded down or up to a whole number."""
    exact = score.cast("decimal(20,0)") * share / 100
    return (F.ceil(exact) if up else F.floor(exact)).cast("long")


def mine(embeddings: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Hard negatives of the rows for which ``anchor`` holds: (anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score).

    A row's score is its inner product with the anchor, both as whole numbers
    (``whole_vectors``). An anchor's positives are its first rows of the same label;
    a positive's negatives are the first rows of other labels whose score is from
    ``low`` to ``high`` per cent of its own. Higher scores come first, ties by the
    smaller id.

    Rows without id or label, and vectors that are null, empty, of an unusual
    length or with null or non-finite entries take no part. A repeated id counts
    once, by its smallest label and then vector. An anchor without positives, and a
    positive without negatives, gives no row; an empty table gives none. A score
    beyond a long raises an error. Other columns are read by ``anchor`` only.
    """
    marked = embeddings.withColumns({"_anchor": F.coalesce(anchor, F.lit(False))})
    usable = whole_vectors(marked.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull()), vector_col, id_col, label_col, "_anchor")
    plain = usable.toDF("id", "label", "anchor", "x").select(F.col("id").cast("long").alias("id"), F.struct(F.col("label").cast("long").alias("label"), "x", "anchor").alias("row"))
    vectors = written(plain.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.*"))
    lists = build(vectors.select("id", "label", "x"), block_rows)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if lists is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    anchors = vectors.where("anchor").select("id", "label", "x")
    wide = [F.lit(v).cast("long") for v in (0, 1 - (1 << 63), (1 << 63) - 1, 1 - (1 << 63))]
    any_ = F.array(F.struct(*[c.alias(n) for c, n in zip(wide, ("w", "low", "high", "least"), strict=True)]))
    near = search(written(anchors.withColumn("windows", any_)), lists, positives, same_label=True)
    near = written(near.select("anchor", F.col("id").alias("w"), F.col("score").alias("positive_score")))
    low_, high_ = percent(F.col("positive_score"), low, up=True), percent(F.col("positive_score"), high, up=False)
    window = F.struct("w", low_.alias("low"), high_.alias("high"), low_.alias("least"))
    asked = near.where(low_ <= high_).groupBy(F.col("anchor").alias("id")).agg(F.sort_array(F.collect_list(window)).alias("windows"))  # at most ``positives``
    hard = search(written(anchors.join(asked, "id")), lists, negatives, same_label=False)
    return hard.join(near, ["anchor", "w"]).select(
        F.col("anchor").alias("anchor_id"), F.col("w").alias("positive_id"), "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
