"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is one or more 64-bit words. Each word is cut into two halves of
sixteen 2-bit segments; the bit counts of the segments (0, 1 or 2) embed each
half as a lattice point. The Manhattan distance of two points never exceeds the
Hamming distance of their halves. Every distinct fingerprint registers in the
grid cells within distance one of its point in every half: two points within
distance two then share a cell (the range join), and each pair that shares a
cell is verified on the exact bits. Fingerprints of one word that differ in at
most four bits lie within distance two in at least one half, so none is missed;
with more words and shorter pieces, wider distances are found with a probability
(figures in the README), and links are verified on the texts' shingles themselves.

Copies never meet as pairs, for only distinct fingerprints enter the grid. A
cell's verified links leave as a spanning forest of the cell, closest links first,
which keeps the connectivity and is never larger than the cell. A cell too large for one task is
cut again: by the pieces of the other half, one of which two fingerprints within
the distance have in common, or, where fingerprints have several words, by pairs
of blocks of the cell. No partner is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import components, split_join, without, written
from .substrings import mixed

#: Most bits in which linked fingerprints of one word differ. The two halves and
#: the cells within distance one cover this distance exactly.
DISTANCE = 4
#: Rows of cells that a task compares at once; a larger cell is cut again.
AT_ONCE = 40_000
#: Segments of a piece: half a word. Two fingerprints of one word within DISTANCE
#: are within Manhattan distance two in at least one.
HALF = 16
#: Of the wider fingerprints that find less similar texts: words of 64 bits,
#: segments of a piece, and words of a shingle.
WIDE, WIDE_PIECE, WIDE_SHINGLE = 3, 12, 5
LOWER = bytes(range(256)).translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))


def shingles(text: str | None, shingle: int = 4, seed: int = 42) -> np.ndarray:
    """The 64-bit hashes of a text's shingles, repeats included: A-Z lower-cased,
    words runs of anything but ASCII white space; with fewer words than a shingle,
    of the whole sequence; of no words: none."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    flat = b" ".join(found)
    if len(found) <= shingle:
        return np.array([xxh64_intdigest(flat, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(found) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.array([xxh64_intdigest(flat[s:e], seed) for s, e in spans], np.uint64)


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42, words: int = 1) -> np.ndarray:
    """The unsigned SimHash of one text, in 64-bit ``words``: a bit is 1 if set in
    over half the hashes of its ``shingles``; null or no words: zero. Further 64-bit
    words are made of rehashed shingles.
    """
    h = shingles(text, shingle, seed)
    out = np.zeros(words, np.uint64)
    for k in range(words if len(h) else 0):
        counts = np.zeros(64, np.int64)
        for part in range(0, len(h), 1 << 16):
            some = h[part : part + (1 << 16)]
            bits = np.unpackbits((mixed(some, k) if k else some).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int32)
        out[k] = np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0]
    return out


def names(prints: np.ndarray) -> np.ndarray:
    """A 64-bit name of each fingerprint: itself, or a hash of its words."""
    out = prints[:, 0]
    for k in range(1, prints.shape[1]):
        out = mixed(out, k) ^ prints[:, k]
    return out if prints.shape[1] == 1 else mixed(out, 0)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42, words: int = 1) -> DataFrame:
    """(id_col, hash, name, w0, ...): the fingerprint of each row, as signed longs,
    and a hash of its text.

    One narrow pass over whole texts; other columns of ``docs`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle, seed, words) for t in batch.column(2).to_pylist()], np.uint64).reshape(-1, words)
            columns = [names(prints), *prints.T]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in columns)], [id_col, "hash", "name", *(f"w{k}" for k in range(words))])

    return told_apart(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` long, hash long, name long, " + ", ".join(f"w{k} long" for k in range(words)))


def told_apart(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, hash, text_col): each row with a hash of its text, nulls as empty."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias(id_col), F.xxhash64(F.coalesce(text, F.lit(""))).alias("hash"), text.alias(text_col))


def segments_of(prints: np.ndarray) -> np.ndarray:
    """The bit counts (0, 1 or 2) of all 2-bit segments, the lowest first."""
    low = np.uint64(0x5555555555555555)
    counts = (prints & low) + ((prints >> np.uint64(1)) & low)
    return np.concatenate([(counts[:, k, None] >> np.arange(0, 64, 2, dtype=np.uint64)) & np.uint64(3) for k in range(prints.shape[1])], axis=1)


def pieces(words: int, length: int) -> list[tuple[int, int]]:
    """Where the pieces of about ``length`` segments begin and end."""
    cuts = np.linspace(0, 32 * words, max(1, round(32 * words / length)) + 1).round().astype(int).tolist()
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def packed(segments: np.ndarray) -> np.ndarray:
    """The point of a piece, two bits for each segment."""
    return (segments << np.arange(0, 2 * segments.shape[1], 2, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def cells_of(prints: np.ndarray, length: int = HALF) -> tuple[np.ndarray, np.ndarray]:
    """(cell, index into ``prints``) of all cells that fingerprints register in.
    The piece is in the upper 32 bits of a cell, its point below."""
    cells, owners = [], []
    every, segments = np.arange(len(prints)), segments_of(prints)
    for number, (start, end) in enumerate(pieces(prints.shape[1], length)):
        name, values = np.uint64(number) << np.uint64(32), segments[:, start:end]
        point = packed(values)
        cells.append(point | name)
        owners.append(every)
        for k in range(end - start):
            one, value = np.uint64(1) << np.uint64(2 * k), values[:, k]
            for allowed, moved in ((value < 2, point + one), (value > 0, point - one)):
                cells.append(moved[allowed] | name)
                owners.append(every[allowed])
    return np.concatenate(cells), np.concatenate(owners)


def forest(cells: np.ndarray, prints: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) of links that span what is linked within each cell; ``cells``
    is sorted. Closer pairs link first, in steps of the distance. All pairs of a
    cell are compared, unless the cell is already in one piece."""
    root = np.arange(len(cells))
    links: list[tuple[np.ndarray, np.ndarray]] = []

    def join(a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> None:
        order = np.argsort(apart, kind="stable")
        a, b = a[order], b[order]
        while True:
            ra, rb = root[a], root[b]
            open_ = ra != rb
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            if not len(a):
                return
            high, one = np.unique(np.maximum(ra, rb), return_index=True)  # each root that goes, by its closest link
            links.append((a[one], b[one]))
            root[high] = np.minimum(ra, rb)[one]
            while not np.array_equal(up := root[root], root):
                root[:] = up

    words = [np.ascontiguousarray(w) for w in prints.T]
    for most in sorted({distance} if distance <= DISTANCE else {distance // 2, 3 * distance // 4, distance}):
        at, shift, waiting, held = np.arange(len(cells)), 1, [], 0
        while len(at):
            at = at[at + shift < len(cells)]
            at = at[cells[at] == cells[at + shift]]
            apart = sum(np.bitwise_count(w[at] ^ w[at + shift]).astype(np.int16) for w in words)
            close = apart <= most
            near = at[close]
            waiting.append((near, near + shift, apart[close]))
            held += len(near)
            if held > 1_000_000 or shift % 64 == 0 or not len(at):
                join(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
                waiting, held = [], 0
                if len(at):  # cells in one piece are done
                    first = np.searchsorted(cells, cells[at], "left")
                    whole = np.logical_and.reduceat(root == np.searchsorted(cells, cells, "left"), np.unique(first))
                    at = at[~whole[np.searchsorted(np.unique(first), first)]] if len(whole) else at
            shift += 1
    if not links:
        return np.zeros(0, int), np.zeros(0, int)
    return tuple(np.concatenate(x) for x in zip(*links, strict=True))


def points_of(cells: np.ndarray, prints: np.ndarray, length: int = HALF) -> np.ndarray:
    """The point of each print in the piece of its cell, and in the last bit
    whether the cell is the point's own."""
    number, segments = (cells >> np.uint64(32)).astype(int), segments_of(prints)
    point = np.zeros(len(cells), np.uint64)
    for k, (start, end) in enumerate(pieces(prints.shape[1], length)):
        own = number == k
        point[own] = packed(segments[own, start:end])
    return point << np.uint64(1) | (point == cells & np.uint64(0xFFFFFFFF)).astype(np.uint64)


def pieces_of(cells: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, index) of the further cut of large cells of one-word fingerprints:
    the half that the cell is not of, in ``distance`` + 1 pieces. Two prints
    within the distance have at least one piece in common."""
    half = cells >> np.uint64(32)
    other = (prints[:, 0] >> np.where(half == 0, np.uint64(32), np.uint64(0))) & np.uint64(0xFFFFFFFF)
    cuts = np.linspace(0, 32, distance + 2).astype(int)
    keys = [mixed(mixed(cells, 1 + k) ^ (other >> np.uint64(s)) & np.uint64((1 << (e - s)) - 1), k) for k, (s, e) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))]
    return np.concatenate(keys), np.tile(np.arange(len(cells)), len(keys))


def links(distinct: DataFrame, distance: int = DISTANCE, at_once: int = AT_ONCE, length: int = HALF) -> DataFrame:
    """(a, b): links by name that connect the ``distinct`` fingerprints, one
    column for each word, that share a cell and differ in ``distance`` bits or
    less."""
    words = len(distinct.columns)
    columns = [f"w{k}" for k in range(words)]
    schema = ", ".join(f"{c} long" for c in columns)
    signed = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """(keys, prints) of rows of a key and the words; keys sort as signed."""
        values = [c.to_numpy(zero_copy_only=False) for c in batch.columns[: words + 1]]
        return values[0], np.stack(values[1:], axis=1).view(np.uint64)

    def rows(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([signed(keys), *map(signed, prints.T)], ["cell", *columns])

    def register(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.stack([c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns], axis=1)
            for s in range(0, len(prints), 4_096):
                cells, owners = cells_of(prints[s : s + 4_096], length)
                yield rows(cells, prints[s : s + 4_096][owners])

    def found(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        a, b = forest(keys, prints, distance)
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([signed(names(prints[a])), signed(names(prints[b])), none, *[none] * words, none, none], ["a", "b", "cell", *columns, "block", "point"])

    def put_off(keys: np.ndarray, prints: np.ndarray, block: int) -> pa.RecordBatch:
        none = pa.nulls(len(keys), pa.int64())
        points = points_of(keys.view(np.uint64), prints, length)
        return pa.RecordBatch.from_arrays([none, none, signed(keys), *map(signed, prints.T), pa.array(np.full(len(keys), block, np.int64)), signed(points)], ["a", "b", "cell", *columns, "block", "point"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of sorted cells; a cell of ``at_once`` rows or more is put off,
        in blocks of about so many rows."""
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        n, hot, block = 0, None, 0

        def settle(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
            tail = int(np.searchsorted(keys, hot, "right")) if hot is not None else 0
            if tail:
                yield put_off(keys[:tail], prints[:tail], block)
            if tail < len(keys):
                yield found(keys[tail:], prints[tail:])

        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(read(batch))
            n += batch.num_rows
            if n < at_once:
                continue
            keys, prints = (np.concatenate(x) for x in zip(*waiting, strict=True))
            last = int(np.searchsorted(keys, keys[-1], "left"))
            if last:
                yield from settle(keys[:last], prints[:last])
            if len(keys) - last >= at_once:
                block = block + 1 if hot is not None and keys[-1] == hot else 0
                hot = keys[-1]
                yield put_off(keys[last:], prints[last:], block)
                waiting, n = [], 0
            else:
                if hot is not None and keys[-1] != hot:
                    hot, block = None, 0
                waiting, n = [(keys[last:], prints[last:])], len(keys) - last
        if n:
            keys, prints = (np.concatenate(x) for x in zip(*waiting, strict=True))
            block += 1
            yield from settle(keys, prints)

    def compared(keys: np.ndarray, prints: np.ndarray, points: np.ndarray) -> pa.RecordBatch:
        """Links of parts. Where all of a part are of one point, only the part
        in the point's own cell is compared, not those around it."""
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        mixed_ = np.maximum.reduceat(points, starts) != np.minimum.reduceat(points, starts)
        use = np.repeat(mixed_ | (points[starts] & 1 == 1), np.diff(np.append(starts, len(keys))))
        return found(keys[use], prints[use]).select(["a", "b"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of the parts of large cells, each part whole."""
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n, limit = 0, at_once
        for batch in (b for b in batches if b.num_rows):
            waiting.append((*read(batch), batch.column(words + 1).to_numpy(zero_copy_only=False)))
            n += batch.num_rows
            if n < limit:
                continue
            keys, prints, points = (np.concatenate(x) for x in zip(*waiting, strict=True))
            last = int(np.searchsorted(keys, keys[-1], "left"))
            if last:
                yield compared(keys[:last], prints[:last], points[:last])
            waiting, n = [(keys[last:], prints[last:], points[last:])], len(keys) - last
            limit = max(at_once, 2 * n)  # a part that goes on is joined seldom, not for each batch
        if n:
            yield compared(*(np.concatenate(x) for x in zip(*waiting, strict=True)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, prints = read(batch)
            for s in range(0, len(keys), 4_096):
                parts, owners = pieces_of(keys[s : s + 4_096].view(np.uint64), prints[s : s + 4_096], distance)
                some = rows(parts, prints[s : s + 4_096][owners])
                yield pa.RecordBatch.from_arrays([*some.columns, batch.column(words + 1).slice(s, 4_096).take(pa.array(owners))], ["cell", *columns, "point"])

    cells = distinct.toDF(*columns).mapInArrow(register, f"cell long, {schema}")
    by_cell = cells.repartition("cell").sortWithinPartitions("cell", *columns)
    out = written(by_cell.mapInArrow(verify, f"a long, b long, cell long, {schema}, block long, point long"))
    large = out.where("cell is not null")
    if words == 1:
        parts = large.select("cell", *columns, "point").mapInArrow(cut, f"cell long, {schema}, point long")
    else:
        blocks = large.groupBy("cell").agg(F.max("block").alias("_last"))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last")))
        paired = large.join(blocks, "cell").withColumn("_other", other)
        pair = F.xxhash64("cell", F.least("block", "_other"), F.greatest("block", "_other"))
        parts = paired.select(pair.alias("cell"), *columns, "point")
    more = parts.repartition("cell").sortWithinPartitions("cell", *columns).mapInArrow(again, "a long, b long")
    return out.where("cell is null").select("a", "b").union(more)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42, words: int = 1, distance: int = DISTANCE) -> DataFrame:
    """Per row of ``docs``: (id_col, fingerprint, component_id).

    ``fingerprint`` is sixteen lower-case hex digits for each word.
    ``component_id`` is the smallest id among the rows that links of at most
    ``distance`` bits reach, the row's own included. Empty and null texts have
    fingerprint zero and are linked like any other; a null id is never the
    smallest (a group of null ids alone has a null component); repeated rows
    each give a row; texts of any length count whole; an empty table gives
    none; other columns are not read.
    """
    columns = [f"w{k}" for k in range(words)]
    marked = written(fingerprints(docs, id_col, text_col, shingle, seed, words).drop("hash"))
    groups = marked.groupBy("name").agg(F.min(id_col).alias("first"), F.count("*").alias("n"), *[F.min(c).alias(c) for c in columns])
    groups = written(groups)
    found = components(links(groups.select(*columns), distance)).toDF("name", "component")
    named = groups.join(found, "name", "left").withColumn("component", F.coalesce("component", "name"))
    named = written(named.select("name", "component", "first"))
    smallest = written(named.groupBy("component").agg(F.min("first").alias("component_id"), F.count("*").alias("n")))
    ids = split_join(named.select("name", "component"), smallest.select("component", "component_id"), "component", smallest.select("component", "n"), F.col("name"))
    out = split_join(marked, ids.select("name", "component_id"), "name", groups.select("name", "n"), F.monotonically_increasing_id())
    hexed = F.concat(*[F.lower(F.lpad(F.hex(c), 16, "0")) for c in columns]).alias("fingerprint")
    return out.select(id_col, hexed, "component_id")


def distance_at(similarity: float, words: int) -> int:
    """Bits in which hardly any texts with this Jaccard similarity of shingles
    differ more: the mean and two and a half deviations."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(64 * words * share + 2.5 * math.sqrt(64 * words * share * (1 - share)))


def verified(docs: DataFrame, texts: DataFrame, pairs: DataFrame, similarity: float, id_col: str, text_col: str, shingle: int, seed: int = 42) -> DataFrame:
    """The ``pairs`` (a, b) of text hashes whose sets of shingles have the
    similarity. ``texts``: (hash, first), an id under which each text is found."""
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    ends = pairs.select(F.explode(F.array("a", "b")).alias("hash")).distinct()
    wanted = texts.join(ends, "hash", "left_semi").select(F.col("first").alias(id_col), "hash")
    found = told_apart(docs, id_col, text_col).where(F.col(id_col).isNotNull()).join(wanted, [id_col, "hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingles(t, shingle, seed)).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["hash", "shingles"])

    sets = written(found.select("hash", text_col).mapInArrow(run, "hash long, shingles array<long>").dropDuplicates(["hash"]))  # rows repeated under one id
    both = pairs
    for end, other in (("a", "b"), ("b", "a")):
        counts = pairs.groupBy(end).agg(F.count("*").alias("n"))
        both = split_join(both, sets.toDF(end, f"of_{end}"), end, counts, F.col(other))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    every = F.size("of_a") + F.size("of_b") - shared
    return both.where(shared * 1_000 >= every * round(similarity * 1_000)).select("a", "b")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, shingle: int = WIDE_SHINGLE, words: int = WIDE) -> DataFrame:
    """Per row of ``docs`` with an id: (id_col, component_id), the smallest id that
    links between texts with a Jaccard similarity of shingle sets of at least
    ``similarity`` reach.

    Fingerprints only bring texts together; each link is verified on the texts, so
    there is none below the similarity. Texts of one fingerprint are compared with
    one of them, those of a cell along a tree of its closest pairs. Equal texts are
    told by a 64-bit hash.
    """
    marked = written(fingerprints(docs, id_col, text_col, shingle, words=words).where(F.col(id_col).isNotNull()))
    columns = [f"w{k}" for k in range(words)]
    texts = written(marked.groupBy("hash").agg(F.min(id_col).alias("first"), F.min("name").alias("name"), F.count("*").alias("n")))
    prints = written(marked.groupBy("name").agg(*[F.min(c).alias(c) for c in columns]))
    heads = written(texts.groupBy("name").agg(F.min(F.struct("first", "hash")).alias("head"), F.count("*").alias("n")).select("name", F.col("head.hash").alias("head"), "n"))
    close = links(prints.select(*columns), distance_at(similarity, words), length=WIDE_PIECE)
    between = close.join(heads.select(F.col("name").alias("a"), F.col("head").alias("_a")), "a").join(heads.select(F.col("name").alias("b"), F.col("head").alias("_b")), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    within = split_join(texts.select("name", "hash"), heads.select("name", "head"), "name", heads.select("name", "n"), F.col("hash")).where("hash <> head").select(F.col("head").alias("a"), F.col("hash").alias("b"))
    found = components(verified(docs, texts, between.union(within), similarity, id_col, text_col, shingle)).toDF("hash", "component")
    named = written(texts.join(found, "hash", "left").withColumn("component", F.coalesce("component", "hash")))
    smallest = written(named.groupBy("component").agg(F.min("first").alias("component_id"), F.count("*").alias("n")))
    of_text = split_join(named.select("hash", "component"), smallest.select("component", "component_id"), "component", smallest.select("component", "n"), F.col("hash"))
    out = split_join(marked.select(id_col, "hash"), of_text.select("hash", "component_id"), "hash", texts.select("hash", "n"), F.monotonically_increasing_id())
    return out.select(id_col, "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, shingle: int = WIDE_SHINGLE, words: int = WIDE) -> DataFrame:
    """The rows of ``docs`` that carry the smallest id of their group of texts
    with a Jaccard similarity of shingles of ``similarity`` or more.

    All columns stay. Rows with a null id cannot be told apart and stay;
    rows repeated under one id count as one document and stay together; empty
    and null texts are copies of each other.
    """
    found = similar_groups(docs, id_col, text_col, similarity, shingle, words)
    return without(docs, found.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct(), id_col)
