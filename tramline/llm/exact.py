"""Exact deduplication as a stream with disk-backed state.

A stream of document files keeps, for each digest of a text without its white
space, how many rows had it, and the identifier, length and content locator of the
one that stays. The state is Spark's streaming aggregate in RocksDB, without a
watermark, so nothing expires; rows are combined before their shuffle, so a group
of any size reaches a task as one row from each other task. A locator is the file
and the row in it. Where a digest has more than one row, the texts themselves are
compared with the text at the locator, and rows that differ (a digest that two
texts share) are grouped by their whole texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import shared_dir
from .common import BLANKS, split_join, written

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "400",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each partition reserves megabytes of disk
}
KEEPER = "struct<chars: int, rank: long, file: string, row: long>"
GROUPS = f"digest binary, n long, keeper {KEEPER}, batch long"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def bare(text: Column) -> Column:
    """A text without its white space; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), " " + BLANKS, "")


def located(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], with_text: bool) -> DataFrame:
    """(id, chars, digest, file, row) of documents read from files; also
    (bare, sha) for ``with_text``. Works on a stream as on a table."""
    place, text = docs.metadataColumn("_metadata"), F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.length(text.cast("string")), F.lit(0)).alias("chars"),
        bare(text).alias("bare"),
        place["file_path"].alias("file"),
        place["row_index"].alias("row"),
    )
    more = ["bare", F.sha2("bare", 256).alias("sha")] if with_text else []
    return rows.select("id", "chars", digest(F.col("bare")).alias("digest"), "file", "row", *more)


def keeper() -> Column:
    """Of the rows of a group the longest, then the smallest id; a null id comes
    last, and the place decides between rows alike in both."""
    return F.max(F.struct("chars", F.bitwise_not("id").alias("rank"), "file", "row")).alias("keeper")


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """While a query starts, its state goes to RocksDB; a query keeps the settings
    that it started with."""
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The Parquet files at ``path``, a file or a folder, as a stream; new files in
    a folder follow. ``maxBytesPerTrigger`` among the options cuts it into batches."""
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"  # a stream takes a single file only by a pattern
    return spark.readStream.schema(spark.read.parquet(path).schema).options(**options).parquet(pattern)


def start(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, trigger: dict | None = None) -> StreamingQuery:
    """Starts to deduplicate a stream of document files into ``folder``.

    Each batch writes the digests that it touched, with their counts so far and
    the row that stays so far; a batch that is run again overwrites its own. After
    a stop the same call goes on from the checkpoint in ``folder``.
    """
    state = located(docs, id_col, text_col, digest, with_text=False).groupBy("digest").agg(F.count("*").alias("n"), keeper())

    def note(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/groups/batch={number}")

    with state_on_disk(docs.sparkSession):
        return state.writeStream.outputMode("update").foreachBatch(note).option("checkpointLocation", f"{folder}/state").trigger(**(trigger or {"availableNow": True})).start()


def groups(spark: SparkSession, folder: str) -> DataFrame:
    """(digest, n, keeper): the last that the stream wrote for each digest."""
    nothing = spark.createDataFrame([], GROUPS).drop("batch")
    nothing.write.mode("overwrite").parquet(f"{folder}/groups/batch=-1")  # the stream may not have had a batch yet
    all_ = spark.read.schema(GROUPS).parquet(f"{folder}/groups")
    return all_.groupBy("digest").agg(F.max(F.struct("n", "keeper")).alias("last")).select("digest", "last.n", "last.keeper")


def resolved(docs: DataFrame, state: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """What the state says of each row of ``docs``, the files that the stream has
    read: (id_col, keep_id, group_size, kept, text_sha256).

    Every row whose digest has others is compared byte by byte with the text at
    the group's locator; groups with a difference are taken apart by whole texts.
    """
    here = (F.col("file") == F.col("keeper.file")) & (F.col("row") == F.col("keeper.row"))
    state = written(state)
    rows = split_join(located(docs, id_col, text_col, digest, with_text=True), state, "digest", state.select("digest", "n"), F.struct("file", "row"))
    rows = written(rows.withColumn("bare", F.when(F.col("n") > 1, F.col("bare"))))
    hits = rows.where("n > 1")
    first = hits.where(here).select("digest", F.col("bare").alias("first"))
    held = split_join(hits.where(~here).select("digest", "bare", "file", "row"), first, "digest", state.where("n > 1").select("digest", "n"), F.struct("file", "row"))
    differing = written(held.where("bare <> first").select("digest").distinct())
    if not differing.isEmpty():
        shared = rows.join(differing, "digest", "left_semi")
        apart = shared.groupBy("digest", "bare").agg(F.count("*").alias("n"), keeper())
        regrouped = shared.drop("n", "keeper").join(apart, ["digest", "bare"])
        rows = rows.join(differing, "digest", "left_anti").unionByName(regrouped)
    return rows.select(F.col("id").alias(id_col), F.bitwise_not("keeper.rank").alias("keep_id"), F.col("n").alias("group_size"), here.alias("kept"), F.col("sha").alias("text_sha256"))


def dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, **options: str) -> DataFrame:
    """One row for each row of the Parquet files at ``path``: (id_col, keep_id,
    group_size, kept, text_sha256).

    Texts are equal when they are identical without white space (space and \\x09 to
    \\x0D); a null text counts as empty, and empty texts are equal to each other. Of
    equal texts the row with the most code points stays, then the smallest id; a
    null id comes after all others, and of rows repeated under one id exactly one is
    ``kept``. Whole texts are read, whatever their length; an empty table gives no
    rows; other columns are not read, whatever their names.
    """
    folder = shared_dir(spark)
    start(stream(spark, path, **options), folder, id_col, text_col, digest).awaitTermination()
    return resolved(spark.read.parquet(path), groups(spark, folder), id_col, text_col, digest)
