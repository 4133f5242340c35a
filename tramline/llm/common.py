"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: The white space that separates words: \x20 and \x09 to \x0D, nothing else.
BLANKS = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the standard tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null text: none."""
    flat = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(flat, " "), "")


#: Folders that ``written`` made while ``settled`` runs.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage, and what was computed once survives a lost executor.
    """
    spark, schema, path = df.sparkSession, df.schema, shared_dir(df.sparkSession)
    if (made := _MADE.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def settled(make: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
    """What ``make`` gives, written and read again, and its folder; the folders
    that it needed on the way are removed, as nothing refers to them any more."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        out = written(make())
    finally:
        _MADE.reset(token)
    removed(out.sparkSession, *made[:-1])
    return out, made[-1]


def removed(spark: SparkSession, *paths: str) -> None:
    """Removes folders that ``written`` made."""
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Keys that are broadcast at most, and rows of one key that a task gets at most.
HEAVY_KEYS, TASK_ROWS = 1_000, 1_000_000


def split_join(many: DataFrame, one: DataFrame, key: str, counts: DataFrame, spread: Column, how: str = "inner") -> DataFrame:
    """``many`` joined (``how``: inner or left) with ``one``, which holds each ``key`` once.

    ``counts``: (key, n), how many rows of ``many`` have each key. A key with
    more than 1 / HEAVY_KEYS of all rows, or more than TASK_ROWS, is dealt by
    ``spread`` over as many salts as it has such shares, and its row of ``one`` is
    repeated for each. A list of up to HEAVY_KEYS such keys is broadcast, a longer
    one joined.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).head()["n"]
    share = max(1, min(total // HEAVY_KEYS, TASK_ROWS))
    heavy = counts.where(F.col("n") > share).select(key, F.ceil(F.col("n") / share).cast("int").alias("_salts"))
    if total // share <= HEAVY_KEYS + 1 or heavy.count() <= HEAVY_KEYS:  # a key has more than a share, so they are fewer
        heavy = F.broadcast(heavy)
    salts = F.coalesce("_salts", F.lit(1))
    left = many.join(heavy, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), salts).cast("int")).drop("_salts")
    right = one.join(heavy, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def without(docs: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is not in the one column of ``gone``, all
    columns unchanged, of whatever names; rows without an id stay.

    ``gone`` grows with the corpus, so it is never broadcast: one plan at every
    size. Rows without an id have keys of their own, so that they do not meet in
    one task.
    """
    both = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("_id"))
    both = both.withColumn("_spread", F.when(F.col("_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0)))
    keys = gone.toDF("_id").withColumn("_spread", F.lit(0).cast("long"))
    left = both.join(keys.hint("merge"), ["_id", "_spread"], "left_anti")
    return left.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph: (node, component).

    ``edges`` has two long columns, ``a`` and ``b``. The component is the
    smallest node reachable; every node of an edge gets a row, self loops
    included; nodes without edges are the caller's. Null ends are dropped.

    Each round points every node at its smallest neighbour, follows the
    pointers to their ends' ends and contracts the graph, so the edges at
    least halve. Only aggregates and equi-joins; no adjacency list is built,
    and each round's tables are written to the shared folder.
    """
    edges = written(edges.where("a is not null and b is not null"))
    labels = written(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")))
    links = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    for _ in range(most_rounds):
        if links.isEmpty():
            return labels
        both = links.select("a", "b").union(links.select("b", "a")).toDF("node", "other")
        step = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("to"))
        step = written(step)
        for _ in range(2):
            onward = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
            step = step.join(onward, "to").select("node", F.col("next").alias("to"))
        step = written(step)
        labels = written(labels.join(step.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("to", "component").alias("component")))
        left, right = step.toDF("a", "a2"), step.toDF("b", "b2")
        moved = links.join(left, "a").join(right, "b").where("a2 <> b2")
        links = written(moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct())
    raise RuntimeError(f"components not found in {most_rounds} rounds")
