"""One row of a group, without windows: struct minima and maxima aggregate
partially before the shuffle, so a hot key costs one row for each task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each group; ``order`` must be unique within a group."""
    return _one(df, keys, order, F.min)


def last_of(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ("_ord",)) -> DataFrame:
    """The last row of each group."""
    return _one(df, keys, order, F.max)


def _one(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], pick) -> DataFrame:
    ranks = [(F.col(c) if isinstance(c, str) else c).alias(f"_k{n}") for n, c in enumerate(order)]
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(pick(F.struct(*ranks, F.struct(*rest).alias("_row"))).alias("_x"))
    return picked.select(*keys, *[F.col(f"_x._row.`{c}`").alias(c) for c in rest])


def best(df: DataFrame, score: Column, keys: Sequence[str] = (), order: str = "_ord") -> DataFrame:
    """The row with the greatest positive score, of each group; the first in
    ``order`` on ties. No row where no score is positive."""
    scored = df.withColumn("_score", score.cast("double")).where("_score > 0")
    if not keys:
        return scored.orderBy(F.desc("_score"), order).limit(1).drop("_score")
    return first_of(scored, keys, [-F.col("_score"), order]).drop("_score")
