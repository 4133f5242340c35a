"""GTFS bundles: a zip or a folder of CSV files to typed tables.

A member of an archive is unpacked by a task of its own, as it cannot be split, row
by row into a written table of cells; a folder of unpacked tables is read by Spark.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator, Sequence
from itertools import islice
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.feed import Feed
from ..schemas import GTFS, OPT_IN, columns
from ..session import shared_dir
from . import files
from .split_xml import dealt

KINDS = {"s": fn.text, "i": fn.whole_number, "f": fn.real_number, "b": fn.flag, "t": fn.gtfs_time, "d": fn.gtfs_date}


def wanted_tables(optional: Sequence[str] = (), exclude: Sequence[str] = ()) -> list[str]:
    """Tables to load: the opt-in ones by name; exclusion wins."""
    return [t for t in GTFS if t not in exclude and (t not in OPT_IN or t in optional)]


def typed(raw: DataFrame, table: str) -> DataFrame:
    """The table's columns of a frame of strings: found by trimmed header, the
    last of equal headers; absent ones give zero values."""
    place = {name.strip().lstrip("﻿"): k for k, name in enumerate(raw.columns) if name != "_ord"}
    flat = raw.toDF(*[f"c{k}" if name != "_ord" else "_ord" for k, name in enumerate(raw.columns)])
    cell = lambda name: F.col(f"c{place[name]}") if name in place else F.lit("")
    out: list[Column] = [KINDS[kind](cell(name)).alias(name) for name, kind in columns(table)]
    return flat.select(*out, "_ord")


def records(member: IO[bytes]) -> Iterator[list[str]]:
    """Rows of a CSV file as it is read; bare quotes are allowed, ragged rows
    are not."""
    rows = csv.reader(io.TextIOWrapper(member, "utf-8-sig", newline=""), strict=False)
    header = next(rows, None)
    if header is None:
        raise ValueError("a table without a header")
    yield header
    for n, row in enumerate(rows, 2):
        if not row:
            continue
        if len(row) != len(header):
            raise ValueError(f"row {n} has {len(row)} fields, the header {len(header)}")
        yield row


def read_zip(spark: SparkSession, path: str, optional: Sequence[str] = (), exclude: Sequence[str] = ()) -> Feed:
    """A feed from one or more archives; only members at the root count, a
    missing table gives no table, a bad one fails the load.

    The archives' directories are read first; then each wanted member is a task,
    which reads that member's bytes alone, as they are unpacked. The cells are
    written to the shared folder once; no archive is held or shuffled."""
    tables = wanted_tables(optional, exclude)
    found = files.members(files.listed(spark, path)).where(F.col("member").isin(*[f"{t}.txt" for t in tables]))
    folder = shared_dir(spark)
    found.write.parquet(f"{folder}/members")
    found = spark.read.schema(found.schema).parquet(f"{folder}/members")
    each = dealt(found, found.count())

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, member in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                table = member.removesuffix(".txt")
                with files.opened(name) as file, zipfile.ZipFile(file) as z, z.open(member) as held:
                    rows = records(held)
                    header, at = next(rows), 0
                    while part := list(islice(rows, 10_000)):
                        yield batch_of(name, table, header, part, at)
                        at += len(part)
                    if at == 0:
                        yield batch_of(name, table, header, [], 0)

    folder = f"{folder}/cells"
    schema = "file string, table string, n long, cells array<string>"
    each.mapInArrow(unpack, schema).write.partitionBy("table").parquet(folder)
    cells = spark.read.schema(schema).parquet(folder)
    out = {}
    for row in cells.select("table").distinct().collect():  # one for each table
        own = cells.where(F.col("table") == row["table"])
        pick = lambda k: F.coalesce(F.get("cells", F.lit(k)), F.lit(""))
        out[row["table"]] = own.where("n >= 0").select(*[KINDS[kind](pick(k)).alias(name) for k, (name, kind) in enumerate(columns(row["table"]))], F.struct("file", "n").alias("_ord"))
    return Feed(**out)


def batch_of(file: str, table: str, header: list[str], rows: list[list[str]], at: int) -> pa.RecordBatch:
    """Rows as (file, table, n, cells), the cells in the order of the table's columns by
    this archive's own header, null where it has no such column; a table without rows is
    a row numbered -1. Of equal headers the last counts."""
    seen = {h.strip(): k for k, h in enumerate(header)}
    n, places = max(1, len(rows)), [seen.get(name) for name, _ in columns(table)]
    numbers = pa.array(range(at, at + n) if rows else [-1], pa.int64())
    cells = [None if k is None else row[k].strip() for row in rows for k in places] if rows else [None] * len(places)
    offsets = pa.array(range(0, len(cells) + 1, len(places)), pa.int32())
    constant = lambda text: pa.repeat(pa.scalar(text, pa.string()), n)
    return pa.RecordBatch.from_arrays([constant(file), constant(table), numbers, pa.ListArray.from_arrays(offsets, pa.array(cells, pa.string()))], ["file", "table", "n", "cells"])


def read_folder(spark: SparkSession, path: str, optional: Sequence[str] = (), exclude: Sequence[str] = (), split: Sequence[str] = ()) -> Feed:
    """A feed from a folder of unpacked tables, each a file or a folder of files
    with one header. Ragged rows fail the load. ``_ord`` follows the place.

    A file is one task, since a quoted cell may hold a line break; tables named
    in ``split``, which hold none, are split into many.
    """
    out = {}
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for table in wanted_tables(optional, exclude):
        file = f"{path.rstrip('/')}/{table}.txt"
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(file)):
            continue
        header = spark.read.text(file).limit(1).first()
        if header is None:
            raise ValueError(f"{table} has no header")
        names = next(csv.reader([header[0].lstrip("\ufeff")]))
        schema = ", ".join(f"c{k} string" for k in range(len(names)))
        raw = spark.read.csv(file, schema=schema, header=True, enforceSchema=True, escape='"', multiLine=table not in split, mode="FAILFAST", ignoreLeadingWhiteSpace=False)
        raw = raw.withColumn("_ord", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")))
        out[table] = typed(raw.toDF(*names, "_ord"), table)
    return Feed(**out)
