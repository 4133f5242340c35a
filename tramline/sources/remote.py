"""Inputs from elsewhere: feed lists, schedules, FTP, dated files, payloads."""

from __future__ import annotations

import base64
import gzip
import re
from datetime import date, datetime, timedelta
from ftplib import FTP
from pathlib import PurePosixPath
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from . import files

#: Marks a payload that is compressed.
COMPRESSED = "gzip+base64"
FEED_KEYS = ("endpoint", "provider", "cron", "format", "protocol")


def load_config(text: str, section: str = "feeds", required: tuple[str, ...] = FEED_KEYS) -> list[dict]:
    """The entries of a YAML list; at least one, each with the required keys."""
    import yaml

    entries = (yaml.safe_load(text) or {}).get(section) or []
    if not entries:
        raise ValueError(f"no {section}")
    for k, entry in enumerate(entries):
        if missing := [x for x in required if not entry.get(x)]:
            raise ValueError(f"{section}[{k}] lacks {', '.join(missing)}")
    return entries


#: Fields of a schedule with their ranges; month and weekday names are legal.
CRON = (("second", 0, 59), ("minute", 0, 59), ("hour", 0, 23), ("day", 1, 31), ("month", 1, 12), ("weekday", 0, 6))
NAMES = {n: k for k, n in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)} | {n: k for k, n in enumerate("sun mon tue wed thu fri sat".split())}


def cron_fields(cron: str) -> list[frozenset[int]]:
    """The values of each field of a six-field schedule: ``*``, ``?``, numbers,
    names, ranges, steps and lists. Anything else is refused."""
    parts = cron.split()
    if len(parts) != len(CRON):
        raise ValueError(f"{cron!r} has {len(parts)} fields, not {len(CRON)}")
    out = []
    for part, (name, low, high) in zip(parts, CRON, strict=True):
        values: set[int] = set()
        for item in part.lower().split(","):
            m = re.fullmatch(r"(\*|\?|(\w+)(?:-(\w+))?)(?:/(\d+))?", item)
            if not m:
                raise ValueError(f"{item!r} is no {name}")
            number = lambda x: NAMES[x] if x in NAMES else int(x)
            try:
                first = low if m[2] is None else number(m[2])
                last = high if m[2] is None or m[3] is None and m[4] else number(m[3] or m[2])
            except ValueError:
                raise ValueError(f"{item!r} is no {name}") from None
            if name == "weekday" and last == 7:  # a second name of Sunday
                values.add(0)
                first, last = (first, 6) if first < 7 else (0, 0)
            if not low <= first <= last <= high or m[4] == "0":
                raise ValueError(f"{item!r} is out of range for {name}")
            values.update(range(first, last + 1, int(m[4] or 1)))
        out.append(frozenset(values))
    return out


def next_run(cron: str, after: datetime) -> datetime:
    """The first time after ``after`` at which a schedule runs. Where both day
    and weekday are restricted either of them is enough."""
    second, minute, hour, day, month, weekday = cron_fields(cron)
    stars = [p[0] in "*?" for p in cron.split()]
    at = after.replace(microsecond=0) + timedelta(seconds=1)
    last = after + timedelta(days=366 * 8)
    while at <= last:
        in_day, in_week = at.day in day, (at.weekday() + 1) % 7 in weekday
        if at.month not in month or not (in_day and in_week if stars[3] or stars[5] else in_day or in_week):
            at = at.replace(hour=0, minute=0, second=0) + timedelta(days=1)
        elif at.hour not in hour:
            at = at.replace(minute=0, second=0) + timedelta(hours=1)
        elif at.minute not in minute:
            at = at.replace(second=0) + timedelta(minutes=1)
        elif at.second not in second:
            at += timedelta(seconds=1)
        else:
            return at
    raise ValueError(f"{cron!r} never runs")


def seconds_between(cron: str) -> int:
    """The interval of a schedule that runs at equal intervals within a day, as a
    streaming trigger needs; another is refused, and for ``next_run``."""
    start = datetime(2024, 1, 1) - timedelta(seconds=1)
    times = [start]
    while len(times) < 4 or times[-1] < start + timedelta(days=1, seconds=1):
        times.append(next_run(cron, times[-1]))
        if len(times) > 90_000:
            break
    gaps = {int((b - a).total_seconds()) for a, b in zip(times[1:], times[2:])}
    if len(gaps) != 1:
        raise ValueError(f"{cron!r} has no single interval")
    return gaps.pop()


def compress(text: str) -> str:
    return base64.b64encode(gzip.compress(text.encode(), mtime=0)).decode()


def decompress(text: str) -> str:
    return gzip.decompress(base64.b64decode(text)).decode()


def _inflated(packed: pd.Series) -> pd.Series:
    return packed.map(lambda p: None if p is None else decompress(p))


def payload(envelope: DataFrame) -> Column:
    """The text of an envelope's payload, inflated if its metadata says so."""
    marked = F.coalesce(F.try_element_at("metadata", F.lit("compressed")) == COMPRESSED, F.lit(False))
    return F.when(marked, F.pandas_udf(_inflated, "string")(F.when(marked, F.col("payload")))).otherwise(F.col("payload"))


def ftp_login(url: str, timeout: float = 30.0) -> FTP:
    parts = urlparse(url)
    ftp = FTP(timeout=timeout)
    ftp.connect(parts.hostname, parts.port or 21)
    ftp.login(unquote(parts.username or "anonymous"), unquote(parts.password or "guest"))
    return ftp


def download_ftp(spark: SparkSession, url: str) -> str:
    """The file at an FTP address, as a file of a new shared folder, written block
    by block as it comes."""
    path = PurePosixPath(urlparse(url).path)
    target = f"{shared_dir(spark)}/{path.name}"
    with ftp_login(url) as ftp, files.created(target) as out:
        ftp.retrbinary(f"RETR {path}", out.write, 1 << 20)
    return target


def latest_dated(names: list[str], pattern: str) -> str:
    """The name with the latest date at ``{}`` of the pattern (yyyymmdd), the
    first of equal dates; a pattern without ``{}`` is the name itself."""
    before, mark, after = pattern.partition("{}")
    if not mark:
        return pattern
    best: tuple[date, str] | None = None
    for name in names:
        middle = name[len(before) : len(name) - len(after)]
        if name.startswith(before) and name.endswith(after) and re.fullmatch(r"[0-9]{8}", middle):
            try:
                day = date(int(middle[:4]), int(middle[4:6]), int(middle[6:]))
            except ValueError:
                continue
            if best is None or day > best[0]:
                best = day, name
    if best is None:
        raise FileNotFoundError(f"nothing matches {pattern}")
    return best[1]


def latest_dated_rows(names: DataFrame, prefix: str, suffix: str) -> DataFrame:
    """The same on a DataFrame with ``name`` and ``_ord``: at most one row."""
    middle = F.substr("name", F.lit(len(prefix) + 1), F.length("name") - len(prefix) - len(suffix))
    day = F.when(middle.rlike("^[0-9]{8}$"), F.try_to_date(middle, "yyyyMMdd"))
    matching = names.where(F.startswith("name", F.lit(prefix)) & F.endswith("name", F.lit(suffix)))
    return matching.withColumn("day", day).where("day is not null").orderBy(F.desc("day"), "_ord").limit(1)


def resolve_latest_ftp(pattern: str) -> str:
    """An FTP pattern with its latest dated file filled in."""
    if "{}" not in pattern:
        return pattern
    path = urlparse(pattern).path
    folder, _, name = path.rpartition("/")
    with ftp_login(pattern) as ftp:
        found = latest_dated([n.rpartition("/")[2] for n in ftp.nlst(folder or "/")], name)
    return pattern[: len(pattern) - len(name)] + found
