"""Sinks: tables as CSV, feeds over HTTP, raw payloads."""

from __future__ import annotations

import urllib.request
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources import gtfsrt, netex, remote
from . import committed


def write_tables(entities: DataFrame, folder: str, profile: str = "epip", types: Sequence[str] | None = None) -> dict[str, int]:
    """Every table of a profile as CSV below ``folder``, with a header even if
    empty; entities without a table are dropped. Returns rows by table.

    ``entities`` is written once to the shared folder, by type, so that each
    table's scan reads its own rows alone, and counted in that pass.
    """
    tables = netex.profile(profile)[0]
    kinds = list(types or tables)
    path, schema = shared_dir(entities.sparkSession), entities.schema
    seen = Observation()
    counted = entities.where(F.col("type").isin(*kinds)).observe(seen, *[F.count_if(F.col("type") == kind).alias(kind) for kind in kinds])
    counted.write.partitionBy("type").parquet(path)
    entities = entities.sparkSession.read.schema(schema).parquet(path)
    for kind in kinds:
        rows = netex.table(entities, kind, profile).drop("_ord")
        rows.write.mode("overwrite").csv(f"{folder.rstrip('/')}/{tables[kind][0]}.csv", header=True, escape='"', emptyValue="")
    return {tables[kind][0]: seen.get[kind] for kind in kinds}


def put(url: str, data: bytes, timeout: float = 30.0) -> None:
    """HTTP PUT, which replaces what was there; an answer beyond 2xx fails."""
    request = urllib.request.Request(url, data=data, method="PUT")
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        if not 200 <= answer.status < 300:
            raise OSError(f"PUT {url}: {answer.status}")


def write_feed(entities: DataFrame, timestamp: int, targets: dict[str, str], optional: Sequence[str] = (), **once: str) -> None:
    """A feed to files or addresses, by form (``pb``, ``json``). Tasks encode the
    entities, the commit joins them; a target of an ``optional`` form may fail.
    ``staging`` and ``batch`` make a batch go out once."""
    entities = entities if not once else entities.orderBy("id")  # so that a batch run again has the same order
    around = gtfsrt.around(timestamp, entities.isEmpty())
    envelopes = {targets[f]: committed.envelope(*around[f], optional=f in optional) for f in ("pb", "json") if f in targets}
    own = {f: targets[f] for f in ("pb", "json") if f in targets}
    committed.assemble(gtfsrt.blocks(entities, own, {f: around[f][1] for f in own}), envelopes, **once)


def put_feed(entities: DataFrame, timestamp: int, url: str, **once: str) -> None:
    """A feed as ``url``.pb and ``url``.json; only the first has to succeed."""
    write_feed(entities, timestamp, {"pb": f"{url}.pb", "json": f"{url}.json"}, optional=["json"], **once)


def dump(entities: DataFrame, timestamp: int, path: str) -> None:
    """A feed as one file, in the format of its extension."""
    write_feed(entities, timestamp, {"pb" if gtfsrt.detect_format(path) == "protobuf" else "json": path})


def dump_messages(messages: DataFrame, folder: str) -> None:
    """Live feeds as JSON below ``folder``, one message to a line, a folder for
    each provider; ``messages`` has provider and payload (``siri.to_json``)."""
    messages.select("provider", F.regexp_replace("payload", "[\r\n]+", " ").alias("value")).write.partitionBy("provider").mode("overwrite").text(folder)


def envelopes(messages: DataFrame, compress: bool = False) -> DataFrame:
    """(provider, timestamp, rawdata): what is queued of messages with provider,
    timestamp, format, protocol and payload; compressed payloads say so."""
    packed = F.pandas_udf(_deflated, "string")(F.col("payload")) if compress else F.col("payload")
    metadata = F.create_map(F.lit("compressed"), F.lit(remote.COMPRESSED)) if compress else F.create_map().cast("map<string,string>")
    return messages.select("provider", "timestamp", F.struct("format", "protocol", metadata.alias("metadata"), packed.alias("payload")).alias("rawdata"))


def _deflated(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else remote.compress(t))


def publish(messages: DataFrame, folder: str, compress: bool = False) -> None:
    """Queues messages as JSON envelopes, one to a line, for ``streaming.messages``."""
    envelopes(messages, compress).write.mode("append").json(folder)


def publish_kafka(messages: DataFrame, servers: str, topic: str, compress: bool = False, **options: str) -> None:
    """The same as records of a topic, keyed by provider."""
    queued = envelopes(messages, compress)
    rows = queued.select(F.col("provider").alias("key"), F.to_json(F.struct("provider", "timestamp", "rawdata")).alias("value"))
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).options(**options).save()


def save_raw(messages: DataFrame, host: str, paths: dict[str, str], **once: str) -> None:
    """The latest payload of each provider, as it came, to its path. Tasks write
    the payloads, the commit sends them on a block at a time."""
    known = F.create_map(*[F.lit(x) for p, path in paths.items() for x in (p, f"{host.rstrip('/')}/{path.lstrip('/')}")])
    latest = messages.where(F.col("provider").isin(*paths)).groupBy("provider").agg(F.max_by("text", "timestamp").alias("text"))
    rows = latest.select(known[F.col("provider")].alias("target"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("part"))
    committed.assemble(rows, {}, every=True, **once)
