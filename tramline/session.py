"""Session settings that the library expects."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; more may be given by name."""
    builder = SparkSession.builder.config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share.

    A local session without the setting gets a folder in the machine's
    temporary one; on a cluster that would not be shared, so it is refused.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        top = f"file://{tempfile.gettempdir()}/tramline-checkpoints"
    return f"{top.rstrip('/')}/tramline-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """Rows that are read more than once, written to the shared folder and read from there."""
    folder = shared_dir(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def put_file(spark: SparkSession, path: str, data: bytes) -> None:
    """Writes one file of the driver's to any file system that Spark knows."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        for k in range(0, len(data), 1 << 20):
            out.write(bytearray(data[k : k + (1 << 20)]))
    finally:
        out.close()
