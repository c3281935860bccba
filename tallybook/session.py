"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Streaming state outside the heap: one row per key can outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

PARTITION_BYTES = 128 * 1024 * 1024
MOST_PARTITIONS = 32_768
STATE_PARTITIONS = 512


def shuffle_partitions(data_bytes: int, minimum: int = 8) -> int:
    """Partition count for shuffles of ``data_bytes``: 128 MB a task up to 4 TB, then larger ones, which spill.

    Every map task writes a block for every partition, so their number cannot follow the data for ever; AQE
    merges small partitions and splits those of skewed joins.
    """
    return min(max(minimum, -(-data_bytes // PARTITION_BYTES)), MOST_PARTITIONS)


def build_session(app_name: str, data_bytes: int | None = None, master: str | None = None,
                  conf: dict[str, str] | None = None, streaming: bool = False) -> SparkSession:
    """Session with the settings above; ``data_bytes`` sizes the shuffles.

    A stream keeps a store per shuffle partition and operator for its whole life, so ``streaming``
    fixes their number, whatever the amount of data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if streaming:
        settings["spark.sql.shuffle.partitions"] = str(STATE_PARTITIONS)
    elif data_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(data_bytes))
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, or below the warehouse where that is not set.

    On a cluster a warehouse on the driver's own disk is refused: executors would not see its files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    base = shared.rstrip("/") if shared else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if not shared and not spark.sparkContext.master.startswith("local") and (base.startswith(("/", "file:")) or ":" not in base):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines share; {base} is the driver's own")
    return f"{base}/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's folder; call it when the results that read from it are written."""
    remove(spark, scratch_root(spark))


def file_at(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    files, place = file_at(spark, path)
    files.delete(place, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; False if there is. A file is never written over."""
    files, place = file_at(spark, path)
    if files.exists(place):
        return False
    try:
        out = files.create(place, False)
    except (Py4JJavaError, PySparkException) as error:
        if "FileAlreadyExists" in f"{type(error).__name__} {error}":
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, or None if there is none."""
    files, place = file_at(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    data = bytes(stream.readAllBytes())
    stream.close()
    return data.decode()


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed, in milliseconds."""
    files, place = file_at(spark, path)
    return files.getFileStatus(place).getModificationTime()


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """What is in a folder, by name, without hidden files."""
    files, place = file_at(spark, folder)
    if not files.exists(place):
        return []
    return sorted(f"{folder}/{n}" for n in (s.getPath().getName() for s in files.listStatus(place)) if n[0] not in "._")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root; nothing is created until something writes there."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results that are used more than once: the sources are read and parsed a single time, all
    uses see the same rows, and a lost executor costs a re-read, not a re-computation. The copy goes with
    ``clear_scratch``.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
