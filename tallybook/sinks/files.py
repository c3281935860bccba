"""CSV output and previews."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallybook.session import file_at, list_files, remove

COPY_BYTES = 1 << 20


def write_csv(df: DataFrame, path: str, files: int | None = None, ordered: bool = False) -> None:
    """Write CSV with a header, replacing what is there.

    By default one file per partition. ``files`` fixes their number, whatever the data. ``ordered`` frames (after an
    ``orderBy``) are written by all tasks of the sort, one part each, and the parts are joined as files; others are dealt
    out anew, so that the stage before keeps its parallelism.
    """
    if files is not None and ordered:
        return _write_joined(df, path.rstrip("/"), files)
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def header_line(columns: list[str]) -> str:
    quoted = [f'"{c.replace(chr(34), chr(34) * 2)}"' if set(c) & set(',"\n\r') else c for c in columns]
    return ",".join(quoted) + "\n"


def _write_joined(df: DataFrame, path: str, files: int) -> None:
    spark, run = df.sparkSession, uuid.uuid4().hex
    parts, whole = f"{path}.{run}.parts", f"{path}.{run}.new"
    df.write.option("escape", '"').csv(parts)
    names = list_files(spark, parts)  # in the order of the partitions
    for i in range(files):
        group = names[len(names) * i // files:len(names) * (i + 1) // files]
        join_files(spark, f"{whole}/part-{i:05d}.csv", header_line(df.columns), group)
    remove(spark, path)
    system, place = file_at(spark, whole)
    system.rename(place, file_at(spark, path)[1])
    remove(spark, parts)


def join_files(spark: SparkSession, target: str, head: str, parts: list[str]) -> None:
    """A file of ``head`` and the parts, joined by the file system itself where it can (then no byte is copied).

    Elsewhere the bytes are copied by the file system's client in small blocks; no row is read.
    """
    system, place = file_at(spark, target)
    out = system.create(place, True)
    out.write(bytearray(head.encode()))
    places = [file_at(spark, p)[1] for p in parts]
    places = [p for p in places if system.getFileStatus(p).getLen()]
    if places:
        out.close()
        paths = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(places))
        for i, p in enumerate(places):
            paths[i] = p
        try:
            return system.concat(place, paths)
        except (Py4JJavaError, PySparkException) as error:
            if "UnsupportedOperation" not in f"{type(error).__name__} {error}":
                raise
        out = system.create(place, True)
        out.write(bytearray(head.encode()))
    for p in places:
        source = system.open(p)
        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, COPY_BYTES, False)
        source.close()
    out.close()


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read such files back with a declared schema; text may hold quotes and line breaks."""
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("multiLine", True).csv(path))


def preview(df: DataFrame, order: list, rows: int = 5) -> DataFrame:
    """First ``rows`` rows in ``order``."""
    return df.orderBy(*order).limit(rows)
