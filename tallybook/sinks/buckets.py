"""Keyed tables in hash buckets that change bucket by bucket.

    runs/<run>/bucket_no=<n>/part-*   Parquet files of one write; they are never changed
    versions/<number>.json          which runs hold each bucket, and what has been taken in so far

A change writes a new run with the buckets that it touches and then a version file under the next number. Files of other
buckets stay as they are and keep their names. Readers take the greatest version that is complete: they see all of a
change or none of it, whatever is being written beside them, and never a gap. What has been taken in (batches of a
stream, read positions of a source) stands in the same file, so that rows and positions are committed in one step.

One writer at a time is meant to change a table; a second one with the same next number fails and can start again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators.changes import latest_per_key
from tallybook.session import create_text, list_files, materialise, modified, read_text, remove

BUCKET, ADDED = "bucket_no", "_added"  # names of their own: a table has no such columns


class VersionTaken(RuntimeError):
    """Another writer has committed in between."""


@dataclass(frozen=True)
class Version:
    """What a version file says. ``files``: per bucket its runs as (run, level, rows), lowest level first."""

    number: int = -1
    buckets: int = 0
    bucket_by: list[str] = field(default_factory=list)
    schema: str | None = None
    files: dict[int, list[tuple[str, int, int]]] = field(default_factory=dict)
    marks: dict = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"number": self.number, "buckets": self.buckets, "bucket_by": self.bucket_by,
                           "schema": self.schema, "marks": self.marks, "files": {str(b): runs for b, runs in self.files.items()}})

    @staticmethod
    def of(text: str) -> Version:
        read = json.loads(text)
        files = {int(b): [tuple(r) for r in runs] for b, runs in read.pop("files").items()}
        return Version(files=files, **read)


class BucketTable:
    """Files and versions; ``bucket_by`` are the columns whose hash gives the bucket (of the keys, all if not given).

    ``buckets`` and ``bucket_by`` hold for a new table only. A bucket is the unit that is rewritten: take as many as make
    it a file or a few (``files_per_bucket``), a thousand or more for a table of terabytes. The newest ``keep_versions``
    versions stay, so that running reads can end; older ones go, with files that no version holds.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], bucket_by: list[str] | None = None,
                 buckets: int = 64, files_per_bucket: int = 1, keep_versions: int = 50):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.parts, self.keep_versions = files_per_bucket, keep_versions
        now = self.version()
        self.buckets, self.bucket_by = now.buckets or buckets, now.bucket_by or bucket_by or keys

    def version(self) -> Version:
        """The greatest complete version; an empty one before the first."""
        for path in reversed(list_files(self.spark, f"{self.path}/versions")):
            try:
                return Version.of(read_text(self.spark, path))
            except (ValueError, TypeError):  # still being written, or left behind by a crash
                continue
        return Version()

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that hold rows with these keys (as many numbers as there are buckets at most)."""
        return sorted(r[0] for r in rows.select(self.bucket().alias(BUCKET)).distinct().collect())

    def paths(self, version: Version, buckets: Iterable[int] | None = None) -> list[str]:
        wanted = version.files if buckets is None else [b for b in buckets if b in version.files]
        return [f"{self.path}/runs/{run}/{BUCKET}={b}" for b in sorted(wanted) for run, _, _ in version.files[b]]

    def stored(self, version: Version, buckets: Iterable[int] | None = None) -> DataFrame:
        """All stored rows, of some buckets if given: only their files are listed and read."""
        if version.schema is None:
            raise FileNotFoundError(f"no version in {self.path}")
        schema, paths = T.StructType.fromJson(json.loads(version.schema)), self.paths(version, buckets)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def write_run(self, rows: DataFrame) -> tuple[str, dict[int, int]]:
        """Write a run, each bucket sorted by key; its name, and rows per bucket. Nothing refers to it yet."""
        run = uuid.uuid4().hex
        dealt = rows.withColumn(BUCKET, self.bucket())
        by = [F.col(BUCKET)]
        if self.parts > 1:
            by.append(F.pmod(F.xxhash64(F.lit(1), *self.keys), F.lit(self.parts)))
        (dealt.repartition(min(self.buckets * self.parts, self._most_tasks()), *by).sortWithinPartitions(BUCKET, *self.keys)
         .write.partitionBy(BUCKET).parquet(f"{self.path}/runs/{run}"))
        if not list_files(self.spark, f"{self.path}/runs/{run}"):
            return run, {}
        schema = T.StructType([T.StructField(BUCKET, T.IntegerType())])
        counts = self.spark.read.schema(schema).parquet(f"{self.path}/runs/{run}").groupBy(BUCKET).count().collect()
        return run, {r[0]: r[1] for r in counts}

    def _most_tasks(self) -> int:
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def commit(self, base: Version, schema: T.StructType, files: dict, marks: dict) -> Version:
        """Make the files the version after ``base``."""
        new = Version(base.number + 1, self.buckets, self.bucket_by, json.dumps(schema.jsonValue()), files,
                      {**base.marks, **marks})
        number = new.number
        while not create_text(self.spark, f"{self.path}/versions/{number:020d}.json", new.text()):
            if self.version().number >= new.number:
                raise VersionTaken(f"{self.path}: version {new.number} is taken")
            number += 1  # an incomplete file of a writer that crashed stands there
        if new.number % self.keep_versions == self.keep_versions - 1:
            self.expire(self.keep_versions)
        return new

    def expire(self, keep: int) -> None:
        """Remove all but the newest ``keep`` versions, and runs older than those that none of them holds."""
        versions = []
        for path in list_files(self.spark, f"{self.path}/versions"):
            try:
                versions.append((path, Version.of(read_text(self.spark, path))))
            except (ValueError, TypeError):
                continue
        kept = versions[-keep:]
        held = {run for _, v in kept for runs in v.files.values() for run, _, _ in runs}
        since = modified(self.spark, kept[0][0]) if kept else 0
        for path, _ in versions[:-keep]:
            remove(self.spark, path)
        for run in list_files(self.spark, f"{self.path}/runs"):
            if run.rsplit("/", 1)[1] not in held and modified(self.spark, run) < since:
                remove(self.spark, run)


class Snapshot(BucketTable):
    """One row per key; a pass rewrites the buckets that its changes touch and no others."""

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        return self.stored(self.version(), buckets)

    def load(self, rows: DataFrame, marks: dict | None = None) -> Version:
        """Make ``rows`` the whole table."""
        run, counts = self.write_run(rows)
        return self.commit(self.version(), rows.schema, {b: [(run, 0, n)] for b, n in counts.items()}, marks or {})

    def apply(self, changes: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame],
              marks: dict | None = None) -> Version:
        """Rewrite the touched buckets as ``combine(their rows, changes)`` and commit this with ``marks``.

        ``combine`` gets whole buckets and has to give back what they hold from now on, in the table's columns. A
        pass that failed before the commit can be repeated: nothing of it is seen.
        """
        base = self.version()
        changes = materialise(changes, "changes")
        touched = self.buckets_of(changes)
        if not touched:
            return self.commit(base, _schema(base), dict(base.files), marks or {})
        new = combine(self.stored(base, touched), changes).select(*_schema(base).names)
        run, counts = self.write_run(new)
        if not set(counts) <= set(touched):
            raise ValueError("combine gave rows of buckets that hold no change")
        files = {b: runs for b, runs in base.files.items() if b not in set(touched)}
        return self.commit(base, new.schema, files | {b: [(run, 0, n)] for b, n in counts.items()}, marks or {})


def _schema(version: Version) -> T.StructType:
    return T.StructType.fromJson(json.loads(version.schema))


class TieredLog(BucketTable):
    """Newest versions of keys, deletes included, in at most one sorted run per bucket and level.

    A batch adds a run to the buckets that it touches. Where a bucket's lower levels are full (``first_rows`` rows at
    level 0, ``fan`` times as many at each further one), the batch and those runs become one run of the next level that
    holds them, inside the batch. So a key is read from as many runs as there are levels at most, and a row is
    rewritten about ``fan`` times per level, however long the log lives. ``deleted`` rows stay: an event that arrives late
    must not bring their keys back.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], bucket_by: list[str] | None = None,
                 first_rows: int = 100_000, fan: int = 8, **table):
        super().__init__(spark, path, keys, bucket_by, **table)
        self.order, self.first_rows, self.fan = order, first_rows, fan

    def target(self, runs: list[tuple[str, int, int]], rows: int) -> tuple[int, list[tuple[str, int, int]]]:
        """The level that takes ``rows`` new rows, and the runs that go into it."""
        level = 0
        while True:
            folded = [r for r in runs if r[1] <= level]
            if rows + sum(r[2] for r in folded) <= self.first_rows * self.fan ** level:
                return level, folded
            level += 1

    def add(self, rows: DataFrame, stream: str, batch_id: int) -> Version:
        """Take in a batch (one row per key) once: a batch that was committed before changes nothing."""
        base = self.version()
        if base.marks.get(stream, -1) >= batch_id:
            return base
        new = rows.withColumn(ADDED, F.lit(base.number + 1).cast("long"))
        run, counts = self.write_run(new)
        files, folds = dict(base.files), {}
        for b, n in counts.items():
            level, folded = self.target(base.files.get(b, []), n)
            rest = [r for r in base.files.get(b, []) if r not in folded]
            files[b] = [(run, level, n), *rest]
            if folded:
                folds[b] = (level, folded, rest)
        if folds:
            parts = Version(schema=json.dumps(new.schema.jsonValue()),
                            files={b: [(run, 0, 0), *folded] for b, (_, folded, _) in folds.items()})
            merged, counts = self.write_run(latest_per_key(self.stored(parts), self.keys, [*self.order, ADDED]))
            files |= {b: [(merged, level, counts[b]), *rest] for b, (level, _, rest) in folds.items()}
        return self.commit(base, new.schema, files, {stream: batch_id})

    def newest(self, with_deleted: bool = False, touched: DataFrame | None = None) -> DataFrame:
        """Current rows; with ``touched`` those of its buckets only (it needs the columns that give the bucket)."""
        version = self.version()
        stored = self.stored(version, None if touched is None else self.buckets_of(touched))
        newest = latest_per_key(stored, self.keys, [*self.order, ADDED]).drop(ADDED)
        return newest if with_deleted else newest.filter(~F.col("deleted")).drop("deleted")
