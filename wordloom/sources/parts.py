"""Tables that grow by committed parts.

A store is a folder with one or more keyed tables, each cut into the same number
of buckets by its keys, and a log. ``append`` writes a part (one folder in each
table) and then one log row that names the parts of the new version; a reader
takes the parts of one log row. So an append costs what it adds, a writer that
dies leaves the last version as it was, and old versions stay readable until
``vacuum``. Parts lie in equal buckets, so merging them on read is an aggregate
without a shuffle; ``compact`` writes that merge as one part.

One writer at a time: two log rows of one version are refused by every reader.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import setting

_LOG = "version bigint, tag bigint, parts array<string>"


@dataclass(frozen=True)
class Keyed:
    """A table of a store: its columns, its keys, and how the values of one key in several parts become one
    (``sum``, ``min`` or ``max`` by column)."""

    schema: str
    keys: tuple[str, ...]
    merge: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Version:
    version: int
    tag: int  # the highest tag that was ever committed, -1 if none
    parts: tuple[str, ...]


class PartStore:
    """``tables`` by name; a store that exists must be opened with the tables and buckets that it was made with."""

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, Keyed], buckets: int) -> None:
        self.spark, self.path, self.tables = spark, path.rstrip("/"), tables
        name = hashlib.md5(self.path.encode()).hexdigest()
        self.names = {t: f"wordloom_parts_{name}_{t}" for t in tables}
        self.buckets = buckets
        for t, spec in tables.items():
            folder, fs = self._folder(t)
            fs.mkdirs(folder)
            columns = StructType.fromDDL(spec.schema).simpleString()[len("struct<") : -1].replace(":", " ")
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.names[t]} ({columns}, part string) USING parquet PARTITIONED BY (part)"
                f" CLUSTERED BY ({', '.join(spec.keys)}) INTO {buckets} BUCKETS LOCATION '{self.path}/{t}'"
            )
            spark.sql(f"ALTER TABLE {self.names[t]} RECOVER PARTITIONS")  # parts of earlier sessions

    # ---- versions --------------------------------------------------------
    def _folder(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self, number: int | None = None) -> Version:
        """A version (None: the last). A store without a commit is at version 0, which has no rows."""
        path, fs = self._folder("log")
        rows = self.spark.read.schema(_LOG).json(str(path)) if fs.exists(path) else None
        if rows is not None and number is None:
            number = rows.agg(F.max("version")).first()[0]
        if rows is None or not number:
            if number:
                raise ValueError(f"no version {number} in {self.path}")
            return Version(0, -1, ())
        found = rows.where(F.col("version") == number).limit(2).collect()
        if len(found) != 1:
            raise ValueError(f"{'two writers made' if found else 'no'} version {number} in {self.path}")
        return Version(number, found[0]["tag"], tuple(found[0]["parts"]))

    def _commit(self, v: Version) -> Version:
        row = self.spark.createDataFrame([(v.version, v.tag, list(v.parts))], _LOG).coalesce(1)
        row.write.mode("append").json(f"{self.path}/log")  # one file, which appears when it is whole
        return v

    # ---- rows ------------------------------------------------------------
    def _write(self, table: str, df: DataFrame, part: str) -> None:
        columns = StructType.fromDDL(self.tables[table].schema).fieldNames()
        df.select(*columns, F.lit(part).alias("part")).write.insertInto(self.names[table])

    def append(self, rows: dict[str, DataFrame], tag: int | None = None, dealt: Sequence[str] = ()) -> Version:
        """Add one part, with one row per key in each table. With a tag that is not above the last one, nothing is
        done: that part was committed before. Tables in ``dealt`` come with a partition for each bucket, by the hash
        that Spark deals their keys with, and are written as they come."""
        last = self.version()
        if tag is not None and tag <= last.tag:
            return last
        part = uuid.uuid4().hex
        for t, df in rows.items():
            if t in dealt:
                with setting(self.spark, "spark.sql.maxConcurrentOutputFileWriters", "2"):  # a task writes one file: no sort
                    self._write(t, df, part)
            else:
                self._write(t, df.repartition(self.buckets, *self.tables[t].keys), part)
        return self._commit(Version(last.version + 1, last.tag if tag is None else tag, (*last.parts, part)))

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """One row per key."""
        spec, parts = self.tables[table], self.version(version).parts
        rows = self.spark.table(self.names[table]).where(F.col("part").isin(list(parts))).drop("part")
        if len(parts) < 2:
            return rows
        values = [getattr(F, how)(c).cast(rows.schema[c].dataType).alias(c) for c, how in spec.merge]
        merged = rows.groupBy(*spec.keys).agg(*values) if values else rows.distinct()
        return merged.select(*rows.columns)

    def compact(self) -> Version:
        """Make all parts one. Tasks read and write a bucket each; nothing is shuffled."""
        last = self.version()
        if len(last.parts) < 2:
            return last
        part = uuid.uuid4().hex
        for t in self.tables:
            self._write(t, self.read(t, last.version), part)
        return self._commit(Version(last.version + 1, last.tag, (part,)))

    def vacuum(self) -> int:
        """Delete the parts that the last version does not name, unfinished ones too; how many folders went. Older
        versions cannot be read from then on."""
        keep, gone = {f"part={p}" for p in self.version().parts}, 0
        for t in self.tables:
            path, fs = self._folder(t)
            for f in fs.listStatus(path) if fs.exists(path) else []:
                name = f.getPath().getName()
                if name.startswith("part=") and name not in keep:
                    self.spark.sql(f"ALTER TABLE {self.names[t]} DROP IF EXISTS PARTITION (part='{name[len('part='):]}')")
                    fs.delete(f.getPath(), True)
                    gone += 1
        return gone
