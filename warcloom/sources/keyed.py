"""Keyed tables: one row per key, changed by batches of puts that take effect as a whole, once, or not at all.

Rows are dealt to a fixed number of buckets by a hash of their key; a bucket is a folder of Parquet files sorted by key. A
batch rewrites the buckets it touches into new folders and leaves the others alone. Which folder holds a bucket's current rows
stands in a manifest, a small file per version that is written aside and then renamed to the next number: a batch is
committed by that rename, two writers cannot both take a number, and readers of an older version are not disturbed.

The manifest also names, per writer, the last batch that it committed. A batch that comes again after a failure, as a
stream's does, finds its number there and changes nothing, and what a killed batch left behind is in no manifest and
goes with `vacuum`.

The buckets of a table are its unit of work: choose as many as make each a file of some 100 MB. Only their list passes the
driver. A point read lists and opens one bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from warcloom.operators.output import upsert as latest_cells
from warcloom.session import stored

KEY = "key"
TRIES = 5


class TakenError(RuntimeError):
    """Another writer has published the next version."""


@dataclass(frozen=True)
class Manifest:
    """A version of a table: its columns, and the folder of each bucket that has rows."""

    version: int
    buckets: int
    schema: StructType
    folders: dict[int, str]
    batches: dict[str, int]

    def to_json(self) -> str:
        return json.dumps(
            {"version": self.version, "buckets": self.buckets, "schema": self.schema.jsonValue(), "folders": self.folders, "batches": self.batches}
        )

    @staticmethod
    def from_json(text: str) -> Manifest:
        found = json.loads(text)
        folders = {int(k): v for k, v in found["folders"].items()}
        return Manifest(found["version"], found["buckets"], StructType.fromJson(found["schema"]), folders, found["batches"])


class KeyedTable:
    """A table below a folder of any file system that Spark reads and that renames files as one act."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, root: str, columns: StructType | str = f"{KEY} string", buckets: int = 64) -> KeyedTable:
        """An empty table; one that is there already is opened as it is. Columns may be added by later batches."""
        table = cls(spark, root)
        if table._versions():
            return table
        schema = columns if isinstance(columns, StructType) else spark.createDataFrame([], columns).schema
        if KEY not in schema.names:
            raise ValueError(f"a keyed table needs a column {KEY!r}")
        try:
            table._publish(Manifest(0, buckets, _nullable(schema), {}, {}))
        except TakenError:
            pass
        return table

    # Reading

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest version, or a given one."""
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"no keyed table at {self.root}")
        chosen = max(versions) if version is None else version
        return Manifest.from_json(self.spark.read.text(self._manifest_path(chosen), wholetext=True).first()[0])

    def read(self, version: int | None = None) -> DataFrame:
        """All rows, of the newest version or of one that `vacuum` has kept."""
        found = self.manifest(version)
        return self._rows(found, found.folders)

    def get(self, key: str) -> DataFrame:
        """The row of a key, or none. Files of one bucket are read, and in them what statistics and Bloom filter leave."""
        found = self.manifest()
        bucket = self.spark.range(1).select(_bucket(F.lit(key), found.buckets)).first()[0]
        return self._rows(found, [bucket]).filter(F.col(KEY) == key)

    def _rows(self, manifest: Manifest, buckets: Iterable[int]) -> DataFrame:
        paths = [f"{self.root}/data/{manifest.folders[b]}/bucket={b}" for b in buckets if b in manifest.folders]
        if not paths:
            return self.spark.createDataFrame([], manifest.schema)
        return self.spark.read.schema(manifest.schema).parquet(*paths)

    # Writing

    def upsert(self, batch: DataFrame, version: str | None = None, batch_of: tuple[str, int] | None = None) -> Manifest:
        """Put the rows of a batch; returns the manifest that holds them.

        Cells of the batch replace stored ones, null cells leave them, and new columns are added. With `version`, a
        key may come more than once and its newest cells count; without, a key that comes twice keeps one of
        them. Rows without a key are left out. `batch_of` is (writer, number), numbers rising: a number that is not
        above the writer's last changes nothing.
        """
        # a batch is needed twice, for its buckets and its rows, and must be the same both times
        columns = [c for c in batch.columns if c != version]
        known = stored(batch.filter(F.col(KEY).isNotNull()), "puts")
        # a key with many puts is combined in every task first, so that none is hot behind the next shuffle
        empty = self.spark.createDataFrame([], known.select(columns).schema)
        puts = latest_cells(empty, known, KEY, version)
        for _ in range(TRIES):
            found = self.manifest()
            if batch_of and found.batches.get(batch_of[0], -1) >= batch_of[1]:
                return found
            made = self._with_puts(found, puts)
            if batch_of:
                made = replace(made, batches=made.batches | {batch_of[0]: batch_of[1]})
            try:
                self._publish(made)
                return made
            except TakenError:
                continue  # another batch came first: its rows are the stored ones now
        raise TakenError(f"{TRIES} versions of {self.root} were taken by others")

    def _with_puts(self, found: Manifest, puts: DataFrame) -> Manifest:
        """Write the buckets that puts touch, with the puts in them; the manifest of the next version."""
        bucket = _bucket(F.col(KEY), found.buckets)
        touched = sorted(r[0] for r in puts.select(bucket).distinct().collect())
        schema = _merged(found.schema, puts.schema)
        after = replace(found, version=found.version + 1, schema=schema)
        if not touched:
            return after
        cells = [name for name in schema.names if name != KEY]
        column = lambda rows, name: F.col(name) if name in rows.columns else F.lit(None).cast(schema[name].dataType).alias(name)
        old = self._rows(found, touched)
        sides = [rows.select(KEY, *(column(rows, c) for c in cells), F.lit(age).alias("_age")) for age, rows in enumerate((old, puts))]
        # dealt by bucket once: rows of a key are then together, too, and the writer finds its buckets in order
        both = sides[0].unionByName(sides[1]).withColumn("bucket", bucket).repartition(len(touched), "bucket")
        newest = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_age"))).alias(c) for c in cells]
        rows = both.groupBy("bucket", KEY).agg(*newest) if newest else both.select("bucket", KEY).distinct()
        folder = uuid.uuid4().hex
        writer = rows.sortWithinPartitions("bucket", KEY).write.partitionBy("bucket").option(f"parquet.bloom.filter.enabled#{KEY}", "true")
        writer.parquet(f"{self.root}/data/{folder}")
        return replace(after, folders=found.folders | dict.fromkeys(touched, folder))

    def vacuum(self, keep: int = 2) -> int:
        """Delete versions but the newest `keep`, and all folders that none of them names; the number of deleted folders.

        Call it when no batch is under way: the folder of one is in no manifest yet.
        """
        fs, path = self._fs()
        versions = sorted(self._versions())
        kept = [self.manifest(v) for v in versions[-keep:]]
        used = {(folder, b) for m in kept for b, folder in m.folders.items()}
        for v in versions[:-keep]:
            fs.delete(path(self._manifest_path(v)), False)
        gone, data = 0, path(f"{self.root}/data")
        for folder in fs.listStatus(data) if fs.exists(data) else ():
            name = folder.getPath().getName()
            if name not in {f for f, _ in used}:
                gone += fs.delete(folder.getPath(), True)
                continue
            for bucket in fs.listStatus(folder.getPath()):
                label = bucket.getPath().getName()
                if label.startswith("bucket=") and (name, int(label[7:])) not in used:
                    gone += fs.delete(bucket.getPath(), True)
        return gone

    # Files

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifest/{version:012d}.json"

    def _versions(self) -> list[int]:
        fs, path = self._fs()
        folder = path(f"{self.root}/manifest")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return [int(n[:-5]) for n in names if n.endswith(".json")]

    def _publish(self, made: Manifest) -> None:
        fs, path = self._fs()
        aside = path(f"{self.root}/manifest/aside-{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(made.to_json().encode()))
        out.close()
        jvm = self.spark._jvm
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(aside), fs.makeQualified(path(self._manifest_path(made.version))), none)
        except Exception as error:
            fs.delete(aside, False)
            if "FileAlreadyExists" in str(error):
                raise TakenError(f"version {made.version} of {self.root}") from error
            raise




def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema])


def _merged(old: StructType, new: StructType) -> StructType:
    """Columns of both; one that both have must have the same type."""
    for f in new:
        if f.name in old.names and old[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name!r} is {old[f.name].dataType.simpleString()} in the table, {f.dataType.simpleString()} in the batch")
    return _nullable(StructType([*old, *(f for f in new if f.name not in old.names)]))
