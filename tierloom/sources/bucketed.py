"""A keyed Parquet table that is updated by rewriting only the buckets of changed keys.

Parquet has no MERGE. Rows are placed in a fixed number of buckets by key hash; an update writes the new content of
the touched buckets under its own version folder and then one small file that names the version of every bucket that
holds rows, together with the key, the number of buckets and the schema. That file makes the update visible at once.
Earlier versions stay readable until their folders are removed. One writer at a time is assumed; a writer that dies
before that file leaves the table as it was, and its rerun overwrites what it had written.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.session import shared_folder
from tierloom.sources.writers import write_parquet

#: Names of folders; no column of a table may have them.
BUCKET, VERSION = "__bucket", "__version"
#: A lookup of at most so many keys names them to the scan, which skips row groups by their ranges and Bloom filters.
NAMED_KEYS = 1_000
_MANIFEST = f"bucket int, version bigint, facts string, {VERSION} bigint"


class BucketedTable:
    """``key`` and ``buckets`` belong to the table: once it holds something, other values are refused."""

    def __init__(self, spark: SparkSession, root: str, key: str | Sequence[str], buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key = [key] if isinstance(key, str) else list(key)
        self.buckets = buckets

    def _manifest(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def versions(self) -> list[int]:
        """The published versions in order."""
        manifest = self._manifest()
        found = [] if manifest is None else manifest.select(VERSION).distinct().collect()  # folder names
        return sorted(row[0] for row in found)

    def last_version(self) -> int | None:
        return max(self.versions(), default=None)

    def _published(self, version: int | None) -> tuple[dict[int, int], T.StructType | None]:
        """Which version holds the rows of each bucket, and the schema; at most one entry per bucket."""
        if version is None:
            return {}, None
        entries = self._manifest().where(F.col(VERSION) == version).select("bucket", "version", "facts").collect()
        facts = next(json.loads(row.facts) for row in entries if row.bucket == -1)
        if (facts["key"], facts["buckets"]) != (self.key, self.buckets):
            raise ValueError(
                f"{self.root} has key {facts['key']} in {facts['buckets']} buckets, not {self.key} in {self.buckets}"
            )
        held = {row.bucket: row.version for row in entries if row.bucket >= 0}
        return held, T.StructType.fromJson(facts["schema"])

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table now or as of a version; None if there was nothing yet."""
        published = [v for v in self.versions() if version is None or v <= version]
        held, schema = self._published(max(published, default=None))
        return None if schema is None else self._read(held, schema)

    def lookup(self, keys: DataFrame) -> DataFrame | None:
        """The rows of the given keys (columns named as the table's key); None if there was nothing yet.

        Only the buckets that hold the keys are read. Keys of another type count as the table's; NULL keys match nothing, and a key
        asked twice is answered once.
        """
        held, schema = self._published(self.last_version())
        if schema is None:
            return None
        asked = keys.select(*[F.col(name).cast(schema[name].dataType).alias(name) for name in self.key]).dropna().distinct()
        staged = write_parquet(asked, shared_folder(self.spark, "asked"))
        asked = self.spark.read.schema(asked.schema).parquet(staged)
        buckets = [row[0] for row in asked.select(self._bucket()).distinct().collect()]  # at most self.buckets values
        rows = self._read({bucket: held[bucket] for bucket in buckets if bucket in held}, schema)
        few = asked.limit(NAMED_KEYS + 1).collect()
        if len(few) <= NAMED_KEYS:
            for name in self.key:  # with several columns these are more than the keys, so the join stays
                rows = rows.where(F.col(name).isin([row[name] for row in few]))
            asked = F.broadcast(asked)
        return rows.join(asked, self.key, "left_semi")

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _read(self, held: Mapping[int, int], schema: T.StructType) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/data/{VERSION}={version}/{BUCKET}={bucket}" for bucket, version in held.items()]
        return self.spark.read.schema(schema).parquet(*paths)

    def update(self, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int | None:
        """Write ``merge(current rows, batch)`` for the buckets the batch touches, and publish it as a new version.

        The batch is computed once, into the shared folder. A batch may come twice, so ``merge`` must give the same rows
        again when it has seen the batch before. Columns that ``merge`` adds are null in the rows of other buckets;
        columns may not go or change their type.
        """
        last = self.last_version()
        version = 0 if last is None else last + 1
        held, schema = self._published(last)
        staged = write_parquet(batch, shared_folder(self.spark, "batch"))
        batch = self.spark.read.schema(batch.schema).parquet(staged)
        bucket = self._bucket()
        touched = [row[0] for row in batch.select(bucket).distinct().collect()]  # at most self.buckets values
        if not touched:
            return last
        current = batch.limit(0) if schema is None else self._read({b: held[b] for b in touched if b in held}, schema)
        merged = merge(current, batch)
        schema = _widened(schema, merged.schema)
        data = f"{self.root}/data/{VERSION}={version}"
        placed = merged.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *self.key)
        writer = placed.write.mode("overwrite").partitionBy(BUCKET)
        for name in self.key:  # lookups skip row groups by key
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer.parquet(data)
        written = self.spark.read.schema(T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())])).parquet(data)
        filled = {row[0] for row in written.select(BUCKET).distinct().collect()}  # buckets that merge emptied have no folder
        held = {b: v for b, v in held.items() if b not in touched} | dict.fromkeys(filled, version)
        facts = json.dumps({"key": self.key, "buckets": self.buckets, "schema": schema.jsonValue()})
        entries = [(-1, version, facts), *((b, v, None) for b, v in held.items())]
        entries = self.spark.createDataFrame(entries, "bucket int, version bigint, facts string")
        entries.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/{VERSION}={version}")
        return version


def _widened(stored: T.StructType | None, merged: T.StructType) -> T.StructType:
    """The stored columns and those that are new, all nullable."""
    reserved = {BUCKET, VERSION} & set(merged.names)
    if reserved:
        raise ValueError(f"reserved column names: {', '.join(sorted(reserved))}")
    types = {field.name: field.dataType for field in merged}
    for field in stored or []:
        if types.get(field.name) != field.dataType:
            raise ValueError(f"column {field.name} of type {field.dataType.simpleString()} is gone or has another type")
    fields = [*(stored or []), *(field for field in merged if stored is None or field.name not in stored.names)]
    return T.StructType([T.StructField(field.name, field.dataType) for field in fields])
